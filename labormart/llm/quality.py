"""Quality rules by cross-document line frequency; DataFrame functions only.

Every line is normalised and hashed. A line that stands in many different
documents of one host is boilerplate: it is taken out, and a document that
loses most of its words that way is rejected. Documents are told apart by a
hash of all their words in order, so copies count as one. Lines of every
length are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labormart.llm.common import SPACE_CLASS, fresh, settle

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host's line goes if more different documents hold it than both of these.
LINE_DOCS = 25
LINE_SHARE = 0.01
#: A document is depleted if less than this share of its words is left.
LEFT_SHARE = 0.5
#: Parts over which a line's documents are dealt.
SALTS = 32
_SPACES = " \t\n\x0b\f\r"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where a lambda uses it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def _repeat_words(words: Column) -> Column:
    """Words covered by windows of three words that stand in the text twice or more.

    A window's hash gives its upper bits, its place the lower ones; sorted, equal
    windows are neighbours. The bits for the place follow the text's length, so
    neighbours are then compared by all 64 bits of the hashes at their places.
    """

    def counted(h: Column) -> Column:
        bits = F.ceil(F.log2(F.size(h) + F.lit(1.0))).cast("int")

        def covered(args: Column) -> Column:
            s, b = args["s"], args["b"]
            at_ = lambda i: F.get(s, i).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), b) - 1).cast("int")
            same = lambda i, j: F.get(args["h"], at_(i)) == F.get(args["h"], at_(j))
            twice = lambda i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False))
            at = F.filter(F.sequence(F.lit(0), F.size(s) - 1), twice)
            place = F.transform(at, lambda i: F.get(s, i).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), b) - 1))
            spread = F.flatten(F.transform(place, lambda p: F.array(p, p + 1, p + 2)))
            return F.size(F.array_distinct(spread))

        packed = F.sort_array(let(bits, lambda b: F.transform(h, lambda x, i: F.call_function("shiftleft", x, b).bitwiseOR(i.cast("long")))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(F.struct(packed.alias("s"), bits.alias("b"), h.alias("h")), covered))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, 0).otherwise(let(windows, counted)).cast("long")


def normal_line(line: Column) -> Column:
    """Lower case, runs of white space as one space, digits as 0: what counts as the same line."""
    return F.translate(F.lower(F.btrim(F.regexp_replace(line, SPACE_CLASS + "+", " "), F.lit(" "))), "123456789", "000000000")


def base_columns(docs: DataFrame) -> DataFrame:
    """Per row the base measures, its lines as hash and words, and a hash of all its words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = let(F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_SPACES)) != ""), lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"), F.transform(x, lambda line: F.struct(F.xxhash64(normal_line(line)).alias("hash"), F.size(words_of(line)).alias("words"))).alias("lines")))
    of_words = let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words"), F.xxhash64(w).alias("content")))
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("host"),
        F.length(F.translate(text, _SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        lines.alias("of_lines"),
        of_words.alias("of_words"),
        F.xxhash64("text").alias("tag"),
    )
    return out.select("doc_id", "tag", "host", "word_chars", "n_symbols", "of_lines.n_dup_lines", "of_lines.lines", "of_words.n_words", "of_words.n_repeat_words", "of_words.content")


def line_limits(base: DataFrame) -> DataFrame:
    """``(host, hash)`` of the lines above the limits.

    A document offers each line once; documents are told apart by the hash of
    all their words, here and in the host's own count, so a group of copies
    counts as one. Both counts are partial sums first, so a line that a
    third of all rows holds is no hot key.
    """
    hosts = base.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    offered = F.array_distinct(F.transform("lines", lambda x: x["hash"]))
    offers = base.select("host", "content", F.explode(offered).alias("hash")).distinct()
    counts = offers.groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") > LINE_DOCS)
    return counts.join(hosts, counts["host"].eqNullSafe(hosts["host"])).where(F.col("n") > F.col("docs") * LINE_SHARE).select(counts["host"], "hash")


def judged(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: base measures, verdict and the hashes of lines to take out.

    Columns: doc_id, tag, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_left, removed. A null text has no words
    and fails; a null source is a host of its own; rows that repeat are judged
    alike. Rows are known by ``doc_id`` and ``tag``, a hash of the text.
    """
    base = settle(base_columns(docs), "lines")
    limits = settle(line_limits(base), "limits")
    salt = F.pmod(F.xxhash64("doc_id", "tag"), F.lit(SALTS).cast("long"))
    spread = limits.select(F.coalesce("host", F.lit("")).alias("host_"), F.col("host").isNull().alias("none"), "hash", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    lines = base.select("doc_id", "tag", F.coalesce("host", F.lit("")).alias("host_"), F.col("host").isNull().alias("none"), salt.alias("salt"), F.explode("lines").alias("line"))
    lines = lines.select("*", F.col("line.hash").alias("hash")).join(spread, ["host_", "none", "salt", "hash"])
    lost = lines.groupBy(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("key"), "tag").agg(F.sum("line.words").alias("lost"), F.collect_set("hash").alias("removed"), F.count("*").alias("n_lost"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    # rows that repeat would each add their lines to the same key
    copies = base.groupBy(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("key"), "tag").agg(F.count("*").alias("copies"))
    lost = lost.join(copies, ["key", "tag"]).select("key", "tag", (F.col("lost") / F.col("copies")).cast("long").alias("lost"), "removed")
    out = base.withColumn("key", F.coalesce("doc_id", F.lit((1 << 63) - 1))).join(lost, ["key", "tag"], "left")
    out = out.withColumn("n_left", F.col("n_words") - F.coalesce("lost", F.lit(0))).withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (F.col("n_left") >= F.col("n_words") * LEFT_SHARE)
    return out.select("doc_id", "tag", "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "n_left", F.coalesce("removed", F.array().cast("array<long>")).alias("removed"))


def filtered(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows, and their texts without the lines above the limits.

    Lines go whole, with their line end; ``n_chars`` follows the text. A row
    that repeats stays as often as it came.
    """
    key, tag, gone_lines = (fresh(n, docs.columns) for n in ("_rule_key", "_rule_tag", "_rule_lines"))
    verdicts = judged(docs).where("kept").select(F.col("key").alias(key), F.col("tag").alias(tag), F.col("removed").alias(gone_lines)).dropDuplicates([key, tag])
    marked = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))).withColumn(tag, F.xxhash64("text"))
    kept = marked.join(verdicts.hint("merge"), [key, tag])
    gone = lambda x: F.array_contains(gone_lines, F.xxhash64(normal_line(x))) & (F.btrim(x, F.lit(_SPACES)) != "")
    left = F.filter(F.split("text", "\n"), lambda x: ~gone(x))
    kept = kept.withColumn("text", F.when(F.size(gone_lines) == 0, F.col("text")).otherwise(F.array_join(left, "\n")))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)

"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents all get the same expected number of copies. The whole part
is taken for certain; the fractional parts are paired, and each pair moves word
mass from one document to the other at random until one of them is integral, so
the source's expected words never change. Blocks of documents do this on their
own and pass on one document that is still fractional; these residuals meet in
the blocks of the next level, until one is left for each source.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labormart.llm.common import n_words, parts_for, settle

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MOST_COPIES = 2.0
#: Documents rounded by one task, and residuals that meet in one.
BLOCK_DOCS = 20_000
FAN_IN = 256


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = TOTAL_SHARE, most: float = MOST_COPIES) -> DataFrame:
    """``(source, docs, source_size, target)`` of ``sizes(source, size)``.

    Weights repeat over the sources in code point order, null last. A target
    stops at ``most`` times its source's words; the excess goes to the others
    by weight until none is above. Only sums reach the driver.
    """
    grouped = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    ordered = settle(
        grouped.orderBy(F.col("source").asc_nulls_last()).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("mono")),
        "sources",
    )
    before = ordered.groupBy("part").agg(F.count("*").alias("n"))  # one row for each partition of the sort
    before = before.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.col("before") + F.col("mono").bitwiseAND((1 << 33) - 1)
    weight: Column = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ranked = settle(ordered.join(before, "part").select("source", "docs", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("cap")), "weights")
    total, all_weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = share * float(total or 0)
    level = budget / all_weight if all_weight else 0.0
    while total:
        full = F.col("weight") * F.lit(level) >= F.col("cap")
        used, left = ranked.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        raised = (budget - float(used or 0)) / float(left) if left else level
        if raised <= level * (1 + 1e-15):
            break
        level = raised
    return ranked.select("source", "docs", "source_size", F.least(F.col("weight") * F.lit(level), F.col("cap")).alias("target"))


def round_block(sizes: np.ndarray, shares: np.ndarray, seed: int) -> np.ndarray:
    """Round the shares of documents of ``sizes`` words; at most one stays fractional.

    Pairs keep the sum of share times size. The document that is left, often a
    long one, is rounded at random as well; what that changes is taken back by
    turning over other documents, longest first, and the rest is left as the
    share of the shortest one that can carry it.
    """
    rng = np.random.default_rng(seed)
    out = shares.astype(float).copy()
    draws = rng.random(len(out) + 1)
    held, tiny = -1, 1e-9
    for j, size in enumerate(sizes.tolist()):
        if out[j] <= tiny or out[j] >= 1 - tiny:
            out[j] = round(out[j])
            continue
        if held < 0:
            held = j
            continue
        a, b, s = out[held], out[j], float(sizes[held])
        up, down = min((1 - a) * s, b * size), min(a * s, (1 - b) * size)
        if draws[j] * (up + down) < down:
            a, b = a + up / s, b - up / size
        else:
            a, b = a - down / s, b + down / size
        out[held], out[j] = a, b
        for k in (held, j):
            if out[k] <= tiny or out[k] >= 1 - tiny:
                out[k] = round(out[k])
        if out[held] in (0.0, 1.0):
            held = j if out[j] not in (0.0, 1.0) else -1
    if held < 0:
        return out
    taken = 1.0 if draws[-1] < out[held] else 0.0
    owed = (out[held] - taken) * float(sizes[held])  # words still to take (or to give back)
    before, out[held] = out[held], taken
    want = 0.0 if owed > 0 else 1.0  # documents that can be turned over
    kept = out.copy()
    last = -1
    for k in np.lexsort((rng.random(len(out)), -sizes)).tolist():
        if k != held and out[k] == want and sizes[k] <= abs(owed):
            out[k] = 1.0 - want
            owed += sizes[k] if want else -float(sizes[k])
    for k in np.argsort(sizes, kind="stable").tolist():
        if k != held and out[k] == want and sizes[k] > abs(owed):
            last = k
            break
    if abs(owed) <= tiny:
        return out
    if last < 0:  # no document can carry the rest: keep the pairs' own result
        kept[held] = before
        return kept
    out[last] = want + owed / sizes[last]
    return out


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = TOTAL_SHARE, most: float = MOST_COPIES, seed: int = 17, extra: dict[str, Column] | None = None) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)`` for every row of ``docs``.

    ``copies`` is a whole number of at most ``most``, ``taken`` the words of all
    copies. A null text has no words and is never taken; null sources form one
    source. Rows that repeat count as documents of their own. Every choice
    follows from the documents' own values and ``seed``, so reruns agree. ``extra``
    names further columns of ``docs`` to carry along.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), n_words(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("item"), *[c.alias(n) for n, c in (extra or {}).items()])
    rows = settle(rows, "sizes")
    targets = settle(source_targets(rows, weights, share, most), "targets")
    # null-safe joins cannot be hashed on one key as simply as a marked string
    tag = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    targets = targets.withColumn("tag", tag).withColumn("mean", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).drop("source")
    full = rows.withColumn("tag", tag).join(targets, "tag")
    certain = F.floor(F.col("mean") + 1e-9)
    full = full.withColumn("certain", F.when(F.col("size") > 0, certain).otherwise(0).cast("long")).withColumn("share", F.when(F.col("size") > 0, F.greatest(F.col("mean") - certain, F.lit(0.0))).otherwise(0.0))
    blocks = F.ceil(F.col("docs") / BLOCK_DOCS)
    open_ = full.where("share > 1e-9").select("tag", "item", "doc_id", "size", "share", F.pmod(F.xxhash64("doc_id", F.lit(seed)), blocks).alias("block"))

    def rounder(level: int):
        def rounded(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["size", "doc_id", "item"], ascending=[False, True, True])
            entropy = int(pd.util.hash_array(np.array([f"{key[0]}|{key[1]}|{level}|{seed}"], object))[0])
            return pdf.assign(share=round_block(pdf["size"].to_numpy(), pdf["share"].to_numpy(), entropy))

        return rounded

    schema = "tag string, item long, doc_id long, size long, share double, block long"
    decided: list[DataFrame] = []
    most_blocks = int(targets.agg(F.max(F.ceil(F.col("docs") / BLOCK_DOCS))).first()[0] or 0)
    level = 0
    while most_blocks:
        result = settle(open_.groupBy("tag", "block").applyInPandas(rounder(level), schema), "rounded")
        fractional = (F.col("share") > 0) & (F.col("share") < 1)
        if most_blocks == 1:
            coin = F.pmod(F.xxhash64("tag", "doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
            decided.append(result.select("item", F.when(fractional, (coin < F.col("share")).cast("long")).otherwise(F.col("share").cast("long")).alias("more")))
            break
        decided.append(result.where(~fractional).select("item", F.col("share").cast("long").alias("more")))
        open_ = result.where(fractional).withColumn("block", F.floor(F.col("block") / FAN_IN))
        most_blocks = parts_for(most_blocks, FAN_IN)
        level += 1
    more = list(extra or {})
    base = full.select("doc_id", "source", "size", "source_size", "target", "certain", "item", *more)
    if not decided:
        return base.select("doc_id", "source", "size", "source_size", "target", F.col("certain").alias("copies"), (F.col("certain") * F.col("size")).alias("taken"), *more)
    extra = decided[0]
    for d in decided[1:]:
        extra = extra.unionByName(d)
    copies = F.col("certain") + F.coalesce(F.col("more"), F.lit(0))
    return base.join(extra, "item", "left").select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), *more)


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = TOTAL_SHARE, most: float = MOST_COPIES, seed: int = 17) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; columns as they are.

    Rows without words carry no mass and leave. Rows are joined to their copies
    by ``doc_id`` and a hash of the text, of which repeated rows share the sum.
    """
    found = mix_sources(docs.withColumn("doc_id", F.col("doc_id").cast("long")), weights, share, most, seed, extra={"_mix_tag": F.xxhash64("text", "source")})
    whole = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    copies = found.groupBy(whole.alias("_mix_id"), "_mix_tag").agg(F.sum("copies").cast("int").alias("_mix_copies"), F.count("*").alias("_mix_rows")).where("_mix_copies > 0")
    keyed = docs.withColumn("_mix_id", whole).withColumn("_mix_tag", F.xxhash64("text", "source"))
    joined = keyed.join(copies.hint("merge"), ["_mix_id", "_mix_tag"])
    several = F.col("_mix_rows") > 1
    # rows that repeat are one row with all their copies
    once = joined.where(~several).unionByName(joined.where(several).dropDuplicates(["_mix_id", "_mix_tag"]))
    return once.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*docs.columns)

"""Prefix trie of conversations by whole-sequence collapse.

Identical conversations become one weighted sequence with the list of those
that end there; a sequence that is a proper prefix of another is no leaf
(anti-join); the prefixes of the weighted sequences, aggregated, are the nodes.
A prefix is known by two 64-bit hashes of its turns and their places, combined
by exclusive or, so prefixes of a long conversation are made block by block.

Sums over subtrees need no walk level by level. A node belongs to the smallest
sequence through it, so the nodes of one sequence are a chain down to its end.
What lies below a node is the rest of its own chain plus the whole chains that
leave the other sequences through it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labormart.llm.common import settle
from labormart.llm.turns import block_of, blocks_upto, digest, in_order, part_of, part_starts, position

#: Conversations that share the turns of one: those with the same id but for this remainder.
KIN = 5
#: The head taken from there has fewer turns than this.
HEAD = 9
#: Ids of one part of an end list.
END_IDS = 4096

_NODE = ["depth", "p1", "p2"]


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % HEAD


def root_of(conv_id: Column) -> Column:
    return conv_id - conv_id % KIN


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``turns(conv_id, depth, d1, d2, bytes)`` of every rebuilt conversation, and all ``conv_id``.

    A conversation begins with the first turns of its root, as many as
    ``head_length`` says, and goes on with its own turns after as many. Null
    roles and texts are empty, rows without ``conv_id`` are left out, equal turns
    go by a hash of role and text. Columns other than these four play no part.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), digest(1, role, text).alias("d1"), digest(2, role, text).alias("d2"), F.octet_length(text).cast("long").alias("bytes")
    )
    ordered = in_order(rows, "ordered")
    starts = part_starts(ordered)
    convs = starts.groupBy("conv_id").agg(F.max("n_turns").alias("n_turns")).withColumns({"h": head_length(F.col("conv_id")), "root": root_of(F.col("conv_id"))})
    kin = convs.groupBy(F.col("root").alias("conv_id")).agg(F.collect_set("conv_id").alias("kin"))
    roots = convs.select(F.col("conv_id").alias("root"), F.col("n_turns").alias("n_root"))
    heads = convs.join(roots, "root", "left").select("conv_id", "h", F.least("h", F.coalesce("n_root", F.lit(0))).alias("n_head"))
    numbered = ordered.join(starts.join(heads, "conv_id").join(kin, "conv_id", "left").withColumnRenamed("part", "_part").withColumnRenamed("conv_id", "_conv"), (F.col("conv_id") == F.col("_conv")) & (part_of() == F.col("_part")))
    at = F.col("at")
    numbered = numbered.withColumn("at", position())
    own = F.when(at > F.col("h"), F.array(F.struct(F.col("conv_id").alias("conv_id"), (F.col("n_head") + at - F.col("h")).alias("depth"))))
    none = F.array().cast("array<struct<conv_id:bigint,depth:bigint>>")
    sharing = F.filter(F.coalesce("kin", F.array().cast("array<bigint>")), lambda c: head_length(c) >= at)
    lent = F.when(at < HEAD, F.transform(sharing, lambda c: F.struct(c.alias("conv_id"), at.alias("depth"))))
    out = numbered.select(F.explode(F.concat(F.coalesce(own, none), F.coalesce(lent, none))).alias("t"), "d1", "d2", "bytes")
    return out.select("t.conv_id", "t.depth", "d1", "d2", "bytes"), convs.select("conv_id")


def _prefixes(turns: DataFrame) -> DataFrame:
    """``(conv_id, depth, block, p1, p2, q1, q2, bytes)``: each prefix, and ``q`` the one before it."""
    turns = turns.withColumns({"block": block_of(F.col("depth")), "x1": F.xxhash64(F.lit(11), "depth", "d1"), "x2": F.xxhash64(F.lit(12), "depth", "d2")})
    so_far = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    runs = turns.select("conv_id", "depth", "block", "x1", "x2", "bytes", F.bit_xor("x1").over(so_far).alias("r1"), F.bit_xor("x2").over(so_far).alias("r2"))
    runs = settle(runs, "runs")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = runs.groupBy("conv_id", "block").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    carry = blocks.select("conv_id", "block", F.bit_xor("x1").over(earlier).alias("c1"), F.bit_xor("x2").over(earlier).alias("c2")).where("block > 0")
    made = runs.join(carry, ["conv_id", "block"], "left")
    p1, p2 = (F.col(f"r{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0).cast("long"))) for i in (1, 2))
    made = made.select("conv_id", "depth", "block", p1.alias("p1"), p2.alias("p2"), "x1", "x2", "bytes")
    return made.select("conv_id", "depth", "block", "p1", "p2", F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"), "bytes")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """``(depth, p1, p2, ends_sha256)`` of the conversations that end at each prefix, ids in order.

    Lists are cut into parts of bounded size; the parts of a list then stream
    through one hash, so no list is ever held whole.
    """
    part = F.floor(F.col("conv_id") / F.lit(END_IDS)).alias("part")
    parts = ends.groupBy(*_NODE, part).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    sorted_ = parts.repartition(*_NODE).sortWithinPartitions(*_NODE, "part").select(*_NODE, "ids")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for d, a, b, ids in zip(*columns, strict=True):
                if key == (d, a, b):
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (d, a, b), hashlib.sha256(ids.encode())
            yield _rows(done)
            done = []
        if key is not None:
            yield _rows([(*key, state.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], kinds[i]) for i in range(4)], [*_NODE, "ends_sha256"])

    return sorted_.mapInArrow(hashed, "depth long, p1 long, p2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)``: see the module. Repeated rows are turns like
    others, empty conversations end at the root, and an empty table has no node.
    """
    turns, convs = rebuilt_turns(conversations)
    return trie_of(turns, convs)


def trie_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of ``turns(conv_id, depth, d1, d2, bytes)`` of the conversations ``convs(conv_id)``."""
    zero = F.lit(0).cast("long")
    prefixes = _prefixes(turns)
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct("depth", "p1", "p2")).alias("end"))
    ends = convs.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(f"end.{c}", zero).alias(c) for c in _NODE])
    ends = settle(ends, "ends")
    # identical conversations are one sequence, known by its smallest member
    sequences = ends.groupBy(*_NODE).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id")).withColumnRenamed("depth", "len")
    each_block = sequences.select("conv_id", "len", "weight", F.explode(blocks_upto(F.col("len"))).alias("block"))
    below = prefixes.join(each_block, ["conv_id", "block"])
    columns = ["conv_id", "block", *_NODE, "q1", "q2", "bytes", "weight", "len"]
    root = sequences.select("conv_id", F.lit(0).alias("block"), zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), F.lit(None).cast("long").alias("q1"), F.lit(None).cast("long").alias("q2"), zero.alias("bytes"), "weight", "len")
    paths = settle(below.select(*columns).unionByName(root), "paths")
    # leaves: sequences that are no proper prefix of another
    inner = paths.where("depth < len").select(F.col("depth").alias("len"), "p1", "p2").distinct()
    leaves = sequences.join(inner, ["len", "p1", "p2"], "left_anti").select("conv_id", F.explode(blocks_upto(F.col("len"))).alias("block"), F.lit(1).alias("leaf"))
    nodes = (
        paths.join(leaves, ["conv_id", "block"], "left")
        .groupBy(*_NODE)
        .agg(F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.coalesce("leaf", zero)).alias("n_leaves"), F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.max("bytes").alias("bytes"))
    )
    nodes = settle(nodes.withColumns({"block": F.greatest(block_of(F.col("depth")), F.lit(0)), "saves": (F.col("n_convs") - 1) * F.col("bytes")}), "nodes")
    top_conv = nodes.where("depth = 0").select("conv_id").first()
    if top_conv is None:
        return convs.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    # chains: the nodes of one sequence, summed from the end upwards, block by block
    by_conv = Window.partitionBy("conv_id")
    blocks = nodes.groupBy("conv_id", "block").agg(F.sum("saves").alias("saves"), F.min("depth").alias("low"))
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("saves").over(by_conv.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)), zero).alias("after"), F.min("low").over(by_conv).alias("top"), F.sum("saves").over(by_conv).alias("total"))
    downward = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    own = nodes.withColumn("rest", F.sum("saves").over(downward)).join(blocks.select("conv_id", "block", "after", "top"), ["conv_id", "block"])
    own = own.select(*_NODE, "conv_id", "n_convs", "n_leaves", (F.col("rest") + F.col("after")).alias("rest"), "top", "q1", "q2")
    chains = blocks.select("conv_id", "top", "total").distinct().where("top > 0").select("conv_id", "top", "total", F.explode(blocks_upto(F.col("top") - 1)).alias("block"))
    hanging = paths.join(chains, ["conv_id", "block"]).where("depth < top").groupBy(*_NODE).agg(F.sum("total").alias("hang"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    # inside a chain the parent has the same owner; only a chain's top asks for another's
    tops = own.where("depth = top AND depth > 1").select(*_NODE, "q1", "q2")
    owners = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent"))
    tops = tops.join(owners, ["depth", "q1", "q2"]).select(*_NODE, "parent")
    own = own.select(*_NODE, "conv_id", "n_convs", "n_leaves", "rest", F.when(F.col("depth") == 1, F.lit(top_conv[0])).when(F.col("depth") > F.col("top"), F.col("conv_id")).alias("parent"))
    every = own
    for more in (hanging, children, tops, _end_hashes(ends)):
        every = every.unionByName(more, allowMissingColumns=True)
    joined = every.groupBy(*_NODE).agg(*[F.max(c).alias(c) for c in ("conv_id", "n_convs", "n_leaves", "rest", "hang", "n_children", "parent", "ends_sha256")])
    return joined.select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
        (F.col("rest") + F.coalesce("hang", zero)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )

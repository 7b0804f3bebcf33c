"""Shared pieces of the operators: inputs, settled intermediate tables, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a Java character class.
SPACE_CLASS = r"[ \t\n\x0B\f\r]"
WORD = r"[^ \t\n\x0B\f\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one machine, may leave
    it unset; then a temporary folder takes its place.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", path := tempfile.mkdtemp(prefix="llm-scratch-"))
    return path


_SCOPE: ContextVar[str | None] = ContextVar("labormart_scratch_scope", default=None)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever store it lies; one that is not there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Tables that ``settle`` writes inside the block go when it ends.

    Write the result inside the block, outside the scope (``write_table``): a
    result that is still to be computed would miss its inputs afterwards.
    """
    path = f"{scratch_root(spark)}/llm-scope-{uuid.uuid4().hex}"
    token = _SCOPE.set(path)
    try:
        yield path
    finally:
        _SCOPE.reset(token)
        remove(spark, path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and return the written table."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` into the shared folder and return the written table.

    Cuts the lineage: a lost executor costs at most the tasks after this point,
    and values such as generated row numbers stay the same for all readers. The
    table stays until the ``scratch_scope`` around ends, if there is one.
    """
    return write_table(df, f"{_SCOPE.get() or scratch_root(df.sparkSession)}/llm-{label}-{uuid.uuid4().hex}")


def fresh(name: str, columns: list[str]) -> str:
    """``name``, with underscores added until it is none of ``columns`` (in any case): inner columns never hide given ones."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def n_words(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def parts_for(rows: int, per_part: int) -> int:
    return max(1, -(-int(rows) // per_part))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, component)``.

    ``component`` is the smallest node of the component. Alternates large-star
    and small-star steps, each a group-by on the nodes; every step is settled
    and a round without a change ends the loop. Nodes can be of any ordered
    type. A hub with many neighbours is only ever aggregated by ``min`` and
    joined, never gathered into an array.
    """
    cur = settle(edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    if cur.isEmpty():
        return cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    mark = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    last = mark(cur)
    while True:
        # large star: every larger neighbour of a node moves to the node's smallest one
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the smaller neighbours of a node move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        nxt = settle(small.select("e.u", "e.v").where("u <> v").distinct(), label)
        now = mark(nxt)
        if now == last:
            break
        cur, last = nxt, now
    stars = cur.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)

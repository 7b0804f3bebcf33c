"""Places of rows within groups of any size, without sorting a whole group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labormart.session import materialize


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str = "place") -> DataFrame:
    """``rows`` with ``name``: the place (from 0) in the order ``order`` within each ``keys`` group.

    Rows are dealt by range of (keys, order), so a group that holds a third of
    all rows spans many tasks; each counts the rows of a group that earlier
    partitions hold (one row per group and partition) and adds the place within
    its own. Equal rows are told apart by their place in the input. The dealt
    rows are written once: the places must be those of one dealing.
    """
    columns = rows.columns
    dealt = rows.withColumn("_copy", F.monotonically_increasing_id())
    sort = [*keys, *order, "_copy"]
    dealt = dealt.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("_copy").withColumn("_at", F.monotonically_increasing_id())
    dealt = materialize(rows.sparkSession, dealt, "numbered")
    part = F.shiftright("_at", 33).cast("int").alias("_part")
    counts = dealt.groupBy(*keys, part).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    starts = starts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_part", "_first", "_before")
    same = F.col("_part") == F.shiftright("_at", 33).cast("int")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return dealt.join(starts, same).select(*columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias(name))

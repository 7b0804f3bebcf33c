"""Turns of conversations in order, also where one conversation holds a large part of all rows.

Rows are dealt by range of conversation and turn, so a long conversation spans
several partitions; a number that rises through all of them gives its order,
and the counts of each partition give positions without a window over a whole
conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labormart.llm.common import settle

#: Turns of one conversation that are handled together.
BLOCK = 4096


def digest(which: int, role: Column, text: Column) -> Column:
    """One of several independent 64-bit hashes of a turn."""
    return F.xxhash64(F.lit(which), role, text)


def in_order(rows: DataFrame, label: str) -> DataFrame:
    """``rows(conv_id, turn, d1, d2, …)``, settled, with ``place`` rising in order of turn.

    Null turns come first; equal turns go by the hashes of role and text. ``place``
    rises through the whole table, so the rows of a conversation stay in order
    wherever they are dealt next.
    """
    rows = rows.withColumn("_copy", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "d1", "d2", "_copy"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_copy")
    return settle(dealt.withColumn("place", F.monotonically_increasing_id()), label)


def part_of(place: str = "place") -> Column:
    return F.shiftright(place, 33).cast("int")


def part_starts(ordered: DataFrame) -> DataFrame:
    """``(conv_id, part, first, before, n_turns)``: where a conversation begins in each partition.

    ``before`` counts its rows in earlier partitions. One row per conversation
    and partition.
    """
    parts = ordered.groupBy("conv_id", part_of().alias("part")).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    by_conv = Window.partitionBy("conv_id")
    before = F.coalesce(F.sum("n").over(by_conv.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return parts.select("conv_id", "part", "first", before.alias("before"), F.sum("n").over(by_conv).alias("n_turns"))


def position() -> Column:
    """Place of a turn in its conversation, from 1, where its row meets ``part_starts``."""
    return F.col("place") - F.col("first") + F.col("before") + 1


def block_of(position: Column) -> Column:
    return F.floor((position - 1) / F.lit(BLOCK)).cast("int")


def blocks_upto(position: Column) -> Column:
    """All blocks up to that of ``position``; block 0 also holds the place before the first turn."""
    return F.sequence(F.lit(0), F.greatest(block_of(position), F.lit(0)))

"""A13/A14/C11/C12 over any window of days, from dyadic blocks.

Level ``l`` cuts the calendar into blocks of 2^l days; a block stores the exact
sums of its days. Any window is made up of at most two blocks a level, so a
report over ``n`` days reads O(log n) blocks instead of ``n`` days. Blocks add
up like the days do, so a changed day adds its difference to one block a level.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels of blocks: the largest spans 2^LEVELS - 1 … days, some 44 years.
LEVELS = 15


def day_number(day: Column | str) -> Column:
    return F.unix_date(F.col(day) if isinstance(day, str) else day)


def dyadic_blocks(daily: DataFrame, keys: list[str], measures: list[str], day: str = "dt", levels: int = LEVELS) -> DataFrame:
    """``(level, block, keys…, measures…)``: sums of every block that holds a row.

    Rows are summed by day first; then each day's sums go to one block a level.
    Blocks without anything left are left out.
    """
    level = daily.groupBy(F.lit(0).alias("level"), day_number(day).cast("long").alias("block"), *keys).agg(*[F.sum(m).cast("long").alias(m) for m in measures])
    rows = level.select("level", "block", *keys, *measures)
    at = F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))
    spread = rows.select(at.alias("_level"), "block", *keys, *measures)
    cut = F.call_function("shiftright", F.col("block"), F.col("_level"))
    added = spread.groupBy(F.col("_level").alias("level"), cut.alias("block"), *keys).agg(*[F.sum(m).alias(m) for m in measures])
    some = F.lit(False)
    for m in measures:
        some |= F.col(m) != 0
    return added.where(some)


def merged_blocks(*blocks: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Blocks added up: stored ones and the difference of the days that changed."""
    rows = blocks[0]
    for more in blocks[1:]:
        rows = rows.unionByName(more)
    added = rows.groupBy("level", "block", *keys).agg(*[F.sum(m).alias(m) for m in measures])
    some = F.lit(False)
    for m in measures:
        some |= F.col(m) != 0
    return added.where(some)


def cover(first: Column, last: Column, levels: int = LEVELS) -> Column:
    """The blocks, as ``array<struct<level,block>>``, that make up the days ``first`` to ``last``, both included.

    Level by level the borders that stand alone are taken and the rest is
    halved; beyond the highest level its blocks are taken one by one. A window
    that ends before it begins has none.
    """
    none = F.array().cast("array<struct<level:int,block:bigint>>")
    start = F.struct(day_number(first).cast("long").alias("a"), (day_number(last) + 1).cast("long").alias("b"), none.alias("t"))
    block = lambda l, n: F.array(F.struct(l.cast("int").alias("level"), n.cast("long").alias("block")))  # noqa: E731, E741

    def step(acc: Column, l: Column) -> Column:  # noqa: E741
        a, b = acc["a"], acc["b"]
        left = F.when((a < b) & (a.bitwiseAND(F.lit(1)) == 1), block(l, a)).otherwise(none)
        a2 = a + F.when((a < b) & (a.bitwiseAND(F.lit(1)) == 1), 1).otherwise(0)
        right = F.when((a2 < b) & (b.bitwiseAND(F.lit(1)) == 1), block(l, b - 1)).otherwise(none)
        b2 = b - F.when((a2 < b) & (b.bitwiseAND(F.lit(1)) == 1), 1).otherwise(0)
        half = lambda x: F.call_function("shiftright", x, F.lit(1))
        return F.struct(half(a2).alias("a"), half(b2).alias("b"), F.concat(acc["t"], left, right).alias("t"))

    top = F.lit(levels - 1)

    def finish(acc: Column) -> Column:
        rest = F.when(acc["a"] < acc["b"], F.sequence(acc["a"], acc["b"] - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.concat(acc["t"], F.transform(rest, lambda n: F.struct(top.cast("int").alias("level"), n.alias("block"))))

    return F.aggregate(F.sequence(F.lit(0), F.lit(levels - 2)), start, step, finish)


def cover_of(first: _dt.date, last: _dt.date, levels: int = LEVELS) -> list[tuple[int, int]]:
    """:func:`cover` of two given days, for a filter on the stored blocks' partitions."""
    a, b, out = (first - _dt.date(1970, 1, 1)).days, (last - _dt.date(1970, 1, 1)).days + 1, []
    for level in range(levels - 1):
        if a < b and a & 1:
            out.append((level, a))
            a += 1
        if a < b and b & 1:
            b -= 1
            out.append((level, b))
        a, b = a >> 1, b >> 1
    return out + [(levels - 1, n) for n in range(a, b)]


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Blocks partitioned by level and block: a window's report lists and reads its own blocks only."""
    blocks.repartition("level", "block").write.mode("overwrite").partitionBy("level", "block").parquet(path)


def window_sums(blocks: DataFrame, first: _dt.date, last: _dt.date, keys: list[str], measures: list[str], levels: int = LEVELS) -> DataFrame:
    """``(keys…, measures…)`` over the days ``first`` to ``last``, from the O(log days) blocks that make them up."""
    wanted = F.lit(False)
    by_level: dict[int, list[int]] = {}
    for level, block in cover_of(first, last, levels):
        by_level.setdefault(level, []).append(block)
    for level, numbers in by_level.items():
        wanted |= (F.col("level") == level) & F.col("block").isin(numbers)
    return blocks.where(wanted).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def sums_of_windows(blocks: DataFrame, windows: DataFrame, window_id: str, first: str, last: str, keys: list[str], measures: list[str], levels: int = LEVELS) -> DataFrame:
    """``(window_id, keys…, measures…)`` for many windows at once, by an equi-join on (level, block)."""
    taken = windows.select(window_id, F.explode(cover(F.col(first).cast("date"), F.col(last).cast("date"), levels)).alias("_c")).select(window_id, "_c.level", "_c.block")
    return blocks.join(taken, ["level", "block"]).groupBy(window_id, *keys).agg(*[F.sum(m).alias(m) for m in measures])

"""Exchange rates: as-of fill over a day spine and the rate lookup table.

The as-of fill is a blocked prefix scan: observations are ordered within
(key, year) blocks by a partitioned window, and the first observation of a
later block is carried across block borders through a per-key block summary.
No window runs without a partition key and no step emits pairs of rows of
the data; the block summary is bounded by the calendar (years per key).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labormart.functions.dates import to_day


def _day_value(v: Column | str | _dt.date) -> Column:
    if isinstance(v, Column):
        return v.cast("date")
    return to_day(v)


def next_observation_day(obs: DataFrame, keys: list[str], day_col: str) -> DataFrame:
    """Add ``_next_day``: the smallest later ``day_col`` of the same key, or NULL.

    ``obs`` must hold at most one row per (keys, day).
    """
    cols = obs.columns
    if not keys:
        # One series: a constant key keeps every step an equi-join; windows
        # still partition by year.
        obs, keys = obs.withColumn("_series", F.lit(0)), ["_series"]
    with_blk = obs.withColumn("_blk", F.year(F.col(day_col)))
    w = Window.partitionBy(*keys, "_blk").orderBy(F.col(day_col))
    within = with_blk.withColumn("_lead", F.lead(F.col(day_col)).over(w))

    # First day of every (key, block); each block offers its first day to all
    # earlier blocks of the key, the nearest one wins. Rows emitted are
    # bounded by (years per key)^2 / 2, independent of data volume.
    firsts = with_blk.groupBy(*keys, "_blk").agg(F.min(F.col(day_col)).alias("_first"))
    lows = with_blk.groupBy(*keys).agg(F.min("_blk").alias("_bmin"))
    offers = firsts.join(lows, keys, "inner").where(F.col("_blk") > F.col("_bmin"))
    carry = (
        offers.select(
            *keys,
            F.explode(F.sequence(F.col("_bmin"), F.col("_blk") - 1)).alias("_to_blk"),
            F.col("_first"),
        )
        .groupBy(*keys, "_to_blk")
        .agg(F.min("_first").alias("_carry"))
        .withColumnRenamed("_to_blk", "_blk")
    )
    out = within.join(carry, [*keys, "_blk"], "left")
    return out.select(*cols, F.coalesce(F.col("_lead"), F.col("_carry")).alias("_next_day"))


def asof_fill(
    obs: DataFrame,
    keys: list[str],
    day_col: str,
    end: Column | str | _dt.date,
    start: Column | str | _dt.date | None = None,
    out_col: str = "dt",
) -> DataFrame:
    """Backward as-of fill: every day up to ``end`` takes the latest observation on or before it.

    ``obs`` holds one row per (keys, ``day_col``). Output: one row per
    (keys, ``out_col``) for each day from the key's first observation (or
    ``start``) to ``end``, carrying the observation's columns; ``day_col`` keeps
    the day the values come from. Days before a key's first observation have
    no row (inner as-of); there is no lookback limit. A NULL ``end`` or ``start``
    asks for no days.
    """
    end_c = _day_value(end)
    nxt = next_observation_day(obs, keys, day_col)
    last = F.least(F.coalesce(F.date_sub(F.col("_next_day"), 1), end_c), end_c)
    first = F.col(day_col) if start is None else F.greatest(F.col(day_col), _day_value(start))
    # an empty request has no bounds, and then no days: least and greatest would skip the NULL
    asked = end_c.isNotNull() if start is None else end_c.isNotNull() & _day_value(start).isNotNull()
    filled = nxt.where(asked & (first <= last)).withColumn(
        out_col, F.explode(F.sequence(first, last, F.expr("interval 1 day")))
    )
    return filled.drop("_next_day")


def rate_lookup(rates: DataFrame) -> DataFrame:
    """(char_code, dt) → array of distinct (value, nominal) quotes.

    Rate facts are append-only in the reference preset, so one day may hold
    repeated quotes. Grouping them here lets the salary step keep exactly one
    row per distinct resulting salary (the source's DISTINCT) without a
    shuffle of the vacancy rows.
    """
    return rates.groupBy("char_code", "dt").agg(
        F.array_sort(F.collect_set(F.struct("value", "nominal"))).alias("quotes")
    )

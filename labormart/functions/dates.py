"""Date and time expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_day(value: str | _dt.date | _dt.datetime | Column) -> Column:
    """A DATE literal from a date, datetime or ISO text (also ``yyyy/MM/dd``)."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        return F.lit(value)
    text = str(value).replace("/", "-")
    return F.lit(_dt.date.fromisoformat(text[:10]))


def as_date(value: str | _dt.date | _dt.datetime) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value).replace("/", "-")[:10])


def local_timestamp(col: Column | str) -> Column:
    """ISO text with or without an offset → wall-clock TIMESTAMP_NTZ (offset dropped)."""
    return _c(col).cast("timestamp_ntz")


def week_start(col: Column | str) -> Column:
    """Monday of the ISO week, as DATE."""
    return F.trunc(_c(col).cast("date"), "week")


def prev_day(col: Column | str | _dt.date) -> Column:
    """The day before (``current_date - interval 1 day`` with ``as_of`` explicit)."""
    c = F.lit(col) if isinstance(col, _dt.date) else _c(col)
    return F.date_sub(c, 1)


def caption_date(col: Column | str) -> Column:
    """``dd.MM.yyyy`` text for captions."""
    return F.date_format(_c(col), "dd.MM.yyyy")


def day_spine(
    spark: SparkSession,
    start: Column | str | _dt.date,
    end: Column | str | _dt.date,
    name: str = "dt",
) -> DataFrame:
    """Inclusive one-row-per-day sequence; empty when ``start`` is after ``end``.

    Bounds may be literals or one-row columns; the sequence is generated on an
    executor (``explode(sequence)``), never collected.
    """
    s = to_day(start) if not isinstance(start, Column) else start.cast("date")
    e = to_day(end) if not isinstance(end, Column) else end.cast("date")
    base = spark.range(1).select(s.alias("_s"), e.alias("_e"))
    return base.select(F.explode(_days_between(F.col("_s"), F.col("_e"))).alias(name))


def _days_between(s: Column, e: Column) -> Column:
    """Inclusive day sequence, an empty array when ``s`` is after ``e``.

    The guard sits inside the expression: with literal bounds Catalyst folds
    the sequence while optimizing, before any filter could apply.
    """
    return F.when(s <= e, F.sequence(s, e, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>")
    )


def day_spine_from(bounds: DataFrame, start_col: str, end_col: str, name: str = "dt") -> DataFrame:
    """Day spine whose bounds come from a (one-row) DataFrame computed by Spark."""
    return bounds.select(
        F.explode(_days_between(F.col(start_col).cast("date"), F.col(end_col).cast("date"))).alias(name)
    )

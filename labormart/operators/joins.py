"""Join helpers: broadcast only behind a size check, shuffle join otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labormart.session import materialize

# A side is broadcast only when it takes at most so many bytes: by Catalyst's
# estimate where that is an upper bound, else by the files it was written to.
BROADCAST_MAX_BYTES = 32 * 1024 * 1024

# plan nodes that can emit more rows than they read, so that the planner's
# size estimate is no upper bound
_ROW_MULTIPLYING = ("Generate ", "Expand ", "Join Cross", "Join Inner", "Join LeftOuter", "Join RightOuter", "Join FullOuter")


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (no job runs), or None."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size if isinstance(size, int) else size.toString())
    except Exception:  # noqa: BLE001 - estimates are optional (e.g. Spark Connect)
        return None


def _estimate_is_bound(df: DataFrame) -> bool:
    try:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    except Exception:  # noqa: BLE001
        return False
    return not any(tok in plan for tok in _ROW_MULTIPLYING)


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when it takes at most ``max_bytes``.

    Scans, filters, projections and aggregates never grow past Catalyst's size
    estimate, so for a plan made of those an estimate that is small enough decides
    and no job runs. Other plans, and those whose bound is larger than what they
    may hold (distinct values of a large table, rows that have no statistics), are
    written once, under the shared checkpoint folder; the
    files' size decides, and the join reads the files instead of computing the
    rows again. A larger side is returned without the mark and Spark plans a
    shuffle join, where AQE can still split skewed partitions.
    """
    est = estimated_bytes(df)
    if est is None or est > max_bytes or not _estimate_is_bound(df):
        df = materialize(df.sparkSession, df, "join-side")
        est = estimated_bytes(df)
    return F.broadcast(df) if est is not None and est <= max_bytes else df


def semi_join_days(rows: DataFrame, days: DataFrame, cols: list[str]) -> DataFrame:
    """``rows`` whose ``cols`` (days, or dimension × day slices) stand in ``days``.

    The distinct values are the side that is broadcast, after its size check.
    """
    return rows.join(broadcast_if_small(days.select(*cols).distinct()), cols, "left_semi")


def distinct_values(df: DataFrame, col: str):
    """Distinct values of ``col`` as one sorted array column, evaluated once as a scalar subquery.

    For partition values of tables and members of dimensions: as many as there
    are days in the calendar, or rows in a dimension, at any data volume. They
    are collected from partial sets, so rows never meet in one task.
    """
    return df.select(col).distinct().agg(F.array_sort(F.collect_set(col))).scalar()

"""Keyed upsert, insert-if-absent and partition replacement on DataFrames.

Plain Parquet has no MERGE, so an upsert is a full outer join of the target
rows that can conflict with the source (only the partitions the source
touches) and the source, choosing per column by a presence flag: an incoming
NULL overwrites. Rows of untouched partitions pass through unchanged and are
never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labormart.operators.joins import broadcast_if_small, distinct_values
from labormart.operators.parse import dedup_versions


def _touched(target: DataFrame, source: DataFrame, partition_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Split ``target`` into rows inside / outside the partitions present in ``source``.

    With one partition column the split is a filter on a scalar subquery (the
    source's distinct values): on a partitioned table it lands in the scan's
    partition filters, so only the touched partitions are listed and read.
    Several columns (dimension × day slices) use a semi and an anti join.
    ``source`` is read for its days and again for the merge: callers pass rows
    that are written already.
    """
    if len(partition_cols) == 1:
        col = partition_cols[0]
        hit = F.array_contains(distinct_values(source, col), F.col(col))
        return target.where(hit), target.where(F.coalesce(~hit, F.lit(True)))
    parts = broadcast_if_small(source.select(*partition_cols).distinct())
    inside = target.join(parts, partition_cols, "left_semi")
    outside = target.join(parts, partition_cols, "left_anti")
    return inside, outside


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
    partition_cols: list[str] | None = None,
    on_duplicate: str | None = "error",
    ts_col: str = "update_ts",
) -> DataFrame:
    """``INSERT … ON CONFLICT (keys) DO UPDATE SET update_cols = EXCLUDED.…``.

    Returns the whole new table (target column order). New keys are
    inserted; for existing keys ``update_cols`` (default: all non-key
    columns) take the source values, NULLs included; other columns keep the
    target's; target keys absent from the source stay as they are. Two
    source rows with one key fail the job (``on_duplicate="error"``) or
    resolve to the latest by ``ts_col`` (``"latest"``); ``None`` skips the
    check when the caller already guarantees unique keys.

    ``partition_cols`` (subset of ``keys``) limits the join to the target
    partitions the source touches; use :func:`upsert_partitions` to get only
    those rows for a partition overwrite.
    """
    merged, untouched = _merge(target, source, keys, update_cols, partition_cols, on_duplicate, ts_col)
    out = merged if untouched is None else merged.unionByName(untouched)
    return out.select(*target.columns)


def upsert_partitions(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    partition_cols: list[str],
    update_cols: list[str] | None = None,
    on_duplicate: str | None = "error",
    ts_col: str = "update_ts",
) -> DataFrame:
    """Only the rows of the partitions ``source`` touches, after the upsert (for a dynamic overwrite)."""
    merged, _ = _merge(target, source, keys, update_cols, partition_cols, on_duplicate, ts_col)
    return merged


def _merge(target, source, keys, update_cols, partition_cols, on_duplicate, ts_col):
    cols = target.columns
    value_cols = [c for c in cols if c not in keys]
    update_cols = value_cols if update_cols is None else list(update_cols)
    src = source.select(*[c for c in cols if c in source.columns])
    if on_duplicate is not None:
        src_values = [c for c in src.columns if c not in keys and c != ts_col]
        src = dedup_versions(src, keys, src_values, on_duplicate, ts_col).select(*src.columns)
    untouched = None
    if partition_cols:
        target, untouched = _touched(target, src, partition_cols)
    t = target.withColumn("_t", F.lit(True))
    s = src.withColumn("_s", F.lit(True))
    s = s.select(*[F.col(c).alias(f"_s_{c}") if c not in keys else F.col(c) for c in s.columns])
    j = t.join(s, keys, "full")
    in_src = F.col("_s__s").isNotNull()
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in update_cols and c in src.columns:
            out.append(F.when(in_src, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        elif c in src.columns:
            # not updated on conflict, but inserted with the source value for new keys
            out.append(F.when(F.col("_t").isNull(), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out), untouched


def insert_new(target: DataFrame, candidates: DataFrame, on: list[str]) -> DataFrame:
    """J4/SNK3: candidate rows whose ``on`` values are absent from ``target``.

    ``left join … where target.key is null``: NULL keys never match, so they
    always count as new (as in the source).
    """
    return candidates.join(target.select(*on).distinct(), on, "left_anti")


def replace_partitions(target: DataFrame, new_rows: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Whole new table: partitions present in ``new_rows`` replaced, others kept."""
    _, outside = _touched(target, new_rows, partition_cols)
    return outside.unionByName(new_rows.select(*target.columns))


def replace_slices(target: DataFrame, new_rows: DataFrame, slice_cols: list[str]) -> DataFrame:
    """Q6 (corrected): every (slice_cols) group present in ``new_rows`` is replaced entirely."""
    return replace_partitions(target, new_rows, slice_cols)


def replace_keyed(
    target: DataFrame,
    new_rows: DataFrame,
    keys: list[str],
    partition_cols: list[str],
    replaced: DataFrame | None = None,
) -> DataFrame:
    """Rows of the partitions ``replaced`` touches, with every ``keys`` group it holds replaced.

    ``replaced`` (default: ``new_rows``) names the groups that are loaded again,
    also those that have no new rows. Other target rows are kept; the result is
    meant for a dynamic partition overwrite. The key match is a shuffle anti
    join (the key set grows with the data), restricted to the touched
    partitions.
    """
    replaced = new_rows if replaced is None else replaced
    inside, _ = _touched(target, replaced, partition_cols)
    keep = inside.join(replaced.select(*keys).distinct(), keys, "left_anti")
    return keep.unionByName(new_rows.select(*target.columns))

"""ST1: the incremental load as a Structured Streaming query.

``readStream`` picks up newly landed vacancy files; every micro-batch is
one incremental load (``foreachBatch``) whose staging scope is the batch
itself. Rate documents are a small batch source read per micro-batch and
as-of filled to the batch's days. ``trigger(availableNow=True)`` processes
everything landed so far and stops (the daily schedule); the checkpoint
location makes restarts resume after the last committed batch.

Idempotence: a batch's tables and its number are published together, so a
batch that failed is loaded once when it is retried, and one that was already
published is passed over. That needs a back end whose transactions hold over
tables (``ParquetTables``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labormart.functions.json import has_key
from labormart.operators.joins import semi_join_days
from labormart.plans.pipeline import load
from labormart.semantics import REFERENCE, Semantics
from labormart.operators.quarantine import keep_rejects, rejected_rate_files
from labormart.sources.landed import keep_well_formed, rate_documents_for_days


def _from_path(path_col, name: str):
    return F.url_decode(F.regexp_extract(path_col, f"{name}=([^/]+)", 1))


def vacancy_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, on_malformed: str = "fail") -> DataFrame:
    """Streaming staging rows (obj, query_profession_eng_name, query_dt, update_ts) from landed files.

    Day and profession come from the ``query_dt=`` / ``query_profession_eng_name=``
    folders; error documents (F4) are dropped. Malformed lines (X1b) fail the
    query, or go on to the load's quarantine (``on_malformed="keep"``).
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.option("recursiveFileLookup", "true").load(path)
    fp = F.col("_metadata.file_path")
    staged = raw.where(F.length(F.trim("value")) > 0).select(
        F.col("value").alias("obj"),
        _from_path(fp, "query_profession_eng_name").alias("query_profession_eng_name"),
        _from_path(fp, "query_dt").cast("date").alias("query_dt"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("update_ts"),
    )
    return keep_well_formed(staged, on_malformed).where(~has_key("obj", "errors"))


def batch_loader(
    tables,
    rate_documents: Callable[[], DataFrame],
    sem: Semantics = REFERENCE,
    stream: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: one incremental load per non-empty micro-batch.

    ``stream`` names the source of the batch numbers (its checkpoint location);
    with it, a batch that was published before is not loaded again.
    """

    def process(batch: DataFrame, epoch_id: int) -> None:
        if (stream is not None and tables.last_batch(stream) >= epoch_id) or batch.isEmpty():
            return
        first = batch.select(F.min("query_dt")).scalar()
        last = batch.select(F.max("query_dt")).scalar()
        docs = rate_documents()
        rates = rate_documents_for_days(docs, end=last, start=first, on_malformed="keep" if sem.quarantine else "fail")
        with tables.transaction():
            if sem.quarantine:
                keep_rejects(tables, semi_join_days(rejected_rate_files(docs), batch, ["query_dt"]))
            load(tables, sem, batch=(batch, rates))
            if stream is not None:
                tables.note_batch(stream, epoch_id)

    return process


def start_incremental(
    spark: SparkSession,
    vacancy_path: str,
    tables,
    rate_documents: Callable[[], DataFrame],
    checkpoint_location: str,
    sem: Semantics = REFERENCE,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the streaming incremental load; returns the running query."""
    writer = (
        vacancy_stream(spark, vacancy_path, max_files_per_trigger, "keep" if sem.quarantine else "fail")
        .writeStream.foreachBatch(batch_loader(tables, rate_documents, sem, checkpoint_location))
        .option("checkpointLocation", checkpoint_location)
        .queryName("labormart_incremental")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()

"""Landed JSON documents → staging DataFrames (batch and stream).

Layout (one JSON document per line; directory names are partition columns):

    <root>/vacancies/query_dt=YYYY-MM-DD/query_profession_eng_name=<name>/*.jsonl
    <root>/rates/query_dt=YYYY-MM-DD/*.json

The crawler of the source system is replaced by whatever lands these files;
the operators here take over its per-document rules: error documents are
rejected (F4), a day without a rate document takes the nearest earlier one
(J8), at most ``count_page`` × ``per_page`` documents count per request cell
(L4), and accepted documents are counted per cell (A17).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labormart.functions.dates import to_day
from labormart.functions.json import has_key, parse_doc
from labormart.operators.joins import broadcast_if_small, distinct_values
from labormart.operators.numbering import numbered
from labormart.operators.rates import asof_fill
from labormart.schemas import LIST_PAGE_DOC, RATES_DOC
from labormart.semantics import REFERENCE, Semantics

COUNT_PAGE = 3  # fixed value: pages requested per (day, city, profession)
PER_PAGE = 100  # fixed value: documents per page


def _landed_text(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "false")
    if whole:
        reader = reader.option("wholetext", "true")
    df = reader.text(path)
    return df.withColumn("_landed_ts", F.col("_metadata.file_modification_time").cast("timestamp_ntz"))


def reject_errors(docs: DataFrame, key: str = "errors", col: str = "obj") -> DataFrame:
    """keep documents that do not have the top-level key ``key`` (even with a null value)."""
    return docs.where(~has_key(col, key))


def is_json_object(col: Column | str = "obj") -> Column:
    """True when the text is one well-formed JSON object (what the source's json column accepts).

    The parser stops at the end of the object; as the only element of an array
    the text must also end there. One well-formed value that begins with a brace
    is an object, so the text is read once.
    """
    c = F.col(col) if isinstance(col, str) else col
    alone = F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1
    return F.coalesce(F.startswith(F.ltrim(c, F.lit(" \t\r\n")), F.lit("{")) & alone, F.lit(False))


def malformed_documents(docs: DataFrame, col: str = "obj") -> DataFrame:
    """Landed lines that are not JSON objects (a quarantine report)."""
    return docs.where(~is_json_object(col))


def keep_well_formed(docs: DataFrame, on_malformed: str = "fail", col: str = "obj") -> DataFrame:
    """The source's json column rejects malformed text at staging time.

    ``"fail"`` fails the job on the first such line, as the rejected insert does;
    ``"keep"`` stages it as it is, and the load puts it into ``rejects``.
    """
    if on_malformed == "keep":
        return docs
    if on_malformed == "fail":
        guard = F.when(~is_json_object(col), F.raise_error(F.lit("malformed JSON document")))
        return docs.where(guard.isNull())
    raise ValueError("on_malformed must be 'keep' or 'fail'")


def read_vacancy_documents(
    spark: SparkSession, path: str, query_dt: str | _dt.date | None = None, on_malformed: str = "fail"
) -> DataFrame:
    """SRC1 + SRC6: landed vacancy documents as staging rows.

    Returns (obj, query_profession_eng_name, query_dt, update_ts); the load
    time is the file's modification time. ``query_dt`` selects one day
    (partition pruning on the directory column). Lines that are not JSON
    objects fail the job or are staged for the quarantine (``on_malformed``).
    """
    df = _landed_text(spark, path)
    if query_dt is not None:
        df = df.where(F.col("query_dt") == to_day(query_dt))
    df = df.where(F.length(F.trim("value")) > 0)
    staged = df.select(
        F.col("value").alias("obj"),
        F.col("query_profession_eng_name").cast("string"),
        F.col("query_dt").cast("date"),
        F.col("_landed_ts").alias("update_ts"),
    )
    return reject_errors(keep_well_formed(staged, on_malformed))


def read_rate_documents(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: landed rate documents (obj, doc_day); one whole file per document."""
    df = _landed_text(spark, path, whole=True)
    return df.select(F.col("value").alias("obj"), F.col("query_dt").cast("date").alias("doc_day"), "_landed_ts")


def rate_documents_for_days(
    docs: DataFrame,
    end: Column | str | _dt.date,
    start: Column | str | _dt.date | None = None,
    on_malformed: str = "keep",
) -> DataFrame:
    """J8 + F5: one staged rate document per requested day.

    ``docs`` has (obj, doc_day); documents with an ``error`` key, and text that
    is not one JSON object (a file cut off while it landed), do not count:
    the latest valid document before them serves. With ``on_malformed="fail"``
    such a file fails the job instead; else
    :func:`labormart.operators.quarantine.rejected_rate_files` accounts for it. Each day from ``start`` to ``end`` takes the latest valid
    document published on or before it, stored under the requested day
    (``query_dt``). No lookback limit.
    """
    valid = reject_errors(keep_well_formed(docs, on_malformed).where(is_json_object("obj")), "error")
    # one document per day: the last one landed wins
    order = F.struct(F.col("_landed_ts"), F.col("obj")) if "_landed_ts" in docs.columns else F.col("obj")
    per_day = valid.groupBy("doc_day").agg(F.max_by("obj", order).alias("obj"))
    filled = asof_fill(per_day, [], "doc_day", end=end, start=start, out_col="query_dt")
    return filled.select(
        "obj", "query_dt", F.col("doc_day").cast("timestamp_ntz").alias("update_ts")
    )


def select_for_request(
    rows: DataFrame,
    day: str | _dt.date | Column,
    city_id: int | Column,
    day_col: str = "published_at",
    area_col: str = "city_id",
) -> DataFrame:
    """The request's own selection on landed, flattened vacancies.

    The search request asked for vacancies published on ``day`` in area
    ``city_id``; on landed data that is a filter on the published day and the
    area (both reach the Parquet reader as pushed filters). The remote
    full-text match on the profession is the external service's and is not
    rebuilt; the landed folder already carries the profession.
    """
    d = day if isinstance(day, Column) else to_day(day)
    c = city_id if isinstance(city_id, Column) else F.lit(city_id)
    return rows.where((F.col(day_col).cast("date") == d) & (F.col(area_col) == c))


def list_page_items(pages: DataFrame) -> DataFrame:
    """SRC2b: (page row columns…, item_id, url) for each entry of a non-error list page."""
    ok = reject_errors(pages)
    d = parse_doc("obj", LIST_PAGE_DOC)
    return ok.select(*[c for c in ok.columns if c != "obj"], F.explode(d["items"]).alias("it")).select(
        *[c for c in ok.columns if c != "obj"], F.col("it.id").alias("item_id"), F.col("it.url").alias("url")
    )


def detail_documents_for_pages(items: DataFrame, details: DataFrame, on: str = "url") -> DataFrame:
    """SRC2b: landed detail documents referenced by list pages (non-error only)."""
    return reject_errors(details).join(items.select(on).distinct(), on, "left_semi")


def missing_details(items: DataFrame, details: DataFrame, on: str = "url") -> DataFrame:
    """SRC2b: list-page entries whose detail document has not landed yet."""
    return items.join(details.select(on).distinct(), on, "left_anti")


def cap_pages(
    docs: DataFrame,
    cell: list[str],
    order: list[str | Column],
    count_page: int = COUNT_PAGE,
    per_page: int = PER_PAGE,
) -> DataFrame:
    """L4: at most ``count_page`` pages of ``per_page`` documents per request cell.

    Documents are numbered in ``order`` within each ``cell``; ``page`` and
    ``position`` are derived from that number. Spark plans the filter on the
    row number as a per-task WindowGroupLimit before the shuffle, so a hot
    cell ships only its first ``count_page * per_page`` rows per task.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*cell).orderBy(*order)
    # the filter must sit on the row number itself for Spark to plan the
    # per-task WindowGroupLimit (a filter on row_number() - 1 is not matched)
    capped = docs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= count_page * per_page)
    n = F.col("_rn") - 1
    return capped.withColumn("page", (n / per_page).cast("int")).withColumn(
        "position", (n % per_page).cast("int")
    ).drop("_rn")


def number_pages(docs: DataFrame, cell: list[str], order: list[str], per_page: int = PER_PAGE) -> DataFrame:
    """SRC2b: ``page`` of every document in its request cell, ``per_page`` to a page, without a cap."""
    return numbered(docs, cell, order, "_place").withColumn("page", F.floor(F.col("_place") / per_page).cast("int")).drop("_place")


def accepted_per_request(docs: DataFrame, cell: list[str], page_col: str = "page") -> DataFrame:
    """Accepted documents per (cell, page)."""
    return docs.groupBy(*cell, page_col).agg(F.count(F.lit(1)).alias("n_docs"))


def ingest_grid(
    spine: DataFrame,
    cities: DataFrame,
    professions: DataFrame,
    pages: int = 1,
    day_col: str = "dt",
) -> DataFrame:
    """Expected request cells (dt, city_id, query_profession_eng_name, page).

    The city and profession dimensions enter as arrays (scalar subqueries), so
    the grid is a per-day explode, not a join; the days are dealt out first, so
    that many tasks write it.
    """
    city_ids = distinct_values(cities, "id")
    prof_names = distinct_values(professions, "eng_name")
    g = spine.repartition(F.col(day_col)).select(F.col(day_col).alias("dt"), F.explode(city_ids).alias("city_id"))
    g = g.select("dt", "city_id", F.explode(prof_names).alias("query_profession_eng_name"))
    return g.select("*", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))).alias("page"))


def missing_cells(grid: DataFrame, landed: DataFrame, cell: list[str]) -> DataFrame:
    """Expected cells with no landed document."""
    return grid.join(landed.select(*cell).distinct(), cell, "left_anti")


def write_staging(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    """SNK1: append one batch of staged rows, partitioned by ``query_dt``."""
    (df.write.mode("append").partitionBy(*(partition_cols or ["query_dt"])).parquet(path))


STAGED_VACANCY_COLUMNS = T.StructType(
    [
        T.StructField("obj", T.StringType()),
        T.StructField("query_profession_eng_name", T.StringType()),
        T.StructField("query_dt", T.DateType()),
        T.StructField("update_ts", T.TimestampNTZType()),
    ]
)

__all__ = [
    "COUNT_PAGE",
    "PER_PAGE",
    "RATES_DOC",
    "reject_errors",
    "read_vacancy_documents",
    "read_rate_documents",
    "rate_documents_for_days",
    "list_page_items",
    "detail_documents_for_pages",
    "missing_details",
    "cap_pages",
    "number_pages",
    "accepted_per_request",
    "ingest_grid",
    "missing_cells",
    "write_staging",
]


def landed_sources(spark: SparkSession, root: str, sem: Semantics = REFERENCE):
    """(vacancy_source, rate_source) callables over ``<root>/vacancies`` and ``<root>/rates``.

    Each takes the requested day spine (column ``query_dt``) and returns staged
    rows for those days: the vacancy documents landed under those days, and
    one rate document per day (as-of filled). Malformed text fails the job, or
    is kept for the quarantine where ``sem`` has one.
    """
    base = root.rstrip("/")
    on_malformed = "keep" if sem.quarantine else "fail"

    def vacancy_source(spine: DataFrame) -> DataFrame:
        docs = read_vacancy_documents(spark, f"{base}/vacancies", on_malformed=on_malformed)
        return docs.join(broadcast_if_small(spine.select("query_dt").distinct()), "query_dt", "left_semi")

    def rate_source(spine: DataFrame) -> DataFrame:
        first = spine.select(F.min("query_dt")).scalar()
        last = spine.select(F.max("query_dt")).scalar()
        return rate_documents_for_days(read_rate_documents(spark, f"{base}/rates"), end=last, start=first, on_malformed=on_malformed)

    return vacancy_source, rate_source


def landed_rejects(spark: SparkSession, root: str):
    """A callable like those of :func:`landed_sources`: the rate files of the days that never served."""
    from labormart.operators.quarantine import rejected_rate_files

    def reject_source(spine: DataFrame) -> DataFrame:
        rows = rejected_rate_files(read_rate_documents(spark, f"{root.rstrip('/')}/rates"))
        return rows.join(broadcast_if_small(spine.select("query_dt").distinct()), "query_dt", "left_semi")

    return reject_source


def land_documents(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Write documents (column ``obj``) as landed text files, one document per line."""
    df.select("obj", *partition_cols).write.mode("append").partitionBy(*partition_cols).text(path)

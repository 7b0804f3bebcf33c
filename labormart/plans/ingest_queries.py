"""Registered queries on landed pages and documents: the stop at the first empty page, rejected documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.plans import oracle_sql as O
from labormart.plans.catalog import register
from labormart.sources import testdata as td

_CELL = ["city_id", "query_profession_eng_name"]
_PER_PAGE = 20  # documents of a page here, so that cells have several pages in the smallest tables

_PAGES_SQL = f"""WITH {O.vacancies_cte()},
paged AS (
  SELECT vacancy_id, city_id, query_profession_eng_name,
         CAST((row_number() OVER (PARTITION BY city_id, query_profession_eng_name ORDER BY vacancy_id) - 1) // {_PER_PAGE} AS INTEGER) AS page
  FROM v
),
landed AS (  -- some pages never land, some hold nothing but errors
  SELECT *, (city_id + 2 * page + length(query_profession_eng_name)) % 4 <> 0 AND vacancy_id % 9 <> 0 AS accepted
  FROM paged WHERE (city_id * 3 + page) % 7 <> 0
),
cells AS (SELECT DISTINCT city_id, query_profession_eng_name FROM v),
asked AS (SELECT city_id, query_profession_eng_name, CAST(range AS INTEGER) AS page FROM cells, range(3)),
counted AS (
  SELECT a.city_id, a.query_profession_eng_name, a.page, COUNT(l.vacancy_id) AS n_docs
  FROM asked a LEFT JOIN landed l ON l.accepted AND l.city_id = a.city_id
       AND l.query_profession_eng_name = a.query_profession_eng_name AND l.page = a.page
  GROUP BY ALL
),
borders AS (
  SELECT city_id, query_profession_eng_name, COALESCE(MIN(page) FILTER (WHERE n_docs = 0), 3) AS stop
  FROM counted GROUP BY ALL
)"""


def _landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as they landed, by request page: some pages are missing, some hold only errors."""
    from labormart.sources.landed import number_pages

    vac = td.vacancies(spark, sf_dir).select("vacancy_id", *_CELL)
    paged = number_pages(vac, _CELL, ["vacancy_id"], _PER_PAGE).where((F.col("city_id") * 3 + F.col("page")) % 7 != 0)
    bad = ((F.col("city_id") + 2 * F.col("page") + F.length("query_profession_eng_name")) % 4 == 0) | (F.col("vacancy_id") % 9 == 0)
    doc = F.when(bad & (F.col("vacancy_id") % 2 == 0), F.lit('{"errors": null}')).when(bad, F.lit('{"errors": [{"type": "not_found"}]}'))
    return paged.withColumn("obj", F.coalesce(doc, F.to_json(F.struct(F.col("vacancy_id").alias("id")))))


@register(
    "page_stop",
    _PAGES_SQL + "\nSELECT l.vacancy_id, l.city_id, l.query_profession_eng_name, l.page FROM landed l JOIN borders b USING (city_id, query_profession_eng_name)\nWHERE l.accepted AND l.page < b.stop",
)
def page_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: accepted documents of the pages before the first empty one; cells end after 0 to 3 pages."""
    from labormart.sources.pages import stop_at_empty_page

    return stop_at_empty_page(_landed_pages(spark, sf_dir), _CELL).select("vacancy_id", *_CELL, "page")


@register(
    "page_requests",
    _PAGES_SQL + "\nSELECT c.city_id, c.query_profession_eng_name, c.page, c.n_docs FROM counted c JOIN borders b USING (city_id, query_profession_eng_name)\nWHERE c.page <= b.stop",
)
def page_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17 + L4: the requests that are made, with their accepted documents; the last one of a cell may be empty."""
    from labormart.sources.pages import requests_made

    cells = td.vacancies(spark, sf_dir).select(*_CELL).distinct()
    return requests_made(_landed_pages(spark, sf_dir), cells, _CELL)


# ---- rejected documents (X1b, X6, Q-RNG, Q-LEN) -----------------------------------

_FAULT = "CASE WHEN k % 23 = 0 OR k % 29 = 0 OR k % 43 = 0 THEN 'malformed' WHEN k % 31 = 0 THEN 'id' WHEN k % 37 = 0 THEN 'published_at' WHEN k % 41 = 0 THEN 'salary_from' WHEN k % 47 = 0 THEN 'skill_name' END"


def _faulty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed vacancy documents, some cut off, wrapped, followed by text or with fields that do not fit."""
    docs = td.vacancy_documents(spark, sf_dir).withColumn("k", F.get_json_object("obj", "$.id").cast("bigint"))
    obj, k = F.col("obj"), F.col("k")
    long_name = F.concat(F.lit('"key_skills":[{"name":"'), F.repeat(F.lit("x"), 151), F.lit('"},'))
    faulty = (
        F.when(k % 23 == 0, F.expr("left(obj, length(obj) - 5)"))
        .when(k % 29 == 0, F.concat(F.lit("["), obj, F.lit("]")))
        .when(k % 43 == 0, F.concat(obj, F.lit(" {}")))
        .when(k % 31 == 0, F.replace(obj, F.concat(F.lit('"id":'), k.cast("string"), F.lit(",")), F.lit('"id":"x1",')))
        .when(k % 37 == 0, F.replace(obj, F.lit("T00:00:00"), F.lit("T25:00:00")))
        .when(k % 41 == 0, F.replace(obj, F.lit('"from":'), F.lit('"from":"12,5","was":')))
        .when(k % 47 == 0, F.replace(obj, F.lit('"key_skills":['), long_name))
        .otherwise(obj)
    )
    return docs.withColumn("obj", faulty).drop("k")


def _rate_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate documents of more days: the first order day's, cut-off ones and ones with a value that is no number."""
    good = td.rate_documents(spark, sf_dir)
    days = td.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("doc_day")).distinct()
    n = F.unix_date("doc_day") % 50
    broken = days.where(n == 0).select(F.lit('{"Date": "2024').alias("obj"), "doc_day")
    record = '{"ID": "R1", "NumCode": "1", "CharCode": "XXX", "Name": "X", "Value": "n/a", "Previous": "1", "Nominal": "1"}'
    text = F.concat(F.lit('{"Date": "'), F.date_format("doc_day", "yyyy-MM-dd"), F.lit('T11:30:00+03:00", "Valute": {"XXX": ' + record + "}}"))
    return good.unionByName(broken).unionByName(days.where(n == 1).select(text.alias("obj"), "doc_day"))


def _quarantined(spark: SparkSession, sf_dir: str):
    from labormart.operators.quarantine import keep_rejects, rejected_rate_files
    from labormart.plans.catalog import _staged_tables
    from labormart.plans.pipeline import load, stage
    from labormart.semantics import CORRECTED
    from labormart.sources.landed import rate_documents_for_days

    tables = _staged_tables(spark, sf_dir, CORRECTED)
    first, last = td.order_date_bounds(spark, sf_dir)
    rates = _rate_days(spark, sf_dir)
    one_a_day = rates.groupBy("doc_day").agg(F.min("obj").alias("obj")).select("obj", "doc_day")
    staged = rate_documents_for_days(one_a_day, end=last, start=first)
    with tables.transaction():
        stage(tables, _faulty_documents(spark, sf_dir), staged)
        keep_rejects(tables, rejected_rate_files(rates))
        load(tables, CORRECTED, None)
    return tables


@register(
    "rejected_counts",
    f"""WITH faults AS (
  SELECT 'vacancies' AS source, {_FAULT} AS reason, k
  FROM (SELECT o_orderkey AS k FROM orders o WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey))
),
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
numbered AS (SELECT d, datediff('day', DATE '1970-01-01', d) % 50 AS n, MIN(d) OVER () AS first_day, MAX(d) OVER () AS last_day FROM days),
usable AS (SELECT d, n, last_day FROM numbered WHERE n = 1 OR (d = first_day AND n <> 0)),
held AS (SELECT n, date_diff('day', d, COALESCE(LEAD(d) OVER (ORDER BY d), last_day + 1)) AS n_days FROM usable)
SELECT source, reason, COUNT(*) AS n_rejects, CAST(COUNT(*) AS BIGINT) AS n_rows FROM faults f
WHERE reason IS NOT NULL AND (reason <> 'skill_name' OR EXISTS (SELECT 1 FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey WHERE l.l_orderkey = f.k))
GROUP BY ALL
UNION ALL SELECT 'rates', 'malformed', COUNT(*), COUNT(*) FROM numbered WHERE n = 0 HAVING COUNT(*) > 0
UNION ALL SELECT 'rates', 'value', CAST(SUM(n_days) AS BIGINT), CAST(SUM(n_days) AS BIGINT) FROM held WHERE n = 1 HAVING COUNT(*) > 0""",
)
def rejected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1b, X6, Q-RNG, Q-LEN: what a CORRECTED load keeps out, by source and reason.

    A rate document that serves several days is staged, and rejected, once for each.
    """
    rows = _quarantined(spark, sf_dir).get("rejects")
    return rows.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n_rejects"), F.sum("n_rows").alias("n_rows"))


@register(
    "accepted_beside_rejects",
    f"""WITH {O.vacancies_cte()}, faults AS (SELECT v.*, {_FAULT.replace("k %", "vacancy_id %")} AS fault FROM v)
SELECT query_profession_eng_name, COUNT(*) AS n_vacancies, CAST(SUM(vacancy_id) AS BIGINT) AS id_sum FROM faults
WHERE fault IS NULL OR fault = 'skill_name' GROUP BY ALL""",
)
def accepted_beside_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vacancies that the same load accepts; a skill name that is too long costs the entry, not the document."""
    vac = _quarantined(spark, sf_dir).get("d_vacancies")
    return vac.groupBy("query_profession_eng_name").agg(F.count(F.lit(1)).alias("n_vacancies"), F.sum("vacancy_id").alias("id_sum"))


# ---- documents staged as VARIANT (X3-X5, J3, J7) -----------------------------------

from labormart.plans.catalog import ORACLE, line_item_documents  # noqa: E402


def _variant_copy(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    """Documents as a staged table with a VARIANT column, written once and read back."""
    from labormart.operators.variants import with_variant
    from labormart.session import materialize

    return materialize(spark, with_variant(docs).drop("obj"), name)


@register(
    "variant_extract",
    f"""WITH {O.vacancies_cte(20)}
SELECT vacancy_id, city_id, salary_currency, salary_from, salary_to, experience, schedule, published_at, dt FROM v""",
)
def variant_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed vacancy columns read from staged VARIANT documents."""
    from labormart.operators.parse import vacancy_rows
    from labormart.semantics import CORRECTED

    rows = vacancy_rows(_variant_copy(spark, td.vacancy_documents(spark, sf_dir), "variant-documents"), CORRECTED)
    return rows.select("vacancy_id", "city_id", "salary_currency", "salary_from", "salary_to", "experience", "schedule", "published_at", "dt")


@register("variant_array_explode", ORACLE["json_array_explode"])
def variant_array_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per element of ``key_skills``, by ``variant_explode``."""
    from labormart.operators.parse import skill_entries

    return skill_entries(_variant_copy(spark, td.vacancy_documents(spark, sf_dir), "variant-documents"))


@register("variant_map_explode", ORACLE["json_map_explode"])
def variant_map_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One typed row per entry of ``Valute``, by ``variant_explode``."""
    from labormart.operators.parse import rate_records, typed_rate_records

    typed = typed_rate_records(rate_records(_variant_copy(spark, line_item_documents(spark, sf_dir), "variant-rates")))
    return typed.select("l_orderkey", "l_linenumber", "char_code", "num_code", "name", "value", "previous", "nominal", "published_at", "dt")


@register("full_backfill_variant", ORACLE["full_backfill_skills"])
def full_backfill_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 with documents parsed once into VARIANT: the same ranking as from text."""
    from labormart.plans.catalog import _rate_staging, _staged_tables
    from labormart.plans.pipeline import load, stage

    tables = _staged_tables(spark, sf_dir)
    stage(tables, td.vacancy_documents(spark, sf_dir), _rate_staging(spark, sf_dir))
    load(tables, day=None, documents="variant")
    return tables.get("dm_skills")

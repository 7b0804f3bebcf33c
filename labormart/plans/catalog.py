"""Registered queries: library operators run on the generated tables.

Each entry of ``QUERIES`` takes (spark, sf_dir) and returns a DataFrame over
whole tables; ``ORACLE`` holds the DuckDB statement that must give the same
rows. Names and column aliases match on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.operators import marts
from labormart.plans import oracle_sql as O
from labormart.semantics import REFERENCE
from labormart.sources import testdata as td

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---- marts (C3, C4) -------------------------------------------------------------


def _metrics(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    sem = REFERENCE
    return marts.metrics_mart(
        td.vacancies(spark, sf_dir, sem), td.rates(spark, sf_dir), td.cities(spark, sf_dir), sem, grain
    )


@register("metrics_daily", O.metrics_rows_cte("day") + "\nSELECT * FROM m")
def metrics_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir, "day")


@register("metrics_weekly", O.metrics_rows_cte("week") + "\nSELECT * FROM m")
def metrics_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir, "week")


def _skill_links(spark: SparkSession, sf_dir: str, vac: DataFrame) -> DataFrame:
    from labormart.operators.bridge import link_skills

    entries = td.skill_entries(spark, sf_dir)
    return link_skills(entries, vac, keyed=False, carry=["city_id"])


def _skills_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    # links carry the city of the vacancy row they resolve to: one vacancy join
    vac = td.vacancies(spark, sf_dir)
    return marts.skills_mart(_skill_links(spark, sf_dir, vac), None, td.cities(spark, sf_dir))


@register("skills_rank", "WITH " + O.skill_counts_cte() + "\nSELECT * FROM ranked")
def skills_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _skills_ranked(spark, sf_dir)


@register(
    "skills_top30",
    "WITH "
    + O.skill_counts_cte()
    + """,
tot AS (SELECT city_name, query_profession_eng_name, skill_name, CAST(SUM(cnt) AS BIGINT) AS cnt
        FROM sc GROUP BY ALL)
SELECT city_name, query_profession_eng_name, skill_name, cnt,
       CAST(rk AS INTEGER) AS top
FROM (SELECT *, row_number() OVER (PARTITION BY city_name, query_profession_eng_name
                                   ORDER BY cnt DESC, skill_name) AS rk FROM tot)
WHERE rk <= 30""",
)
def skills_top30(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-30 skills per (city, profession) over all days (the dashboard's report, per group)."""
    from labormart.operators.dashboards import top_skills_per_group

    return top_skills_per_group(_skills_ranked(spark, sf_dir), ["city_name", "query_profession_eng_name"], 30)


# ---- pipelines on staged JSON documents (C1, C2, C8) ------------------------------


def _staged_tables(spark: SparkSession, sf_dir: str, sem=REFERENCE, cut_lineage: bool = True):
    from labormart.plans.tables import MemoryTables

    return MemoryTables(
        spark,
        sem,
        initial={"d_city": td.cities(spark, sf_dir), "d_query_profession": td.professions(spark, sf_dir)},
        cut_lineage=cut_lineage,
    )


def _rate_staging(spark: SparkSession, sf_dir: str):
    from labormart.sources.landed import rate_documents_for_days

    first, last = td.order_date_bounds(spark, sf_dir)
    return rate_documents_for_days(td.rate_documents(spark, sf_dir), end=last, start=first)


def _full_backfill(spark: SparkSession, sf_dir: str, sem=REFERENCE):
    from labormart.plans.pipeline import load, stage

    tables = _staged_tables(spark, sf_dir, sem)
    stage(tables, td.vacancy_documents(spark, sf_dir), _rate_staging(spark, sf_dir))
    load(tables, sem, None)
    return tables


def _incremental_last_day(spark: SparkSession, sf_dir: str):
    """Full load of every day before the last order day, then the incremental load of that day."""
    from labormart.plans.pipeline import load, stage

    _, last = td.order_date_bounds(spark, sf_dir)
    docs = td.vacancy_documents(spark, sf_dir)
    rates = _rate_staging(spark, sf_dir)
    tables = _staged_tables(spark, sf_dir)
    stage(tables, docs.where(F.col("query_dt") < last), rates.where(F.col("query_dt") < last))
    load(tables, REFERENCE, None)
    stage(tables, docs.where(F.col("query_dt") == last), rates.where(F.col("query_dt") == last))
    load(tables, REFERENCE, last)
    return tables


_SKILLS_FROM_DOCS = f"""
WITH {O.vacancies_cte()},
links AS (
  SELECT DISTINCT l.l_orderkey AS vacancy_id, p.p_name AS skill_name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
sc AS (
  SELECT v.city_name, v.query_profession_eng_name, v.dt, links.skill_name, CAST(COUNT(*) AS INTEGER) AS cnt
  FROM links JOIN v ON links.vacancy_id = v.vacancy_id
  GROUP BY ALL
)
SELECT city_name, query_profession_eng_name, skill_name, dt,
       CAST(row_number() OVER (PARTITION BY city_name, query_profession_eng_name, dt
                               ORDER BY cnt DESC, skill_name) AS INTEGER) AS top,
       cnt
FROM sc"""


@register("full_backfill", O.metrics_rows_cte("week") + "\nSELECT * FROM m")
def full_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All staged documents → weekly metrics mart."""
    return _full_backfill(spark, sf_dir).get("dm_metrics")


@register("full_backfill_skills", _SKILLS_FROM_DOCS)
def full_backfill_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All staged documents → daily skills ranking."""
    return _full_backfill(spark, sf_dir).get("dm_skills")


_LAST_DAY = "(SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)"


@register(
    "incremental_day",
    f"""WITH {O.vacancies_cte()},{O.salaries_cte()},
wk AS ({O.metrics_sql('week', f'dt < {_LAST_DAY}')}),
dy AS ({O.metrics_sql('day', f'dt = {_LAST_DAY}')})
SELECT * FROM dy
UNION ALL
SELECT * FROM wk
WHERE NOT EXISTS (SELECT 1 FROM dy WHERE dy.city_name = wk.city_name
                  AND dy.query_profession_eng_name = wk.query_profession_eng_name AND dy.dt = wk.dt)""",
)
def incremental_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 after C2: weekly rows for earlier days plus the last day's daily rows (Q4 collisions resolved by key)."""
    return _incremental_last_day(spark, sf_dir).get("dm_metrics")


@register("incremental_day_skills", _SKILLS_FROM_DOCS)
def incremental_day_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 after C2: the daily ranking covers every day, the last one from the incremental load."""
    return _incremental_last_day(spark, sf_dir).get("dm_skills")


# ---- JSON access (X1-X6, J3, J7, F4, P2, P3) --------------------------------------


@register(
    "json_extract",
    """SELECT event_id, event_type,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.missing') AS missing
FROM events""",
)
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field as text then cast; an absent field gives NULL."""
    from labormart.functions.json import json_field

    ev = td.table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        "event_type",
        json_field("props", "k").cast("int").alias("k"),
        json_field("props", "missing").alias("missing"),
    )


@register(
    "json_array_explode",
    f"""WITH {O.vacancies_cte()}
SELECT DISTINCT v.vacancy_id, v.dt, v.query_profession_eng_name, p.p_name AS skill_name
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN v ON v.vacancy_id = l.l_orderkey""",
)
def json_array_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged documents → one row per ``key_skills`` element (orders without items give none)."""
    from labormart.operators.parse import skill_entries

    return skill_entries(td.vacancy_documents(spark, sf_dir))


def line_item_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate-style document per line item whose ``Valute`` object holds two entries.

    ``QTY`` carries the quantity, ``PRC`` a third of the extended price (5
    decimals, so the 4-place cast rounds), both as text like the source feed.
    """
    li = td.table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")

    def rec(code: str, value, previous, nominal) -> F.Column:
        return F.struct(
            F.concat(F.lit(code[0]), F.col("l_orderkey").cast("string")).alias("ID"),
            F.col("l_linenumber").cast("string").alias("NumCode"),
            F.lit(code).alias("CharCode"),
            F.concat(F.lit(f"{code} of "), F.col("l_orderkey").cast("string")).alias("Name"),
            value.cast("string").alias("Value"),
            previous.cast("string").alias("Previous"),
            nominal.alias("Nominal"),
        )

    valute = F.create_map(
        F.lit("QTY"), rec("QTY", F.col("l_quantity").cast("decimal(18,2)"), F.col("l_tax").cast("decimal(18,2)"), F.lit("1")),
        F.lit("PRC"), rec("PRC", price * F.lit(0.333).cast("decimal(3,3)"), F.col("l_discount").cast("decimal(18,2)"), F.lit("100")),
    )
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        F.to_json(F.struct(F.concat(day, F.lit("T11:30:00+03:00")).alias("Date"), valute.alias("Valute"))).alias("obj"),
        F.col("l_shipdate").cast("date").alias("query_dt"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("update_ts"),
    )


_MAP_SQL = """SELECT l_orderkey, l_linenumber, '{code}' AS char_code, CAST(l_linenumber AS VARCHAR) AS num_code,
       '{code} of ' || CAST(l_orderkey AS VARCHAR) AS name,
       CAST({value} AS DECIMAL(10,4)) AS value, CAST(CAST({prev} AS DECIMAL(18,2)) AS DECIMAL(10,4)) AS previous,
       {nominal} AS nominal, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL 11 HOUR + INTERVAL 30 MINUTE AS published_at,
       CAST(l_shipdate AS DATE) AS dt
FROM lineitem"""


@register(
    "json_map_explode",
    _MAP_SQL.format(code="QTY", value="CAST(l_quantity AS DECIMAL(18,2))", prev="l_tax", nominal=1)
    + "\nUNION ALL\n"
    + _MAP_SQL.format(code="PRC", value="CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.333 AS DECIMAL(3,3))", prev="l_discount", nominal=100),
)
def json_map_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``Valute`` object → one typed row per entry (rates rounded half up to 4 places)."""
    from labormart.operators.parse import rate_records, typed_rate_records

    docs = line_item_documents(spark, sf_dir)
    typed = typed_rate_records(rate_records(docs))
    return typed.select(
        "l_orderkey", "l_linenumber", "char_code", "num_code", "name", "value", "previous", "nominal", "published_at", "dt"
    )


@register(
    "error_doc_filter",
    """SELECT event_id, user_id FROM events WHERE event_type <> 'error'""",
)
def error_doc_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with an ``errors`` key are rejected, even when its value is null."""
    from labormart.sources.landed import reject_errors

    ev = td.table(spark, sf_dir, "events")
    obj = (
        F.when((F.col("event_type") == "error") & (F.col("value") < 10), F.lit('{"errors": null}'))
        .when(F.col("event_type") == "error", F.to_json(F.struct(F.col("props").alias("errors"))))
        .otherwise(F.col("props"))
    )
    return reject_errors(ev.select("event_id", "user_id", obj.alias("obj"))).select("event_id", "user_id")


# ---- dedup, insert-new, upsert (A7-A9, J4, U1-U4) ---------------------------------


@register("dedup_distinct", f"WITH {O.vacancies_cte()}\nSELECT vacancy_id, dt, query_profession_eng_name, city_id, salary_currency, salary_from, salary_to, experience, schedule FROM v")
def dedup_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 + Q7: every document staged twice (exact copies) flattens to one row per key."""
    from labormart.operators.parse import flatten_vacancies

    docs = td.vacancy_documents(spark, sf_dir)
    staged = docs.unionByName(docs)
    flat = flatten_vacancies(staged, td.professions(spark, sf_dir), td.cities(spark, sf_dir), REFERENCE)
    return flat.select(
        "vacancy_id", "dt", "query_profession_eng_name", "city_id", "salary_currency",
        "salary_from", "salary_to", "experience", "schedule",
    )


@register(
    "insert_new_anti",
    """SELECT DISTINCT p.p_partkey, p.p_name
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE NOT EXISTS (SELECT 1 FROM part k WHERE k.p_size <= 25 AND k.p_partkey = p.p_partkey)""",
)
def insert_new_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4/A8/SNK3: parts used by line items that the known table (parts of size <= 25) lacks."""
    from labormart.operators.merge import insert_new

    li = td.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    p = td.table(spark, sf_dir, "part")
    used = p.join(li, "p_partkey", "left_semi").select("p_partkey", "p_name").distinct()
    known = p.where(F.col("p_size") <= 25).select("p_partkey", "p_name")
    return insert_new(known, used, ["p_partkey"])


def _upsert_source(vac: DataFrame, null_to: bool) -> DataFrame:
    """Incoming versions: orders of 1997 onwards, re-published with a changed schedule/experience."""
    src = vac.where(F.col("dt") >= F.lit("1997-01-01").cast("date")).select(
        "vacancy_id", "dt", "query_profession_eng_name", "city_id", "salary_currency", "salary_from",
        (F.lit(None).cast("decimal(18,2)") if null_to else F.col("salary_to")).alias("salary_to"),
        F.lit("between3And6").alias("experience"),
        F.concat(F.col("schedule"), F.lit("*")).alias("schedule"),
    )
    return src


_UPSERT_BASE = f"""WITH {O.vacancies_cte()},
t AS (SELECT vacancy_id, dt, query_profession_eng_name, city_id, salary_currency, salary_from, salary_to, experience, schedule
      FROM v WHERE dt < DATE '1998-01-01'),
s AS (SELECT vacancy_id, dt, query_profession_eng_name, city_id, salary_currency, salary_from,
             {{to}} AS salary_to, 'between3And6' AS experience, schedule || '*' AS schedule
      FROM v WHERE dt >= DATE '1997-01-01')
SELECT COALESCE(s.vacancy_id, t.vacancy_id) AS vacancy_id, COALESCE(s.dt, t.dt) AS dt,
       COALESCE(s.query_profession_eng_name, t.query_profession_eng_name) AS query_profession_eng_name,
       CASE WHEN s.vacancy_id IS NOT NULL THEN s.city_id ELSE t.city_id END AS city_id,
       CASE WHEN s.vacancy_id IS NOT NULL THEN s.salary_currency ELSE t.salary_currency END AS salary_currency,
       CASE WHEN s.vacancy_id IS NOT NULL THEN s.salary_from ELSE t.salary_from END AS salary_from,
       CASE WHEN s.vacancy_id IS NOT NULL THEN s.salary_to ELSE t.salary_to END AS salary_to,
       CASE WHEN s.vacancy_id IS NOT NULL THEN s.experience ELSE t.experience END AS experience,
       CASE WHEN s.vacancy_id IS NOT NULL THEN s.schedule ELSE t.schedule END AS schedule
FROM t FULL OUTER JOIN s ON t.vacancy_id = s.vacancy_id AND t.dt = s.dt
     AND t.query_profession_eng_name = s.query_profession_eng_name"""


def _upsert_query(spark: SparkSession, sf_dir: str, null_to: bool) -> DataFrame:
    from labormart.operators.merge import upsert

    vac = td.vacancies(spark, sf_dir).select(
        "vacancy_id", "dt", "query_profession_eng_name", "city_id", "salary_currency",
        "salary_from", "salary_to", "experience", "schedule",
    )
    target = vac.where(F.col("dt") < F.lit("1998-01-01").cast("date"))
    return upsert(target, _upsert_source(vac, null_to), ["vacancy_id", "dt", "query_profession_eng_name"], partition_cols=["dt"])


@register("upsert_merge", _UPSERT_BASE.format(to="salary_to"))
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping target (before 1998) and source (1997 on): update, insert, keep."""
    return _upsert_query(spark, sf_dir, null_to=False)


@register("upsert_null_overwrite", _UPSERT_BASE.format(to="CAST(NULL AS DECIMAL(18,2))"))
def upsert_null_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incoming NULL replaces the stored value (presence flag, not coalesce)."""
    return _upsert_query(spark, sf_dir, null_to=True)


# ---- rates (J8, D1, X11-X14) --------------------------------------------------------


@register(
    "rates_asof",
    """WITH obs AS (
  SELECT user_id AS series, CAST(ts AS DATE) AS obs_day, CAST(arg_max(value, (ts, event_id)) AS DECIMAL(10,4)) AS value
  FROM events GROUP BY ALL
),
days AS (
  SELECT CAST(d AS DATE) AS dt
  FROM range((SELECT MIN(CAST(ts AS DATE)) FROM events),
             (SELECT MAX(CAST(ts AS DATE)) FROM events) + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)
),
spine AS (
  SELECT s.series, days.dt FROM (SELECT series, MIN(obs_day) AS first_day FROM obs GROUP BY series) s
  JOIN days ON days.dt >= s.first_day
)
SELECT spine.series, spine.dt, obs.obs_day, obs.value
FROM spine ASOF JOIN obs ON spine.series = obs.series AND spine.dt >= obs.obs_day""",
)
def rates_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each series' latest observation on or before every day up to the last event day."""
    from labormart.operators.rates import asof_fill

    ev = td.table(spark, sf_dir, "events")
    obs = ev.groupBy(F.col("user_id").alias("series"), F.col("ts").cast("date").alias("obs_day")).agg(
        F.max_by("value", F.struct("ts", "event_id")).cast("decimal(10,4)").alias("value")
    )
    last = ev.select(F.max("ts").cast("date")).scalar()
    return asof_fill(obs, ["series"], "obs_day", end=last).select("series", "dt", "obs_day", "value")


@register(
    "fx_salary",
    f"WITH {O.vacancies_cte()},{O.salaries_cte()}\nSELECT vacancy_id, salary_currency, avg_salary FROM sal",
)
def fx_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-vacancy salary midpoint in the home currency (decimal, half up)."""
    from labormart.operators.marts import vacancy_salaries

    sal = vacancy_salaries(td.vacancies(spark, sf_dir), td.rates(spark, sf_dir), REFERENCE)
    return sal.select("vacancy_id", "salary_currency", "avg_salary")


# ---- dimension joins (J1, J2, J9, J12) ----------------------------------------------


def _listed_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city file lists the nations outside MIDDLE EAST only."""
    n = td.table(spark, sf_dir, "nation")
    r = td.table(spark, sf_dir, "region").where(F.col("r_name") != "MIDDLE EAST")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"], "left_semi").select(
        F.col("n_nationkey").cast("int").alias("id"), F.col("n_name").alias("name"), F.col("n_name").alias("eng_name")
    )


def _seeded_professions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seeded professions: three of the market segments."""
    seeds = spark.createDataFrame([(1, "AUTOMOBILE"), (2, "BUILDING"), (3, "MACHINERY")], "id int, eng_name string")
    return seeds.select("id", F.col("eng_name").alias("name"), "eng_name")


_LISTED = """listed AS (SELECT n.n_nationkey AS id, n.n_name AS name FROM nation n JOIN region r
                  ON n.n_regionkey = r.r_regionkey WHERE r.r_name <> 'MIDDLE EAST'),
seeded(eng_name) AS (VALUES ('AUTOMOBILE'), ('BUILDING'), ('MACHINERY'))"""


@register(
    "dim_lookup_inner",
    f"""WITH {O.vacancies_cte()}, {_LISTED}
SELECT v.vacancy_id, v.dt, v.query_profession_eng_name, v.city_id
FROM v WHERE v.query_profession_eng_name IN (SELECT eng_name FROM seeded)
       AND v.city_id IN (SELECT id FROM listed)""",
)
def dim_lookup_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged documents kept only when profession and area are in the dimensions."""
    from labormart.operators.parse import flatten_vacancies

    flat = flatten_vacancies(
        td.vacancy_documents(spark, sf_dir), _seeded_professions(spark, sf_dir), _listed_cities(spark, sf_dir)
    )
    return flat.select("vacancy_id", "dt", "query_profession_eng_name", "city_id")


@register(
    "dim_lookup_left",
    f"""WITH {O.vacancies_cte()}, {_LISTED}
SELECT v.vacancy_id, v.city_id, listed.name AS city_name
FROM v LEFT JOIN listed ON v.city_id = listed.id""",
)
def dim_lookup_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City name looked up with a left join (unlisted areas keep a NULL name)."""
    from labormart.operators.joins import broadcast_if_small

    vac = td.vacancies(spark, sf_dir).select("vacancy_id", "city_id")
    city = broadcast_if_small(_listed_cities(spark, sf_dir).select(F.col("id").alias("city_id"), F.col("name").alias("city_name")))
    return vac.join(city, "city_id", "left").select("vacancy_id", "city_id", "city_name")


# ---- skill links, source vs keyed (J5, J6, Q3) -------------------------------------


def _links_restaged(spark: SparkSession, sf_dir: str, keyed: bool) -> DataFrame:
    """Every document staged on its day and again the next day; links summed per (profession, skill)."""
    from labormart.operators.bridge import link_skills
    from labormart.operators.parse import flatten_vacancies, skill_entries

    docs = td.vacancy_documents(spark, sf_dir)
    again = docs.withColumn("query_dt", F.date_add("query_dt", 1))
    staged = docs.unionByName(again)
    vac = flatten_vacancies(staged, td.professions(spark, sf_dir), td.cities(spark, sf_dir))
    links = link_skills(skill_entries(staged), vac, keyed=keyed)
    return links.groupBy("query_profession_eng_name", "skill_name").agg(F.sum("n_links").alias("n_links"))


_LINKS_SQL = """SELECT c.c_mktsegment AS query_profession_eng_name, x.p_name AS skill_name, CAST({k} * COUNT(*) AS BIGINT) AS n_links
FROM (SELECT DISTINCT l.l_orderkey, p.p_name FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey) x
JOIN orders o ON o.o_orderkey = x.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
GROUP BY ALL"""


@register("skill_links_reference", _LINKS_SQL.format(k=4))
def skill_links_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 source behaviour: 2 staged copies × 2 stored rows → 4 links per (vacancy, skill)."""
    return _links_restaged(spark, sf_dir, keyed=False)


@register("skill_links_keyed", _LINKS_SQL.format(k=2))
def skill_links_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 corrected: one link per stored row and skill → 2 per (vacancy, skill)."""
    return _links_restaged(spark, sf_dir, keyed=True)


# ---- read queries and dashboards (C5-C7, C9-C12) -----------------------------------

# fixed values: the selection used by the parameterised read queries
PARAMS = {"city": "NATION_7", "profession": "BUILDING", "date_from": "1996-01-01", "date_to": "1996-12-31"}
_PARAM_WHERE = (
    "city_name = 'NATION_7' AND query_profession_eng_name = 'BUILDING' "
    "AND dt BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"
)


@register("metrics_by_params", O.metrics_rows_cte("day") + f"\nSELECT * FROM m WHERE {_PARAM_WHERE}")
def metrics_by_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mart rows of one city and profession in an inclusive date range."""
    from labormart.operators.serve import get_metrics

    return get_metrics(metrics_daily(spark, sf_dir), **PARAMS)


@register("skills_by_params", "WITH " + O.skill_counts_cte() + f"\nSELECT * FROM ranked WHERE {_PARAM_WHERE}")
def skills_by_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking rows of one city and profession in the date range."""
    from labormart.operators.serve import get_skills

    return get_skills(skills_rank(spark, sf_dir), **PARAMS)


@register(
    "dash_cnt_trend",
    O.metrics_rows_cte("day")
    + f"""
SELECT dt, cnt, no_experience_cnt, between_1_and_3_cnt, between_3_and_6_cnt, more_than_6_cnt
FROM m WHERE {_PARAM_WHERE}""",
)
def dash_cnt_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count trend of the selection, by date."""
    from labormart.operators.dashboards import count_trend

    return count_trend(metrics_by_params(spark, sf_dir))


def _avg_cols_sql() -> str:
    from labormart.schemas import EXPERIENCE_BANDS

    return ",\n  ".join(
        f"CAST(SUM(CAST({p}_avg_salary AS DECIMAL(18,2))) AS DOUBLE) / COUNT({p}_avg_salary) AS {p}_avg_salary" for p, _ in EXPERIENCE_BANDS
    )


@register(
    "dash_avg_salary",
    O.metrics_rows_cte("day")
    + f"""
SELECT city_name, query_profession_eng_name,
  {_avg_cols_sql()}
FROM m GROUP BY city_name, query_profession_eng_name""",
)
def dash_avg_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of the daily band averages (zeros included) per city and profession."""
    from labormart.operators.dashboards import avg_salary

    return avg_salary(metrics_daily(spark, sf_dir), REFERENCE, by=["city_name", "query_profession_eng_name"])


@register(
    "dash_schedule_share",
    O.metrics_rows_cte("day")
    + """,
sums AS (
  SELECT city_name, query_profession_eng_name,
         CAST(SUM(flexible_schedule_cnt) AS BIGINT) AS flexible, CAST(SUM(remote_schedule_cnt) AS BIGINT) AS remote,
         CAST(SUM(full_day_schedule_cnt) AS BIGINT) AS full_day, CAST(SUM(shift_schedule_cnt) AS BIGINT) AS shift,
         CAST(SUM(fly_in_fly_out_schedule_cnt) AS BIGINT) AS fly_in_fly_out
  FROM m GROUP BY city_name, query_profession_eng_name
),
long AS (
  UNPIVOT sums ON flexible, remote, full_day, shift, fly_in_fly_out INTO NAME schedule VALUE n
),
pos AS (SELECT * FROM long WHERE n > 0)
SELECT city_name, query_profession_eng_name, schedule, n,
       CAST((2000 * n + SUM(n) OVER w) // (2 * SUM(n) OVER w) AS DOUBLE) / 10.0 AS pct
FROM pos WINDOW w AS (PARTITION BY city_name, query_profession_eng_name)""",
)
def dash_schedule_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule sums per city and profession, positive only, with shares."""
    from labormart.operators.dashboards import schedule_share

    return schedule_share(metrics_daily(spark, sf_dir), by=["city_name", "query_profession_eng_name"])


@register(
    "dash_top_skills",
    "WITH "
    + O.skill_counts_cte()
    + f""",
sel AS (SELECT skill_name, CAST(SUM(cnt) AS BIGINT) AS cnt FROM ranked WHERE {_PARAM_WHERE} GROUP BY skill_name)
SELECT skill_name, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, skill_name) AS INTEGER) AS top
FROM sel ORDER BY cnt DESC, skill_name LIMIT 30""",
)
def dash_top_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selection's 30 most demanded skills (shown ascending)."""
    from labormart.operators.dashboards import top_skills

    return top_skills(skills_by_params(spark, sf_dir), 30)


@register(
    "get_cities",
    "SELECT CAST(n_nationkey AS INTEGER) AS id, n_name AS name, n_name AS eng_name FROM nation",
)
def get_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7/SRC5: the whole city dimension."""
    from labormart.operators.serve import get_cities as _get

    return _get(td.cities(spark, sf_dir))


@register("get_professions", "SELECT DISTINCT c_mktsegment AS name, c_mktsegment AS eng_name FROM customer")
def get_professions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7/SRC5: the whole profession dimension."""
    from labormart.operators.serve import get_professions as _get

    return _get(td.professions(spark, sf_dir)).select("name", "eng_name")


def _records_sql() -> str:
    from labormart.schemas import METRIC_AVG_COLS, METRIC_MEASURES

    fields = ["city_name", "query_profession_eng_name", "dt"] + METRIC_MEASURES
    parts = ", ".join(
        f"'{f}': " + (f"CAST({f} AS VARCHAR)" if f in METRIC_AVG_COLS else f) for f in fields
    )
    return O.metrics_rows_cte("day") + f"\nSELECT CAST(to_json({{{parts}}}) AS VARCHAR) AS record FROM m WHERE {_PARAM_WHERE}"


@register("records_json", _records_sql())
def records_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK7/X19: the selected mart rows as JSON records (decimals as text)."""
    from labormart.operators.serve import to_records

    return to_records(metrics_by_params(spark, sf_dir))


# ---- ingest: grid, page cap, counts, list pages (D1, D2, J14, L4, A17, SRC2b) ------

_CELLS_SQL = f"""WITH {O.vacancies_cte()},
numbered AS (
  SELECT vacancy_id, dt, city_id, query_profession_eng_name,
         row_number() OVER (PARTITION BY dt, city_id, query_profession_eng_name ORDER BY vacancy_id) - 1 AS n
  FROM v
),
capped AS (
  SELECT vacancy_id, dt, city_id, query_profession_eng_name,
         CAST(n // 100 AS INTEGER) AS page, CAST(n % 100 AS INTEGER) AS position
  FROM (SELECT *, row_number() OVER (PARTITION BY query_profession_eng_name ORDER BY vacancy_id) - 1 AS n FROM v)
  WHERE n < 300
),
paged AS (
  SELECT vacancy_id, dt, city_id, query_profession_eng_name, CAST(n // 100 AS INTEGER) AS page FROM numbered
)"""


def _capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labormart.sources.landed import cap_pages

    vac = td.vacancies(spark, sf_dir).select("vacancy_id", "dt", "city_id", "query_profession_eng_name")
    return cap_pages(vac, ["query_profession_eng_name"], ["vacancy_id"])


def _paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vacancy with its page in its cell, as many pages as there are."""
    from labormart.sources.landed import number_pages

    vac = td.vacancies(spark, sf_dir).select("vacancy_id", "dt", "city_id", "query_profession_eng_name")
    return number_pages(vac, ["dt", "city_id", "query_profession_eng_name"], ["vacancy_id"])


@register("page_cap", _CELLS_SQL + "\nSELECT * FROM capped")
def page_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: at most 3 pages of 100 documents per request cell; here a cell is a profession, so the cap acts."""
    return _capped(spark, sf_dir)


@register(
    "ingest_counts",
    _CELLS_SQL + "\nSELECT dt, city_id, query_profession_eng_name, page, COUNT(*) AS n_docs FROM paged GROUP BY ALL",
)
def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted documents per request (day, city, profession, page)."""
    from labormart.sources.landed import accepted_per_request

    return accepted_per_request(_paged(spark, sf_dir), ["dt", "city_id", "query_profession_eng_name"])


@register(
    "ingest_grid_missing",
    _CELLS_SQL
    + """,
days AS (
  SELECT CAST(d AS DATE) AS dt
  FROM range((SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders),
             (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders) + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)
),
grid AS (
  SELECT days.dt, n.n_nationkey AS city_id, s.c_mktsegment AS query_profession_eng_name, CAST(p.range AS INTEGER) AS page
  FROM days, nation n, (SELECT DISTINCT c_mktsegment FROM customer) s, range(3) p
)
SELECT * FROM grid
WHERE NOT EXISTS (SELECT 1 FROM paged v WHERE v.dt = grid.dt AND v.city_id = grid.city_id
                  AND v.query_profession_eng_name = grid.query_profession_eng_name AND v.page = grid.page)""",
)
def ingest_grid_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected (day, city, profession, page) cells with no landed document."""
    from labormart.functions.dates import day_spine
    from labormart.sources.landed import COUNT_PAGE, ingest_grid, missing_cells

    first, last = td.order_date_bounds(spark, sf_dir)
    spine = day_spine(spark, first, last)
    grid = ingest_grid(spine, td.cities(spark, sf_dir), td.professions(spark, sf_dir), pages=COUNT_PAGE)
    return missing_cells(grid, _paged(spark, sf_dir), ["dt", "city_id", "query_profession_eng_name", "page"])


def _list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List pages per request cell: up to 100 (id, url) items per page."""
    paged = _paged(spark, sf_dir)
    items = F.struct(F.col("vacancy_id").cast("string").alias("id"), _url(F.col("vacancy_id")).alias("url"))
    return paged.groupBy("dt", "city_id", "query_profession_eng_name", "page").agg(
        F.to_json(F.struct(F.array_sort(F.collect_list(items)).alias("items"))).alias("obj")
    )


def _url(vacancy_id):
    return F.concat(F.lit("https://vacancies.example/"), vacancy_id.cast("string"))


def _landed_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail documents landed so far: every order except the pending (status P) ones."""
    o = td.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P").select("o_orderkey")
    docs = td.vacancy_documents(spark, sf_dir)
    ids = F.get_json_object("obj", "$.id").cast("bigint")
    return docs.withColumn("vacancy_id", ids).join(o.withColumnRenamed("o_orderkey", "vacancy_id"), "vacancy_id", "left_semi").withColumn(
        "url", _url(F.col("vacancy_id"))
    )


@register(
    "list_page_details",
    _CELLS_SQL + "\nSELECT c.vacancy_id, c.dt, c.page FROM paged c JOIN orders o ON o.o_orderkey = c.vacancy_id WHERE o.o_orderstatus <> 'P'",
)
def list_page_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2b: list pages → the landed detail documents they reference (per page entry)."""
    from labormart.sources.landed import list_page_items

    items = list_page_items(_list_pages(spark, sf_dir))
    details = _landed_details(spark, sf_dir).select("url", "vacancy_id")
    return items.join(details, "url", "inner").select("vacancy_id", "dt", "page")


@register(
    "list_page_missing",
    _CELLS_SQL + "\nSELECT c.vacancy_id, c.dt, c.page FROM paged c JOIN orders o ON o.o_orderkey = c.vacancy_id WHERE o.o_orderstatus = 'P'",
)
def list_page_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2b: list-page entries whose detail document has not landed."""
    from labormart.sources.landed import list_page_items, missing_details

    items = list_page_items(_list_pages(spark, sf_dir))
    missing = missing_details(items, _landed_details(spark, sf_dir))
    return missing.select(F.col("item_id").cast("bigint").alias("vacancy_id"), "dt", "page")


# ---- data-quality audits (Q-NN, Q-UQ, Q-FK, Q-LEN, Q-RNG) ---------------------------

_VAC_COLS = [
    "vacancy_id", "city_id", "query_profession_eng_name", "profession", "salary_currency", "salary_from",
    "salary_to", "experience", "schedule", "published_at", "dt",
]


@register(
    "dq_nulls",
    f"WITH {O.vacancies_cte()}\nSELECT column_name, n_rows, n_null FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null FROM v"
        for c in _VAC_COLS
    )
    + ")",
)
def dq_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-NN: NULL count of every vacancy column in one pass."""
    from labormart.operators.quality import null_counts

    return null_counts(td.vacancies(spark, sf_dir), _VAC_COLS)


@register(
    "dq_unique",
    """SELECT l.l_orderkey AS vacancy_id, p.p_name AS skill_name, COUNT(*) AS n_rows
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY ALL HAVING COUNT(*) > 1""",
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-UQ/Q-PK: (vacancy, skill) pairs held by more than one link row."""
    from labormart.operators.quality import duplicate_keys

    return duplicate_keys(td.skill_entries(spark, sf_dir), ["vacancy_id", "skill_name"])


@register(
    "dq_fk",
    f"""WITH {O.vacancies_cte()}, {_LISTED}
SELECT vacancy_id, city_id FROM v WHERE city_id NOT IN (SELECT id FROM listed)""",
)
def dq_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-FK: vacancies whose city is missing from the city file."""
    from labormart.operators.quality import orphans

    vac = td.vacancies(spark, sf_dir).select("vacancy_id", "city_id")
    return orphans(vac, _listed_cities(spark, sf_dir), ["city_id"], ["id"])


# fixed values: declared lengths of the flattened vacancy columns
_LIMITS = {"profession": 100, "salary_currency": 10, "experience": 20, "schedule": 10}


@register(
    "dq_length",
    f"""WITH cur(r_name, code) AS (VALUES {O.CURRENCY_VALUES}),
raw AS (
  SELECT c.c_name AS profession, cur.code AS salary_currency,
         {O._case('o.o_orderpriority', td.PRIORITY_TO_EXPERIENCE)} AS experience,
         {O._case('o.o_orderstatus', td.STATUS_TO_SCHEDULE)} AS schedule
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN cur ON cur.r_name = r.r_name
)
"""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {n} AS max_len, COUNT(*) FILTER (WHERE length({c}) > {n}) AS n_too_long, "
        f"CAST(MAX(length({c})) AS INTEGER) AS longest FROM raw"
        for c, n in _LIMITS.items()
    ),
)
def dq_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-LEN/Q1: values longer than the declared varchar length (cut on load)."""
    from labormart.operators.quality import too_long

    return too_long(td._vacancy_source(spark, sf_dir), _LIMITS)


@register(
    "dq_range",
    f"""WITH {O.vacancies_cte()},{O.salaries_cte(18)}
SELECT salary_currency, COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE abs(avg_salary) >= 100000000) AS n_out_of_range,
       MAX(abs(avg_salary)) AS max_abs
FROM sal GROUP BY salary_currency""",
)
def dq_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-RNG: per currency, converted salaries that would not fit numeric(10,2)."""
    from labormart.operators.marts import vacancy_salaries
    from labormart.operators.quality import out_of_range
    from labormart.semantics import CORRECTED

    wide = REFERENCE.with_(salary_precision=CORRECTED.salary_precision)
    sal = vacancy_salaries(td.vacancies(spark, sf_dir), td.rates(spark, sf_dir), wide)
    bad = out_of_range(sal, "avg_salary", 10, 2).groupBy("salary_currency").agg(F.count(F.lit(1)).alias("n_bad"))
    tot = sal.groupBy("salary_currency").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.abs("avg_salary")).alias("max_abs")
    )
    return tot.join(bad, "salary_currency", "left").select(
        "salary_currency", "n_rows", F.coalesce("n_bad", F.lit(0)).cast("long").alias("n_out_of_range"), "max_abs"
    )


# ---- scalar expressions (X7-X10, X16, X20) ----------------------------------------


@register(
    "varchar_truncate",
    f"""SELECT o.o_orderkey AS vacancy_id, LEFT({O._case('o.o_orderstatus', td.STATUS_TO_SCHEDULE)}, 10) AS schedule,
       LEFT(c.c_name, 12) AS name12
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
)
def varchar_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``::varchar(n)`` keeps the first n characters."""
    from labormart.functions.text import truncate

    src = td._vacancy_source(spark, sf_dir)
    return src.select("vacancy_id", truncate("schedule", 10).alias("schedule"), truncate("profession", 12).alias("name12"))


@register(
    "ts_offset_strip",
    """SELECT event_id, CAST(strftime(ts, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS local_ts FROM events""",
)
def ts_offset_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text with a +03:00 offset keeps its wall-clock time."""
    from labormart.functions.dates import local_timestamp

    ev = td.table(spark, sf_dir, "events")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0300"))
    return ev.select("event_id", local_timestamp(text).alias("local_ts"))


@register(
    "week_trunc",
    """SELECT CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE) AS week_start, COUNT(*) AS n_orders
FROM orders GROUP BY 1""",
)
def week_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monday-based week buckets."""
    from labormart.functions.dates import week_start

    o = td.table(spark, sf_dir, "orders")
    return o.groupBy(week_start("o_orderdate").alias("week_start")).agg(F.count(F.lit(1)).alias("n_orders"))


@register(
    "prev_day",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS dt, CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 DAY AS DATE) AS prev_dt,
       strftime(CAST(o_orderdate AS DATE), '%d.%m.%Y') AS caption
FROM orders""",
)
def prev_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day before (``as_of - 1 day``) and the caption format."""
    from labormart.functions.dates import caption_date
    from labormart.functions.dates import prev_day as _prev

    days = td.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("dt")).distinct()
    return days.select("dt", _prev("dt").alias("prev_dt"), caption_date("dt").alias("caption"))


# ---- the corrected preset ---------------------------------------------------------


@register(
    "metrics_weekly_corrected",
    f"""WITH {O.vacancies_cte(20)},{O.salaries_cte(18, use_nominal=True)}
SELECT city_name, query_profession_eng_name, CAST(date_trunc('week', dt) AS DATE) AS dt,
  """
    + O.metric_measures_sql(18, zero_when_empty=False)
    + """,
  'week' AS grain
FROM sal GROUP BY city_name, query_profession_eng_name, CAST(date_trunc('week', dt) AS DATE)""",
)
def metrics_weekly_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 with CORRECTED semantics: full schedule ids (Q1), nominal (Q2), NULL when empty (Q10), grain (Q4)."""
    from labormart.semantics import CORRECTED

    sem = CORRECTED
    return marts.metrics_mart(
        td.vacancies(spark, sf_dir, sem), td.rates(spark, sf_dir), td.cities(spark, sf_dir), sem, "week"
    )


_AUDIT_LEN = {"profession": 100, "salary_currency": 10, "experience": 20, "schedule": 20}


@register(
    "dq_audit_vacancies",
    f"""WITH {O.vacancies_cte()}, {_LISTED}
"""
    + "\nUNION ALL\n".join(
        [
            f"""SELECT 'd_vacancies' AS table_name, 'not_null' AS "check", '{c}' AS target,
       CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_findings FROM v"""
            for c in ("vacancy_id", "city_id", "query_profession_eng_name")
        ]
        + [
            """SELECT 'd_vacancies', 'unique', 'vacancy_id,dt,query_profession_eng_name',
       CAST((SELECT COUNT(*) FROM (SELECT vacancy_id, dt, query_profession_eng_name FROM v GROUP BY ALL HAVING COUNT(*) > 1)) AS BIGINT)""",
            """SELECT 'd_vacancies', 'foreign_key', 'city_id->d_city',
       CAST(COUNT(*) AS BIGINT) FROM v WHERE city_id NOT IN (SELECT id FROM listed)""",
            """SELECT 'd_vacancies', 'foreign_key', 'query_profession_eng_name->d_query_profession',
       CAST(COUNT(*) AS BIGINT) FROM v WHERE query_profession_eng_name NOT IN (SELECT eng_name FROM seeded)""",
        ]
        + [
            f"""SELECT 'd_vacancies', 'length', '{c}', CAST(COUNT(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) FROM v"""
            for c, n in _AUDIT_LEN.items()
        ]
    ),
)
def dq_audit_vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section 2.13: every declared constraint of the vacancy table, checked against a city file
    without MIDDLE EAST and the three seeded professions (so foreign keys find orphans)."""
    from labormart.operators.quality import audit

    tables = {
        "d_vacancies": td.vacancies(spark, sf_dir),
        "d_city": _listed_cities(spark, sf_dir),
        "d_query_profession": _seeded_professions(spark, sf_dir),
    }
    return audit(tables, ["d_vacancies"])


@register("full_backfill_corrected", ORACLE["metrics_weekly_corrected"])
def full_backfill_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 with CORRECTED semantics: staged JSON → weekly metrics with ``grain`` (Q1, Q2, Q4, Q10)."""
    from labormart.semantics import CORRECTED

    return _full_backfill(spark, sf_dir, CORRECTED).get("dm_metrics")


@register("full_backfill_skills_corrected", _SKILLS_FROM_DOCS)
def full_backfill_skills_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 with CORRECTED semantics: keyed links (Q3), slice replacement (Q6), NULL names dropped (Q8).

    Each order is staged once, so the keyed counts equal the source's here.
    """
    from labormart.semantics import CORRECTED

    return _full_backfill(spark, sf_dir, CORRECTED).get("dm_skills")


# queries in modules of their own register themselves
from labormart.plans import ingest_queries, mart_queries  # noqa: E402, F401

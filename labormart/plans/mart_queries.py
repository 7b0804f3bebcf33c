"""Registered queries on changing quotes, mergeable states, day blocks, observed checks and keyed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.plans import oracle_sql as O
from labormart.plans.catalog import ORACLE, register
from labormart.semantics import CORRECTED, REFERENCE
from labormart.sources import testdata as td

# ---- quotes that change, repeat and are missing on most days (J8, J9, J11, A10) ------

# code, its number in the quote rule, nominal; XXX is no known currency
_CODES = [("USD", 1, 1), ("KZT", 2, 100), ("EUR", 3, 1), ("XXX", 4, 1)]

_QUOTES_SQL = f"""
codes(char_code, i, nominal) AS (VALUES {", ".join(str(c) for c in _CODES)}),
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS dt, datediff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS d FROM orders),
observed AS (SELECT dt, d, char_code, nominal, CAST((2000 + (d * (37 * i + 11)) % 8009) * 0.01 AS DECIMAL(10,4)) AS value FROM days, codes WHERE (d * 7 + i * 3) % 5 = 0),
quotes AS (
  SELECT * FROM observed
  UNION ALL SELECT * FROM observed WHERE d % 3 = 0
  UNION ALL SELECT dt, d, char_code, nominal, CAST(value + 1 AS DECIMAL(10,4)) FROM observed WHERE d % 11 = 0
),
known AS (SELECT DISTINCT char_code, dt, value, nominal FROM quotes WHERE char_code <> 'XXX'),
known_days AS (SELECT DISTINCT char_code, dt FROM known)"""


def changing_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(char_code, dt, value, nominal): about every fifth order day, some rows twice, some days with two values."""
    days = td.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("dt")).distinct()
    d = F.datediff("dt", F.lit("1990-01-01").cast("date")).alias("d")
    code = F.explode(F.array(*[F.struct(F.lit(c).alias("char_code"), F.lit(i).alias("i"), F.lit(n).alias("nominal")) for c, i, n in _CODES]))
    rows = days.select("dt", d, code.alias("c")).select("dt", "d", "c.*").where((F.col("d") * 7 + F.col("i") * 3) % 5 == 0)
    cents = (2000 + (F.col("d") * (37 * F.col("i") + 11)) % 8009).cast("decimal(10,0)")
    one = rows.select("dt", "d", "char_code", "nominal", (cents * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,4)").alias("value"))
    more = one.where("d % 11 = 0").withColumn("value", (F.col("value") + 1).cast("decimal(10,4)"))
    return one.unionByName(one.where("d % 3 = 0")).unionByName(more).select("char_code", "dt", "value", "nominal")


def _known_currencies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c,) for c, _, _ in _CODES if c != "XXX"], "char_code string")


_SALARY = """CAST((CAST(CASE WHEN salary_currency = 'RUR' THEN COALESCE(salary_from, salary_to)
                    WHEN salary_currency <> 'RUR' THEN COALESCE(salary_from * value, salary_to * value) END AS DECIMAL(10,2))
        + CAST(CASE WHEN salary_currency = 'RUR' THEN COALESCE(salary_to, salary_from)
                    WHEN salary_currency <> 'RUR' THEN COALESCE(salary_to * value, salary_from * value) END AS DECIMAL(10,2))) * 0.5 AS DECIMAL(10,2))"""

_ASOF_SQL = f"""WITH {O.vacancies_cte()},{_QUOTES_SQL},
met AS (SELECT v.*, k.dt AS quote_dt FROM v ASOF LEFT JOIN known_days k ON v.salary_currency = k.char_code AND v.dt >= k.dt),
sal AS (
  SELECT DISTINCT m.vacancy_id, m.dt, m.city_name, m.query_profession_eng_name, m.experience, m.schedule, {_SALARY} AS avg_salary
  FROM met m LEFT JOIN known q ON q.char_code = m.salary_currency AND q.dt = m.quote_dt
)"""


@register("salary_asof_changing", _ASOF_SQL + "\nSELECT vacancy_id, dt, avg_salary FROM sal")
def salary_asof_changing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salaries by the quotes in force; a wrong day, a repeated quote or an unknown code would show."""
    from labormart.operators.asof import salaries_asof

    rows = salaries_asof(td.vacancies(spark, sf_dir), changing_quotes(spark, sf_dir), REFERENCE, _known_currencies(spark))
    return rows.select("vacancy_id", "dt", "avg_salary")


@register(
    "rates_changing_daily",
    f"""WITH {_QUOTES_SQL.strip()},
spine AS (SELECT CAST(d AS DATE) AS dt FROM range((SELECT MIN(dt) FROM days), (SELECT MAX(dt) FROM days) + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)),
grid AS (SELECT s.dt, c.char_code FROM spine s, (SELECT DISTINCT char_code FROM known) c),
met AS (SELECT g.dt, g.char_code, k.dt AS quote_dt FROM grid g ASOF JOIN known_days k ON g.char_code = k.char_code AND g.dt >= k.dt)
SELECT m.char_code, m.dt, m.quote_dt, q.value, q.nominal FROM met m JOIN known q ON q.char_code = m.char_code AND q.dt = m.quote_dt""",
)
def rates_changing_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day-by-day fill of the same quotes, for known currencies."""
    from labormart.operators.asof import observed_days
    from labormart.operators.rates import asof_fill

    _, last = td.order_date_bounds(spark, sf_dir)
    known = changing_quotes(spark, sf_dir).join(_known_currencies(spark), "char_code", "left_semi")
    days = observed_days(known, "char_code", "dt", ["value", "nominal"]).withColumnRenamed("dt", "quote_dt")
    filled = asof_fill(days, ["char_code"], "quote_dt", end=last)
    return filled.select("char_code", "dt", "quote_dt", F.explode("quotes").alias("q")).select("char_code", "dt", "quote_dt", "q.value", "q.nominal")


# ---- marts from states that merge (C1, C3, U3) ----------------------------------------


def _states_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches, out of order; every fifth vacancy first came in another version that a later batch replaces."""
    from labormart.operators import states

    vac, rates, cities = td.vacancies(spark, sf_dir), td.rates(spark, sf_dir), td.cities(spark, sf_dir)
    early = vac.where("vacancy_id % 5 = 0").withColumns({"experience": F.lit("noExperience"), "schedule": F.lit("shift"), "salary_to": F.lit(None).cast("decimal(18,2)")})
    part = lambda rows, b: states.contributions(rows.where(F.pmod(F.col("vacancy_id"), F.lit(4)) == b), rates, cities)
    stored = states.summed(states.contributions(early, rates, cities))
    for b in (2, 0, 3, 1):
        stored = states.merged(stored, states.changes(part(early, b), part(vac, b)))
    return stored


@register("metrics_from_states", ORACLE["metrics_daily"])
def metrics_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics read off states that batches have merged into, retractions included."""
    from labormart.operators import states

    return states.metrics_from_states(_states_in_batches(spark, sf_dir), REFERENCE, "day")


@register("metrics_weekly_from_states", ORACLE["metrics_weekly"])
def metrics_weekly_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly metrics added up from the same daily states."""
    from labormart.operators import states

    return states.metrics_from_states(_states_in_batches(spark, sf_dir), REFERENCE, "week")


# ---- any window of days from dyadic blocks (A13, A14, C11, C12) -----------------------

_WINDOWS_SQL = """
bounds AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS first_day FROM orders),
windows AS (SELECT CAST(range AS INTEGER) AS window_id, CAST(first_day + INTERVAL 1 DAY * (range * 97 - 20) AS DATE) AS first_day,
                   CAST(first_day + INTERVAL 1 DAY * (range * 97 - 20 + range * range * 5 % 800) AS DATE) AS last_day FROM bounds, range(24))"""


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, _ = td.order_date_bounds(spark, sf_dir)
    i = F.col("id").cast("int")
    return spark.range(24).select(i.alias("window_id"), F.date_add(first, i * 97 - 20).alias("first_day"), F.date_add(first, i * 97 - 20 + (i * i * 5) % 800).alias("last_day"))


@register(
    "skills_any_window",
    "WITH "
    + O.skill_counts_cte()
    + f""",{_WINDOWS_SQL}
SELECT w.window_id, s.skill_name, CAST(SUM(s.cnt) AS BIGINT) AS cnt
FROM windows w JOIN sc s ON s.dt BETWEEN w.first_day AND w.last_day GROUP BY ALL""",
)
def skills_any_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skill counts of 24 windows of 0 to 800 days, each from O(log days) blocks."""
    from labormart.operators import marts, windows
    from labormart.plans.catalog import _skill_links
    from labormart.session import materialize

    counts = marts.skill_counts(_skill_links(spark, sf_dir, td.vacancies(spark, sf_dir)), None, td.cities(spark, sf_dir))
    blocks = materialize(spark, windows.dyadic_blocks(counts, ["skill_name"], ["cnt"]), "skill-blocks")
    return windows.sums_of_windows(blocks, _windows(spark, sf_dir), "window_id", "first_day", "last_day", ["skill_name"], ["cnt"])


_SCHEDULE_SUMS = ["remote_schedule_cnt", "full_day_schedule_cnt", "cnt"]


@register(
    "schedules_any_window",
    f"""WITH {O.vacancies_cte()},{_WINDOWS_SQL}
SELECT w.window_id, v.city_name, v.query_profession_eng_name, COUNT(*) FILTER (WHERE schedule = 'remote') AS remote_schedule_cnt,
       COUNT(*) FILTER (WHERE schedule = 'fullDay') AS full_day_schedule_cnt, COUNT(*) AS cnt
FROM windows w JOIN v ON v.dt BETWEEN w.first_day AND w.last_day GROUP BY ALL""",
)
def schedules_any_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule counts of the same windows, per city and profession."""
    from labormart.operators import states, windows
    from labormart.session import materialize

    daily = states.summed(states.contributions(td.vacancies(spark, sf_dir), td.rates(spark, sf_dir), td.cities(spark, sf_dir)))
    keys = ["city_name", "query_profession_eng_name"]
    blocks = materialize(spark, windows.dyadic_blocks(daily, keys, _SCHEDULE_SUMS), "schedule-blocks")
    return windows.sums_of_windows(blocks, _windows(spark, sf_dir), "window_id", "first_day", "last_day", keys, _SCHEDULE_SUMS)


# ---- checks observed while writing (Q-NN, Q-LEN, Q-UQ, Q-FK) -------------------------------


@register(
    "observed_checks",
    f"""WITH {O.vacancies_cte()},
listed AS (SELECT n_nationkey AS id FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name <> 'MIDDLE EAST'),
w AS (SELECT * FROM v UNION ALL SELECT * FROM v WHERE vacancy_id % 10 = 0)
SELECT 'rows' AS check, 'append' AS target, CAST(0 AS BIGINT) AS n_findings, COUNT(*) AS n_rows FROM w
UNION ALL SELECT 'not_null', c, CASE c WHEN 'vacancy_id' THEN COUNT(*) FILTER (WHERE vacancy_id IS NULL) WHEN 'city_id' THEN COUNT(*) FILTER (WHERE city_id IS NULL) ELSE COUNT(*) FILTER (WHERE query_profession_eng_name IS NULL) END, COUNT(*)
  FROM w, (VALUES ('vacancy_id'), ('city_id'), ('query_profession_eng_name')) t(c) GROUP BY c
UNION ALL SELECT 'length', 'profession', COUNT(*) FILTER (WHERE length(profession) > 100), COUNT(*) FROM w
UNION ALL SELECT 'length', 'salary_currency', COUNT(*) FILTER (WHERE length(salary_currency) > 10), COUNT(*) FROM w
UNION ALL SELECT 'length', 'experience', COUNT(*) FILTER (WHERE length(experience) > 20), COUNT(*) FROM w
UNION ALL SELECT 'length', 'schedule', COUNT(*) FILTER (WHERE length(schedule) > 20), COUNT(*) FROM w
UNION ALL SELECT 'unique', 'vacancy_id,dt,query_profession_eng_name', (SELECT COUNT(*) FROM v WHERE vacancy_id % 10 = 0), COUNT(*) FROM w
UNION ALL SELECT 'foreign_key', 'city_id->d_city', COUNT(*) FILTER (WHERE city_id NOT IN (SELECT id FROM listed)), COUNT(*) FROM w
UNION ALL SELECT 'foreign_key', 'query_profession_eng_name->d_query_profession', CAST(0 AS BIGINT), COUNT(*) FROM w""",
)
def observed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-NN to Q-FK of written vacancy rows (every tenth twice, some cities unlisted), counted as they are written."""
    from labormart.operators.observed import ObservedTables
    from labormart.plans.catalog import _listed_cities, _staged_tables

    tables = ObservedTables(_staged_tables(spark, sf_dir))
    tables.inner.put("d_city", _listed_cities(spark, sf_dir))
    vac = td.vacancies(spark, sf_dir)
    tables.put("d_vacancies", vac.unionByName(vac.where("vacancy_id % 10 = 0")), "append")
    return tables.findings().select("check", "target", "n_findings", "n_rows")


# ---- keyed dimensions (A8, A9, U2, U4, X18, X19) ----------------------------------------


@register(
    "skill_dimension",
    f"""WITH {O.vacancies_cte()}
SELECT DISTINCT p.p_name AS name FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN v ON v.vacancy_id = l.l_orderkey""",
)
def skill_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8/SNK3: the skill names that a first load inserts, once each."""
    from labormart.operators.merge import insert_new
    from labormart.operators.parse import skill_entries, skill_names
    from labormart.plans.tables import empty_table
    from labormart.schemas import D_SKILL

    names = skill_names(skill_entries(td.vacancy_documents(spark, sf_dir)))
    return insert_new(empty_table(spark, D_SKILL), names, ["name"]).select("name")


@register(
    "currency_upsert",
    """WITH bounds AS (SELECT CAST(MAX(year(o_orderdate)) AS VARCHAR) AS y FROM orders)
SELECT 'old' AS exchange_rates_id, '1' AS num_code, 'GBP' AS char_code, 'Pound, before' AS name
UNION ALL SELECT 'R840', '840', 'USD', 'US Dollar of ' || y FROM bounds
UNION ALL SELECT 'R978', '978', 'EUR', 'Euro of ' || y FROM bounds""",
)
def currency_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A currency's latest record of all documents replaces the stored one; others stay."""
    from labormart.operators.merge import upsert
    from labormart.operators.parse import currency_dimension_rows, rate_records

    stored = spark.createDataFrame([("old", "1", "GBP", "Pound, before"), ("old", "2", "USD", "Dollar, before")], "exchange_rates_id string, num_code string, char_code string, name string")
    days = td.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("query_dt")).distinct()
    named = lambda code, num, name: F.struct(F.lit(f"R{num}").alias("ID"), F.lit(num).alias("NumCode"), F.lit(code).alias("CharCode"), F.concat(F.lit(f"{name} of "), F.year("query_dt").cast("string")).alias("Name"), F.lit("1").alias("Value"), F.lit("1").alias("Previous"), F.lit("1").alias("Nominal"))
    valute = F.create_map(F.lit("USD"), named("USD", "840", "US Dollar"), F.lit("EUR"), named("EUR", "978", "Euro"))
    docs = days.select(F.to_json(F.struct(F.col("query_dt").cast("string").alias("Date"), valute.alias("Valute"))).alias("obj"), "query_dt", F.col("query_dt").cast("timestamp_ntz").alias("update_ts"))
    return upsert(stored, currency_dimension_rows(rate_records(docs), CORRECTED), ["char_code"], on_duplicate=None)


@register(
    "skills_upsert",
    "WITH "
    + O.skill_counts_cte()
    + """,
again AS (
  SELECT v.city_name, v.query_profession_eng_name, v.dt, links.skill_name, CAST(SUM(links.n_links) AS INTEGER) AS cnt
  FROM links JOIN v ON links.vacancy_id = v.vacancy_id WHERE v.vacancy_id % 2 = 0 GROUP BY ALL
),
newer AS (SELECT *, CAST(row_number() OVER (PARTITION BY city_name, query_profession_eng_name, dt ORDER BY cnt DESC, skill_name) AS INTEGER) AS top FROM again)
SELECT r.city_name, r.query_profession_eng_name, r.skill_name, r.dt, COALESCE(n.top, r.top) AS top, COALESCE(n.cnt, r.cnt) AS cnt
FROM ranked r LEFT JOIN newer n USING (city_name, query_profession_eng_name, skill_name, dt)""",
)
def skills_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4/Q6: a later ranking of half the vacancies replaces the places of its keys; the others keep theirs."""
    from labormart.operators import marts
    from labormart.operators.merge import upsert
    from labormart.plans.catalog import _skill_links, _skills_ranked
    from labormart.session import materialize

    stored = _skills_ranked(spark, sf_dir)
    half = td.vacancies(spark, sf_dir).where("vacancy_id % 2 = 0")
    newer = materialize(spark, marts.skills_mart(_skill_links(spark, sf_dir, half), None, td.cities(spark, sf_dir)), "newer-ranking")
    return upsert(stored, newer, ["city_name", "query_profession_eng_name", "skill_name", "dt"], partition_cols=["dt"], on_duplicate=None)


@register(
    "metrics_by_city_code",
    O.metrics_rows_cte("day") + "\nSELECT n.n_nationkey AS city_id, CAST(SUM(m.cnt) AS BIGINT) AS cnt FROM m JOIN nation n ON n.n_name = m.city_name GROUP BY ALL",
)
def metrics_by_city_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the mart turned into codes by the city dimension."""
    from labormart.operators.joins import broadcast_if_small
    from labormart.sources.dims import city_lookup

    rows = _daily(spark, sf_dir).join(broadcast_if_small(city_lookup(td.cities(spark, sf_dir))), "city_name")
    return rows.groupBy("city_id").agg(F.sum("cnt").alias("cnt"))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labormart.plans.catalog import metrics_daily

    return metrics_daily(spark, sf_dir)


_ABC = ("AEOINRST", "АЕОИНРСТ")


@register(
    "records_unescaped",
    f"""SELECT '{{"id":' || CAST(o_orderkey AS VARCHAR) || ',"name":"' || translate(o_orderpriority, '{_ABC[0]}', '{_ABC[1]}') || '"}}' AS record FROM orders""",
)
def records_unescaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X19/SNK7: JSON records keep letters beyond ASCII as they are."""
    from labormart.operators.serve import to_records

    return to_records(td.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.translate("o_orderpriority", *_ABC).alias("name")))

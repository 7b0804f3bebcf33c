"""SQL fragments shared by the DuckDB oracle statements.

The oracle re-derives every table from the generated star schema with plain
SQL, independently of the Spark code, so both sides meet only in the result.
"""

from __future__ import annotations

from labormart.schemas import EXPERIENCE_BANDS, SCHEDULES
from labormart.sources.testdata import (
    FIXED_RATES,
    PRIORITY_TO_EXPERIENCE,
    REGION_TO_CURRENCY,
    STATUS_TO_SCHEDULE,
)


def _case(col: str, mapping: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {arms} END"


def _values(rows) -> str:
    return ", ".join(rows)


CURRENCY_VALUES = _values(f"('{r}', '{c}')" for r, c in REGION_TO_CURRENCY.items())
# the oracle engine turns decimal division into DOUBLE, so ``/ nominal`` is
# written as a multiplication by the exact decimal 1/nominal (nominals are powers of ten)
RATE_VALUES = _values(
    f"('{code}', CAST('{value}' AS DECIMAL(10,4)), {nominal}, CAST('{1 / nominal:.6f}' AS DECIMAL(10,6)))"
    for code, value, nominal, _, _ in FIXED_RATES
)


def vacancies_cte(schedule_len: int = 10) -> str:
    """``v``: typed vacancy rows with city name (one row per order)."""
    return f"""
cur(r_name, code) AS (VALUES {CURRENCY_VALUES}),
v AS (
  SELECT o.o_orderkey AS vacancy_id,
         c.c_nationkey AS city_id,
         n.n_name AS city_name,
         c.c_mktsegment AS query_profession_eng_name,
         c.c_name AS profession,
         CAST(o.o_orderdate AS DATE) AS dt,
         cur.code AS salary_currency,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS salary_from,
         CASE WHEN c.c_acctbal >= 0 THEN CAST(c.c_acctbal AS DECIMAL(18,2)) END AS salary_to,
         {_case('o.o_orderpriority', PRIORITY_TO_EXPERIENCE)} AS experience,
         LEFT({_case('o.o_orderstatus', STATUS_TO_SCHEDULE)}, {schedule_len}) AS schedule,
         CAST(o.o_orderdate AS TIMESTAMP) AS published_at
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN cur ON cur.r_name = r.r_name
)"""


def salaries_cte(precision: int = 10, use_nominal: bool = False, src: str = "v") -> str:
    """``sal``: ``src`` plus ``avg_salary`` (per-vacancy midpoint in home currency)."""
    t = f"DECIMAL({precision},2)"
    conv = ("CAST({x} AS DECIMAL(38,2)) * rate.value * rate.inv_nominal" if use_nominal else "{x} * rate.value")
    f_, t_ = conv.format(x="salary_from"), conv.format(x="salary_to")
    return f"""
rate(code, value, nominal, inv_nominal) AS (VALUES {RATE_VALUES}),
sal AS (
  SELECT {src}.*,
    CAST((CAST(CASE WHEN salary_currency = 'RUR' THEN COALESCE(salary_from, salary_to)
                    WHEN salary_currency <> 'RUR' THEN COALESCE({f_}, {t_}) END AS {t})
        + CAST(CASE WHEN salary_currency = 'RUR' THEN COALESCE(salary_to, salary_from)
                    WHEN salary_currency <> 'RUR' THEN COALESCE({t_}, {f_}) END AS {t})) * 0.5 AS {t}) AS avg_salary
  FROM {src} LEFT JOIN rate ON {src}.salary_currency = rate.code
)"""


def exact_avg_sql(expr: str, precision: int = 10, zero_when_empty: bool = True) -> str:
    """Average of a 2-decimal value, rounded half away from zero, via integer cents."""
    s = f"SUM(CAST({expr} * 100 AS HUGEINT))"
    n = f"COUNT({expr})"
    cents = f"CASE WHEN {n} = 0 THEN NULL ELSE SIGN({s}) * ((2 * ABS({s}) + {n}) // (2 * {n})) END"
    val = f"CAST(CAST({cents} AS DECIMAL(38,0)) * 0.01 AS DECIMAL({precision},2))"
    return f"COALESCE({val}, CAST(0 AS DECIMAL({precision},2)))" if zero_when_empty else val


def metric_measures_sql(precision: int = 10, zero_when_empty: bool = True) -> str:
    cols = ["CAST(COUNT(vacancy_id) AS INTEGER) AS cnt"]
    for p, v in EXPERIENCE_BANDS:
        cols.append(f"CAST(COUNT(vacancy_id) FILTER (WHERE experience = '{v}') AS INTEGER) AS {p}_cnt")
    for p, v in EXPERIENCE_BANDS:
        e = f"CASE WHEN experience = '{v}' THEN avg_salary END"
        cols.append(f"{exact_avg_sql(e, precision, zero_when_empty)} AS {p}_avg_salary")
    for p, v in SCHEDULES:
        cols.append(f"CAST(COUNT(vacancy_id) FILTER (WHERE schedule = '{v}') AS INTEGER) AS {p}_schedule_cnt")
    return ",\n  ".join(cols)


def metrics_sql(grain: str = "day", where: str = "TRUE", src: str = "sal") -> str:
    period = "dt" if grain == "day" else "CAST(date_trunc('week', dt) AS DATE)"
    return f"""
SELECT city_name, query_profession_eng_name, {period} AS dt,
  {metric_measures_sql()}
FROM {src}
WHERE {where}
GROUP BY city_name, query_profession_eng_name, {period}"""


def metrics_rows_cte(grain: str = "day", where: str = "TRUE") -> str:
    return f"WITH {vacancies_cte()},{salaries_cte()},\nm AS ({metrics_sql(grain, where)})"


def skill_counts_cte() -> str:
    """``sc``: link counts per (city, profession, day, skill) from line items."""
    return f"""
{vacancies_cte()},
links AS (
  SELECT l.l_orderkey AS vacancy_id, p.p_name AS skill_name, COUNT(*) AS n_links
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY l.l_orderkey, p.p_name
),
sc AS (
  SELECT v.city_name, v.query_profession_eng_name, v.dt, links.skill_name,
         CAST(SUM(links.n_links) AS INTEGER) AS cnt
  FROM links JOIN v ON links.vacancy_id = v.vacancy_id
  GROUP BY v.city_name, v.query_profession_eng_name, v.dt, links.skill_name
),
ranked AS (
  SELECT city_name, query_profession_eng_name, skill_name, dt,
         CAST(row_number() OVER (PARTITION BY city_name, query_profession_eng_name, dt
                                 ORDER BY cnt DESC, skill_name) AS INTEGER) AS top,
         cnt
  FROM sc
)"""

"""Data marts: conditional metrics per (city, profession, period) and skill ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labormart.functions.dates import week_start
from labormart.functions.salary import exact_avg, salary_midpoint
from labormart.operators.joins import broadcast_if_small
from labormart.operators.rates import rate_lookup
from labormart.schemas import EXPERIENCE_BANDS, METRIC_MEASURES, SCHEDULES
from labormart.semantics import REFERENCE, Semantics


# ---- generic conditional aggregates ----------------------------------------------


def conditional_counts(
    column: str, values: list[tuple[str, str]], count_col: str = "vacancy_id", suffix: str = "_cnt"
) -> list[Column]:
    """``count(count_col) FILTER (WHERE column = value)`` for each (name, value)."""
    return [
        F.count(F.when(F.col(column) == F.lit(v), F.col(count_col))).cast("int").alias(f"{name}{suffix}")
        for name, v in values
    ]


def conditional_avgs(
    column: str,
    values: list[tuple[str, str]],
    measure: str,
    sem: Semantics = REFERENCE,
    suffix: str = "_avg_salary",
) -> list[Column]:
    """``coalesce(avg(measure) FILTER (WHERE column = value)::numeric(p,2), 0)`` per value.

    With ``sem.empty_avg_as_null`` a band without salaries stays NULL.
    """
    out = []
    for name, v in values:
        a = exact_avg(F.when(F.col(column) == F.lit(v), F.col(measure)), sem.salary_precision)
        if not sem.empty_avg_as_null:
            a = F.coalesce(a, F.lit(0).cast(f"decimal({sem.salary_precision},2)"))
        out.append(a.alias(f"{name}{suffix}"))
    return out


def metric_aggregates(sem: Semantics = REFERENCE, count_col: str = "vacancy_id") -> list[Column]:
    """The 14 mart measures, in the mart's column order."""
    return [
        F.count(F.col(count_col)).cast("int").alias("cnt"),
        *conditional_counts("experience", EXPERIENCE_BANDS, count_col),
        *conditional_avgs("experience", EXPERIENCE_BANDS, "avg_salary", sem),
        *conditional_counts("schedule", SCHEDULES, count_col, "_schedule_cnt"),
    ]


# ---- metrics mart --------------------------------------------------------------


def vacancy_salaries(vacancies: DataFrame, rates: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """One row per vacancy and distinct converted salary (``avg_salary``).

    ``rates`` carries (char_code, dt, value, nominal), possibly repeated. A
    vacancy without currency, rate or salary keeps one row with NULL salary.
    """
    lookup = broadcast_if_small(rate_lookup(rates).select(F.col("char_code").alias("_code"), F.col("dt").alias("_day"), "quotes"))
    joined = vacancies.join(lookup, (F.col("salary_currency") == F.col("_code")) & (F.col("dt") == F.col("_day")), "left").drop("_code", "_day")

    def mid(rate: Column, nominal: Column) -> Column:
        return salary_midpoint("salary_currency", "salary_from", "salary_to", rate, nominal, sem)

    per_quote = F.array_distinct(F.transform(F.col("quotes"), lambda q: mid(q["value"], q["nominal"])))
    no_quote = F.array(mid(F.lit(None).cast("decimal(10,4)"), F.lit(None).cast("int")))
    salaries = F.when(F.size(F.col("quotes")) > 0, per_quote).otherwise(no_quote)
    return joined.withColumn("avg_salary", F.explode(salaries)).drop("quotes")


def metrics_mart(
    vacancies: DataFrame,
    rates: DataFrame,
    cities: DataFrame,
    sem: Semantics = REFERENCE,
    grain: str = "day",
) -> DataFrame:
    """dm_metrics rows: 14 measures per (city_name, query_profession_eng_name, dt).

    ``grain="week"`` groups by the Monday of the week (full load). Plan:
    broadcast lookups (rates, cities) → partial aggregate → one shuffle on the
    mart key → final aggregate; the big side is never shuffled row by row.
    """
    sal = vacancy_salaries(vacancies, rates, sem)
    city = broadcast_if_small(cities.select(F.col("id").alias("_cid"), F.col("name").alias("city_name")))
    rows = sal.join(city, sal["city_id"] == city["_cid"], "left").drop("_cid")
    period = F.col("dt") if grain == "day" else week_start("dt")
    keys = [F.col("city_name"), F.col("query_profession_eng_name"), period.alias("dt")]
    out = rows.groupBy(*keys).agg(*metric_aggregates(sem))
    if sem.grain_column:
        out = out.withColumn("grain", F.lit(grain))
    return out


def metric_columns(sem: Semantics = REFERENCE) -> list[str]:
    base = ["city_name", "query_profession_eng_name", "dt"] + METRIC_MEASURES
    return base + (["grain"] if sem.grain_column else [])


# ---- skills mart ---------------------------------------------------------------


def skill_counts(bridge: DataFrame, vacancies: DataFrame | None, cities: DataFrame) -> DataFrame:
    """count of links per (city_name, query_profession_eng_name, dt, skill_name).

    ``bridge`` holds (vacancy_id, dt, query_profession_eng_name, skill_name,
    n_links); it is pre-aggregated, so a vacancy with many identical links
    costs one row in the join. The city comes from the current vacancy rows
    (``vacancies``), or from a ``city_id`` the links carry when
    ``vacancies`` is None.
    """
    key = ["vacancy_id", "dt", "query_profession_eng_name"]
    city = broadcast_if_small(cities.select(F.col("id").alias("city_id"), F.col("name").alias("city_name")))
    if vacancies is None:
        # broadcast name lookup first, then a single aggregate by city name
        joined = bridge.join(city, "city_id", "inner")
    else:
        # links of one vacancy and skill from several loads are added up below, with all others
        vac = vacancies.select(*key, "city_id")
        joined = bridge.join(vac, key, "inner").join(city, "city_id", "inner")
    return joined.groupBy("city_name", "query_profession_eng_name", "dt", "skill_name").agg(
        F.sum("n_links").cast("int").alias("cnt")
    )


def rank_skills(counts: DataFrame, sem: Semantics = REFERENCE, partition: list[str] | None = None) -> DataFrame:
    """``row_number() over (partition by city, profession, dt order by cnt desc, skill_name)``."""
    part = partition or ["city_name", "query_profession_eng_name", "dt"]
    name = F.col("skill_name")
    if sem.name_collation:
        name = F.collate(name, sem.name_collation)
    w = Window.partitionBy(*part).orderBy(F.col("cnt").desc(), name.asc())
    return counts.withColumn("top", F.row_number().over(w).cast("int"))


def skills_mart(bridge: DataFrame, vacancies: DataFrame | None, cities: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """dm_skills rows: (city_name, query_profession_eng_name, skill_name, dt, top, cnt)."""
    ranked = rank_skills(skill_counts(bridge, vacancies, cities), sem)
    return ranked.select("city_name", "query_profession_eng_name", "skill_name", "dt", "top", "cnt")


def top_k_per_group(ranked: DataFrame, k: int, rank_col: str = "top") -> DataFrame:
    """Keep the first ``k`` ranks of every group (Spark plans a WindowGroupLimit)."""
    return ranked.where(F.col(rank_col) <= k)

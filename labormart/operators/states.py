"""The metrics mart from stored partial states that merge.

A state is one row per (city, profession, day) of sums and counts. States add
up: any order and any split of the vacancies gives the same state, days make up
weeks, and a vacancy that is replaced takes its old contribution back by a
negative one. Day and week rows of the mart are then read off the states, so a
micro-batch touches its own vacancies instead of the whole day's.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labormart.functions.dates import week_start
from labormart.operators.joins import broadcast_if_small
from labormart.operators.marts import vacancy_salaries
from labormart.schemas import EXPERIENCE_BANDS, SCHEDULES
from labormart.semantics import REFERENCE, Semantics

STATE_KEY = ["city_name", "query_profession_eng_name", "dt"]
_COUNTS = ["cnt", *[f"{n}_cnt" for n, _ in EXPERIENCE_BANDS], *[f"{n}_schedule_cnt" for n, _ in SCHEDULES]]
_CENTS = [f"{n}_cents" for n, _ in EXPERIENCE_BANDS]
_PAID = [f"{n}_paid" for n, _ in EXPERIENCE_BANDS]
#: All additive columns of a state.
STATE_VALUES = [*_COUNTS, *_CENTS, *_PAID]


def contributions(vacancies: DataFrame, rates: DataFrame, cities: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """What each vacancy (and distinct salary of it) adds to its state."""
    sal = vacancy_salaries(vacancies, rates, sem)
    city = broadcast_if_small(cities.select(F.col("id").alias("_cid"), F.col("name").alias("city_name")))
    rows = sal.join(city, sal["city_id"] == city["_cid"], "left")
    one = F.when(F.col("vacancy_id").isNotNull(), 1).otherwise(0).cast("long")
    if_ = lambda test, value: F.when(test, value).otherwise(0).cast("long")
    cents = (F.col("avg_salary") * 100).cast("decimal(20,0)").cast("long")
    band = lambda v: F.col("experience") == v
    return rows.select(
        *STATE_KEY,
        one.alias("cnt"),
        *[if_(band(v), one).alias(f"{n}_cnt") for n, v in EXPERIENCE_BANDS],
        *[if_(F.col("schedule") == v, one).alias(f"{n}_schedule_cnt") for n, v in SCHEDULES],
        *[if_(band(v), cents).alias(f"{n}_cents") for n, v in EXPERIENCE_BANDS],
        *[if_(band(v) & F.col("avg_salary").isNotNull(), F.lit(1)).alias(f"{n}_paid") for n, v in EXPERIENCE_BANDS],
    )


def summed(rows: DataFrame, keys: list[str | Column] | None = None) -> DataFrame:
    """States of ``rows`` (contributions or states), added up; those that have come to nothing are left out."""
    added = rows.groupBy(*(keys or STATE_KEY)).agg(*[F.sum(c).alias(c) for c in STATE_VALUES])
    return added.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in STATE_VALUES]))


def negated(rows: DataFrame) -> DataFrame:
    return rows.select(*STATE_KEY, *[(-F.col(c)).alias(c) for c in STATE_VALUES])


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """The state by which contributions ``after`` differ from ``before`` (retractions and additions)."""
    return summed(after.unionByName(negated(before)))


def merged(*states: DataFrame) -> DataFrame:
    return summed(reduce(lambda a, b: a.unionByName(b), states))


def _average(cents: Column, n: Column, sem: Semantics) -> Column:
    """Mean of whole cents, rounded half away from zero, exactly."""
    value = F.signum(cents).cast("long") * F.call_function("div", F.abs(cents) * 2 + n, n * 2)
    return F.when(n > 0, (value.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(f"decimal({sem.salary_precision},2)"))


def metrics_from_states(states: DataFrame, sem: Semantics = REFERENCE, grain: str = "day") -> DataFrame:
    """dm_metrics rows read off the states; ``grain="week"`` adds up the days of each week first."""
    if grain == "week":
        states = summed(states.withColumn("dt", week_start("dt")))
    zero = F.lit(0).cast(f"decimal({sem.salary_precision},2)")
    average = [(n, _average(F.col(f"{n}_cents"), F.col(f"{n}_paid"), sem)) for n, _ in EXPERIENCE_BANDS]
    out = states.where("cnt > 0").select(
        *STATE_KEY,
        F.col("cnt").cast("int").alias("cnt"),
        *[F.col(f"{n}_cnt").cast("int").alias(f"{n}_cnt") for n, _ in EXPERIENCE_BANDS],
        *[(a if sem.empty_avg_as_null else F.coalesce(a, zero)).alias(f"{n}_avg_salary") for n, a in average],
        *[F.col(f"{n}_schedule_cnt").cast("int").alias(f"{n}_schedule_cnt") for n, _ in SCHEDULES],
    )
    return out.withColumn("grain", F.lit(grain)) if sem.grain_column else out


def changed_rate_days(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(dt)``: days whose distinct quotes are not the same any more."""
    quote = ["char_code", "dt", "value", "nominal"]
    old, new = before.select(*quote).distinct(), after.select(*quote).distinct()
    return old.exceptAll(new).unionByName(new.exceptAll(old)).select("dt").distinct()

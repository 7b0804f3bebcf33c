"""J8 + J11: as-of lookup of changing quotes, without filling every day.

Observations are sparse; a quote holds until the next one of its series. They
are grouped by (series, month): the days of that month with their quotes, in
order, led by the last day before it. A row then meets exactly one such group,
by an equi-join on (series, month of its day), and takes the group's last day
that is not later than its own. No row is multiplied, and the groups are bounded
by the calendar: at most 32 days each, at most one group a series and month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labormart.functions.salary import salary_midpoint
from labormart.operators.joins import broadcast_if_small
from labormart.semantics import REFERENCE, Semantics


def observed_days(quotes: DataFrame, key: str, day: str, values: list[str]) -> DataFrame:
    """``(key, day, quotes)``: the distinct quotes of every day that has one (A10)."""
    known = quotes.where(F.col(key).isNotNull() & F.col(day).isNotNull())
    return known.groupBy(key, F.col(day).cast("date").alias(day)).agg(F.array_sort(F.collect_set(F.struct(*values))).alias("quotes"))


def month_groups(observed: DataFrame, key: str, day: str, until: Column) -> DataFrame:
    """``(key, _month, _days)``: for every month from a series' first observation up to ``until``.

    ``_days`` holds the observations of the month in order, led by the last one
    before it; a month without any has that one alone.
    """
    month = F.trunc(F.col(day), "month").alias("_month")
    own = observed.groupBy(key, month).agg(F.sort_array(F.collect_list(F.struct(F.col(day).alias("day"), "quotes"))).alias("_own"))
    by_series = Window.partitionBy(key).orderBy("_month")  # one row a month
    last = F.element_at("_own", -1)
    own = own.withColumns({"_before": F.lag(last).over(by_series), "_next": F.lead("_month").over(by_series)})
    led = F.concat(F.when(F.col("_before").isNull(), F.array().cast(own.schema["_own"].dataType)).otherwise(F.array("_before")), F.col("_own"))
    first = own.select(key, "_month", led.alias("_days"))
    end = F.coalesce(F.add_months("_next", -1), F.trunc(until, "month"))
    after = F.add_months("_month", 1)
    months = F.when(after <= end, F.sequence(after, end, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))
    rest = own.select(key, F.explode(months).alias("_month"), F.array(last).alias("_days"))
    return first.unionByName(rest)


def asof_quotes(rows: DataFrame, quotes: DataFrame, row_key: str, row_day: str, key: str, day: str, values: list[str], name: str = "quotes") -> DataFrame:
    """``rows`` with ``name``: the distinct quotes of the latest observed day not after the row's own.

    NULL where the series is unknown, the day is NULL, or nothing was observed
    yet. The months are broadcast after their size check; beyond it both sides
    meet on (series, month).
    """
    observed = observed_days(quotes, key, day, values)
    until = rows.select(F.max(F.col(row_day).cast("date"))).scalar()
    groups = month_groups(observed, key, day, until).select(F.col(key).alias("_series"), "_month", "_days")
    groups = broadcast_if_small(groups)
    met = rows.join(groups, (F.col(row_key) == F.col("_series")) & (F.trunc(F.col(row_day).cast("date"), "month") == F.col("_month")), "left")
    held = F.filter("_days", lambda d: d["day"] <= F.col(row_day).cast("date"))
    return met.withColumn(name, F.when(F.size(held) > 0, F.element_at(held, -1)["quotes"])).drop("_series", "_month", "_days")


def salaries_asof(vacancies: DataFrame, quotes: DataFrame, sem: Semantics = REFERENCE, currencies: DataFrame | None = None, day: str = "dt") -> DataFrame:
    """One row per vacancy and distinct converted salary, by the quotes in force on its day.

    ``quotes`` has (char_code, ``day``, value, nominal), sparse and possibly
    repeated; ``currencies`` (char_code) drops the quotes of unknown codes.
    """
    if currencies is not None:
        quotes = quotes.join(broadcast_if_small(currencies.select("char_code").distinct()), "char_code", "left_semi")
    met = asof_quotes(vacancies, quotes, "salary_currency", "dt", "char_code", day, ["value", "nominal"])

    def middle(rate: Column, nominal: Column) -> Column:
        return salary_midpoint("salary_currency", "salary_from", "salary_to", rate, nominal, sem)

    some = F.array_distinct(F.transform("quotes", lambda q: middle(q["value"], q["nominal"])))
    none = F.array(middle(F.lit(None).cast("decimal(10,4)"), F.lit(None).cast("int")))
    return met.withColumn("avg_salary", F.explode(F.when(F.size("quotes") > 0, some).otherwise(none))).drop("quotes")

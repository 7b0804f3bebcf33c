"""Dashboard tables built from selected mart rows (the charts are drawings of these).

All four take the rows returned by ``serve.get_metrics`` / ``serve.get_skills``
and aggregate on executors; only the small result is meant to be collected.
``by`` optionally computes the same table per group instead of for one
selection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labormart.schemas import EXPERIENCE_BANDS, SCHEDULES
from labormart.semantics import REFERENCE, Semantics

DASHBOARDS = ("cnt_vacancies", "avg_salary", "cnt_shedule", "skills")

# fixed values: display labels per result column (optional rename, P4)
LABELS = {
    "dt": "Даты",
    "cnt": "Общее количество",
    "no_experience_cnt": "Без опыта",
    "between_1_and_3_cnt": "Опыт 1-3 года",
    "between_3_and_6_cnt": "Опыт 3-6 лет",
    "more_than_6_cnt": "Опыт более 6 лет",
    "no_experience_avg_salary": "Без опыта",
    "between_1_and_3_avg_salary": "Опыт 1-3 года",
    "between_3_and_6_avg_salary": "Опыт 3-6 лет",
    "more_than_6_avg_salary": "Опыт более 6 лет",
    "flexible_schedule_cnt": "Гибкий график",
    "remote_schedule_cnt": "Удаленная работа",
    "full_day_schedule_cnt": "Полный день",
    "shift_schedule_cnt": "Сменный график",
    "fly_in_fly_out_schedule_cnt": "Вахтовый метод",
    "skill_name": "Навык",
}


def with_labels(df: DataFrame, labels: dict[str, str] = LABELS) -> DataFrame:
    """Rename known columns to their display labels."""
    return df.select(*[F.col(c).alias(labels.get(c, c)) for c in df.columns])


def count_trend(metrics: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Total and per-experience vacancy counts by date, ascending (L1)."""
    by = by or []
    cols = ["cnt"] + [f"{p}_cnt" for p, _ in EXPERIENCE_BANDS]
    return metrics.select(*by, "dt", *cols).orderBy(*by, "dt")


def count_trend_long(metrics: DataFrame, by: list[str] | None = None) -> DataFrame:
    """C9 in long form (dt, series, n): one row per plotted point."""
    by = by or []
    cols = ["cnt"] + [f"{p}_cnt" for p, _ in EXPERIENCE_BANDS]
    return metrics.unpivot([*by, "dt"], cols, "series", "n")


def avg_salary(metrics: DataFrame, sem: Semantics = REFERENCE, by: list[str] | None = None) -> DataFrame:
    """Mean salary per experience band over the selected rows (as DOUBLE).

    REFERENCE: unweighted mean of the per-row averages, zeros included.
    ``sem.weighted_dashboard_avg``: weighted by the band's vacancy count and
    rows without salaries (NULL) excluded.
    """
    by = by or []
    aggs = []
    for p, _ in EXPERIENCE_BANDS:
        # exact decimal sum, then one DOUBLE division, not rounded
        a = F.col(f"{p}_avg_salary").cast("decimal(18,2)")
        if sem.weighted_dashboard_avg:
            w = F.col(f"{p}_cnt").cast("decimal(18,0)")
            has = a.isNotNull() & (w > 0)
            total, n = F.sum(F.when(has, a * w)), F.sum(F.when(has, w))
        else:
            total, n = F.sum(a), F.count(a)
        aggs.append((total.cast("double") / F.nullif(n.cast("double"), F.lit(0.0))).alias(f"{p}_avg_salary"))
    return metrics.groupBy(*by).agg(*aggs)


def share_tenths(n: Column, total: Column) -> Column:
    """``round(100 * n / total, 1)`` computed on integers (half up), as DOUBLE."""
    return (F.floor((n * 2000 + total) / (total * 2)) / F.lit(10.0)).cast("double")


def schedule_share(metrics: DataFrame, by: list[str] | None = None) -> DataFrame:
    """C11: vacancies per schedule summed over the rows, positive sums only, with shares.

    Output: (*by, schedule, n, pct); ``pct`` has one decimal and the shares
    of a selection add up to 100 up to rounding.
    """
    by = by or []
    cols = [f"{p}_schedule_cnt" for p, _ in SCHEDULES]
    sums = metrics.groupBy(*by).agg(*[F.sum(c).cast("long").alias(c) for c in cols])
    # the group's total is the row-wise sum of its positive schedule sums
    total = sum((F.greatest(F.col(c), F.lit(0)) for c in cols[1:]), F.greatest(F.col(cols[0]), F.lit(0)))
    long = sums.withColumn("_total", total).unpivot([*by, "_total"], cols, "schedule", "n").where(F.col("n") > 0)
    long = long.withColumn("schedule", F.regexp_replace("schedule", "_schedule_cnt$", ""))
    return long.select(*by, "schedule", "n", share_tenths(F.col("n"), F.col("_total")).alias("pct"))


def pie_label(pct: Column | str, total: Column | str) -> Column:
    """``'{pct:.1f}% ({absolute:d} )'`` with ``absolute = int(pct / 100 * total)``."""
    p = F.col(pct) if isinstance(pct, str) else pct
    t = F.col(total) if isinstance(total, str) else total
    return F.format_string("%.1f%% (%d )", p, (p / 100.0 * t).cast("long"))


def top_skills(skills: DataFrame, k: int = 30, by: list[str] | None = None) -> DataFrame:
    """Skill counts summed over the rows, top ``k`` by count (name breaks ties).

    Output sorted ascending by count for display (L3).
    """
    return top_skills_per_group(skills, by or [], k).orderBy(*(by or []), "cnt", F.col("skill_name").desc())


def top_skills_per_group(skills: DataFrame, by: list[str], k: int = 30) -> DataFrame:
    """Top ``k`` skills by summed count per group (``by`` empty = one selection)."""
    tot = skills.groupBy(*by, "skill_name").agg(F.sum("cnt").cast("long").alias("cnt"))
    if not by:
        # one selection: a global top-k (TakeOrderedAndProject keeps k rows per
        # task); the rank is then numbered over those k rows only
        top = tot.orderBy(F.col("cnt").desc(), F.col("skill_name").asc()).limit(k)
        w = Window.partitionBy(F.lit(0)).orderBy(F.col("cnt").desc(), F.col("skill_name").asc())
        return top.withColumn("top", F.row_number().over(w).cast("int"))
    w = Window.partitionBy(*by).orderBy(F.col("cnt").desc(), F.col("skill_name").asc())
    return tot.withColumn("top", F.row_number().over(w).cast("int")).where(F.col("top") <= k)


def dashboard(kind: str, metrics: DataFrame, skills: DataFrame | None = None, sem: Semantics = REFERENCE) -> DataFrame:
    """Dispatch by dashboard name (F9); an unknown name raises ValueError."""
    if kind == "cnt_vacancies":
        return count_trend(metrics)
    if kind == "avg_salary":
        return avg_salary(metrics, sem)
    if kind == "cnt_shedule":
        return schedule_share(metrics)
    if kind == "skills":
        if skills is None:
            raise ValueError("the skills dashboard needs skill rows")
        return top_skills(skills)
    raise ValueError("Command not found.")

"""Read queries, dashboard tables and data-quality audits."""

import datetime as dt
from decimal import Decimal

import pytest
from helpers import D
from pyspark.sql import functions as F

from labormart import CORRECTED, REFERENCE
from labormart.operators import dashboards as dash
from labormart.operators import quality, serve
from labormart.schemas import dm_metrics


def metrics_rows(spark, rows, sem=REFERENCE):
    """rows: (city, prof, dt, cnt, exp counts (4), avgs (4), schedule counts (5))."""
    return spark.createDataFrame(rows, dm_metrics(sem.salary_precision, False))


def mrow(day, cnt=1, exp=(1, 0, 0, 0), avgs=("0", "0", "0", "0"), sched=(0, 0, 0, 0, 0), city="Москва", prof="Data engineer"):
    return (city, prof, day, cnt, *exp, *[None if a is None else Decimal(a) for a in avgs], *sched)


def test_get_metrics_filters_inclusive_range(spark):
    m = metrics_rows(spark, [mrow(D(2024, 6, d)) for d in range(1, 6)] + [mrow(D(2024, 6, 2), city="Сочи")])
    got = serve.get_metrics(m, "Москва", "Data engineer", "2024-06-02", "2024-06-04").collect()
    assert sorted(r.dt for r in got) == [D(2024, 6, 2), D(2024, 6, 3), D(2024, 6, 4)]


def test_get_metrics_defaults_to_yesterday(spark):
    m = metrics_rows(spark, [mrow(D(2024, 6, 1)), mrow(D(2024, 6, 2))])
    got = serve.get_metrics(m, as_of=D(2024, 6, 3)).collect()
    assert [r.dt for r in got] == [D(2024, 6, 2)]


def test_query_names_are_checked():
    with pytest.raises(ValueError):
        serve.query("vacancies", {})


def test_params_normalised():
    assert serve.normalize_params({"date_from": dt.datetime(2024, 6, 1, 12), "city": "Сочи"}) == {
        "date_from": "2024-06-01",
        "city": "Сочи",
    }


def test_window_check():
    serve.check_window(D(2024, 6, 1), D(2024, 6, 2), today=D(2024, 7, 1))
    with pytest.raises(ValueError):
        serve.check_window(D(2024, 6, 2), D(2024, 6, 2), today=D(2024, 7, 1))
    with pytest.raises(ValueError):
        serve.check_window(D(2024, 5, 1), D(2024, 6, 2), today=D(2024, 7, 1))


def test_trend_sorted_by_date(spark):
    m = metrics_rows(spark, [mrow(D(2024, 6, 3), cnt=3), mrow(D(2024, 6, 1), cnt=1)])
    assert [r.cnt for r in dash.count_trend(m).collect()] == [1, 3]
    assert dash.count_trend_long(m).count() == 10


@pytest.mark.parametrize("sem,expected", [(REFERENCE, 50.0), (CORRECTED, 100.0)])
def test_mean_of_days(spark, sem, expected):
    zero = "0" if sem is REFERENCE else None
    m = metrics_rows(spark, [mrow(D(2024, 6, 1), avgs=("100", "0", "0", "0")), mrow(D(2024, 6, 2), avgs=(zero, "0", "0", "0"))], sem)
    r = dash.avg_salary(m, sem).first()
    assert r.no_experience_avg_salary == expected


def test_schedule_share(spark):
    m = metrics_rows(spark, [mrow(D(2024, 6, 1), sched=(2, 1, 0, 0, 0)), mrow(D(2024, 6, 2), sched=(1, 0, 0, 0, 0))])
    got = {r.schedule: (r.n, r.pct) for r in dash.schedule_share(m).collect()}
    assert got == {"flexible": (3, 75.0), "remote": (1, 25.0)}


def test_shares_add_up_to_hundred(spark):
    rows = [mrow(D(2024, 6, d), sched=(d, 2 * d, 3, d % 2, 1)) for d in range(1, 8)]
    total = sum(r.pct for r in dash.schedule_share(metrics_rows(spark, rows)).collect())
    assert abs(total - 100.0) <= 0.3


def test_top_k_keeps_thirty_and_sorts_for_display(spark):
    skills = spark.createDataFrame(
        [("Москва", "Data engineer", f"skill{i:02d}", D(2024, 6, 1 + i % 2), i % 7 + 1, i + 1) for i in range(31)],
        "city_name string, query_profession_eng_name string, skill_name string, dt date, top int, cnt int",
    )
    top = dash.top_skills(skills, 30).collect()
    assert len(top) == 30
    assert [r.cnt for r in top] == sorted(r.cnt for r in top)
    assert "skill00" not in {r.skill_name for r in top}


def test_empty_selection_gives_empty_tables(spark):
    m = metrics_rows(spark, [mrow(D(2024, 6, 1))])
    empty = serve.get_metrics(m, "Сочи", "Data engineer", "2024-06-01", "2024-06-01")
    assert dash.count_trend(empty).count() == 0
    assert dash.schedule_share(empty).count() == 0


def test_dashboard_dispatch_and_labels(spark):
    m = metrics_rows(spark, [mrow(D(2024, 6, 1))])
    assert "Даты" in dash.with_labels(dash.dashboard("cnt_vacancies", m)).columns
    with pytest.raises(ValueError):
        dash.dashboard("pie", m)


def test_pie_label(spark):
    r = spark.range(1).select(dash.pie_label(F.lit(75.0), F.lit(4)).alias("l")).first()
    assert r.l == "75.0% (3 )"


def test_records_keep_decimals_as_text(spark):
    m = metrics_rows(spark, [mrow(D(2024, 6, 1), avgs=("125000.00", "0", "0", "0"))])
    rec = serve.to_records(m).first().record
    assert '"no_experience_avg_salary":"125000.00"' in rec


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", "x" * 200), (2, None, "y")], "k int, v string, name string")
    nulls = {r.column_name: r.n_null for r in quality.null_counts(df).collect()}
    assert nulls == {"k": 0, "v": 1, "name": 1}
    assert [(r.k, r.n_rows) for r in quality.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    parent = spark.createDataFrame([(1,)], "id int")
    assert [r.k for r in quality.orphans(df, parent, ["k"], ["id"]).collect()] == [2]
    long = quality.too_long(df, {"name": 150}).first()
    assert (long.n_too_long, long.longest) == (1, 200)
    nums = spark.createDataFrame([(Decimal("123456789.12"),), (Decimal("1.00"),)], "x decimal(20,2)")
    assert quality.out_of_range(nums, "x", 10, 2).count() == 1
    summary = {r.check: r.n_findings for r in quality.audit_summary({"dup": quality.duplicate_keys(df, ["k"])}).collect()}
    assert summary == {"dup": 1}


def test_records_round_trip(spark, tmp_path):
    m = metrics_rows(spark, [mrow(D(2024, 6, 1), avgs=("125000.00", "0", "0", "0"))])
    path = str(tmp_path / "records")
    m.write.json(path)
    back = serve.read_records(spark, path, m.schema)
    assert sorted(back.collect()) == sorted(m.collect())


@pytest.mark.parametrize("sem,expected", [(REFERENCE, 150.0), (CORRECTED, 125.0)])
def test_dashboard_mean_weighting(spark, sem, expected):
    rows = [
        mrow(D(2024, 6, 1), cnt=3, exp=(3, 0, 0, 0), avgs=("100", "0", "0", "0")),
        mrow(D(2024, 6, 2), cnt=1, exp=(1, 0, 0, 0), avgs=("200", "0", "0", "0")),
    ]
    assert dash.avg_salary(metrics_rows(spark, rows, sem), sem).first().no_experience_avg_salary == expected

"""Metrics and skills marts on tiny typed inputs (FIXTURES.md §2 cases, both presets)."""

from decimal import Decimal

import pytest
from helpers import TS, D
from pyspark.sql import functions as F

from labormart import CORRECTED, REFERENCE
from labormart.operators import marts
from labormart.schemas import D_CITY, FCT_EXCHANGE_RATES, d_vacancies

DAY = D(2024, 6, 3)


def vac_df(spark, rows):
    """rows: (vacancy_id, currency, from, to, experience, schedule[, dt])."""
    out = []
    for r in rows:
        vid, cur, lo, hi, exp, sch = r[:6]
        day = r[6] if len(r) > 6 else DAY
        out.append(
            (vid, 1, "Data engineer", "t", cur,
             None if lo is None else Decimal(str(lo)), None if hi is None else Decimal(str(hi)),
             exp, sch, TS(2024, 6, 3, 10), TS(2024, 6, 3, 20), day)
        )
    return spark.createDataFrame(out, d_vacancies())


def rates_df(spark, rows):
    """rows: (code, value, nominal[, dt])."""
    return spark.createDataFrame(
        [(c, Decimal(v), Decimal(v), n, TS(2024, 6, 3), r[3] if len(r) > 3 else DAY) for r in rows for c, v, n in [r[:3]]],
        FCT_EXCHANGE_RATES,
    )


def cities_df(spark):
    return spark.createDataFrame([(1, "Москва", "Moscow")], D_CITY)


def one_row(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def salaries(spark, vac_rows, rate_rows=(), sem=REFERENCE):
    sal = marts.vacancy_salaries(vac_df(spark, vac_rows), rates_df(spark, list(rate_rows)), sem)
    return {r.vacancy_id: r.avg_salary for r in sal.collect()}


def test_home_currency_both_bounds(spark):
    assert salaries(spark, [(1, "RUR", 100000, 150000, "noExperience", "remote")])[1] == Decimal("125000.00")


def test_home_currency_one_bound(spark):
    assert salaries(spark, [(1, "RUR", None, 90000, "noExperience", "remote")])[1] == Decimal("90000.00")


def test_foreign_currency(spark):
    s = salaries(spark, [(1, "USD", 1000, 2000, "noExperience", "remote")], [("USD", "90.1234", 1)])
    assert s[1] == Decimal("135185.10")


@pytest.mark.parametrize("sem,expected", [(REFERENCE, Decimal("10000000.00")), (CORRECTED, Decimal("100000.00"))])
def test_per_hundred_quote(spark, sem, expected):
    s = salaries(spark, [(1, "KZT", 500000, 500000, "noExperience", "remote")], [("KZT", "20.0000", 100)], sem)
    assert s[1] == expected


def test_no_rate_and_no_currency_are_null_but_counted(spark):
    v = vac_df(spark, [(1, "XXX", 10, 20, "noExperience", "remote"), (2, None, 10, 20, "noExperience", "remote")])
    m = one_row(marts.metrics_mart(v, rates_df(spark, []), cities_df(spark), REFERENCE))
    assert m.cnt == 2 and m.no_experience_cnt == 2
    assert m.no_experience_avg_salary == Decimal("0.00")


@pytest.mark.parametrize("sem,expected", [(REFERENCE, Decimal("0.00")), (CORRECTED, None)])
def test_band_without_salaries(spark, sem, expected):
    v = vac_df(spark, [(1, None, None, None, "moreThan6", "remote"), (2, None, None, None, "moreThan6", "remote")])
    m = one_row(marts.metrics_mart(v, rates_df(spark, []), cities_df(spark), sem))
    assert m.more_than_6_cnt == 2
    assert m.more_than_6_avg_salary == expected


def test_widened_average_rounds_once(spark):
    rows = [(i, "RUR", 0.01, 0.01, "noExperience", "remote") for i in range(5000)]
    rows += [(10000 + i, "RUR", 0, 0, "noExperience", "remote") for i in range(5001)]
    m = one_row(marts.metrics_mart(vac_df(spark, rows), rates_df(spark, []), cities_df(spark), REFERENCE))
    assert m.cnt == 10001
    assert m.no_experience_avg_salary == Decimal("0.00")


def test_midpoint_rounds_half_up(spark):
    assert salaries(spark, [(1, "RUR", 100.01, 100.02, "noExperience", "remote")])[1] == Decimal("100.02")


def test_repeated_rate_rows_count_once(spark):
    # the same quote stored twice (append-only facts) does not double the vacancy
    v = vac_df(spark, [(1, "USD", 1000, 2000, "noExperience", "remote")])
    r = rates_df(spark, [("USD", "90.1234", 1), ("USD", "90.1234", 1)])
    assert one_row(marts.metrics_mart(v, r, cities_df(spark))).cnt == 1
    # two different quotes for one day: one row per distinct salary, as DISTINCT does
    r2 = rates_df(spark, [("USD", "90.1234", 1), ("USD", "91.0000", 1)])
    assert one_row(marts.metrics_mart(v, r2, cities_df(spark))).cnt == 2


@pytest.mark.parametrize("sem,expected", [(REFERENCE, 0), (CORRECTED, 1)])
def test_fly_in_fly_out_is_cut_to_ten_characters(spark, sem, expected):
    from labormart.functions.text import truncate

    v = vac_df(spark, [(1, "RUR", 1, 2, "noExperience", "flyInFlyOut")])
    v = v.withColumn("schedule", truncate("schedule", sem.schedule_len))
    m = one_row(marts.metrics_mart(v, rates_df(spark, []), cities_df(spark), sem))
    assert m.fly_in_fly_out_schedule_cnt == expected


def test_week_bucket_is_monday(spark):
    v = vac_df(
        spark,
        [(1, "RUR", 1, 2, "noExperience", "remote", D(2024, 6, 2)), (2, "RUR", 1, 2, "noExperience", "remote", D(2024, 6, 5))],
    )
    m = marts.metrics_mart(v, rates_df(spark, []), cities_df(spark), REFERENCE, "week")
    assert sorted(r.dt for r in m.collect()) == [D(2024, 5, 27), D(2024, 6, 3)]


def test_counts_never_exceed_total(spark):
    rows = [(i, "RUR", i, i + 1, ["noExperience", "between1And3", None][i % 3], ["remote", "shift"][i % 2]) for i in range(60)]
    m = one_row(marts.metrics_mart(vac_df(spark, rows), rates_df(spark, []), cities_df(spark)))
    exp = m.no_experience_cnt + m.between_1_and_3_cnt + m.between_3_and_6_cnt + m.more_than_6_cnt
    sch = m.flexible_schedule_cnt + m.remote_schedule_cnt + m.full_day_schedule_cnt + m.shift_schedule_cnt + m.fly_in_fly_out_schedule_cnt
    assert exp <= m.cnt and sch <= m.cnt and m.cnt == 60


def test_ranking_tie_breaks_on_name(spark):
    counts = spark.createDataFrame(
        [("M", "DE", DAY, "SQL", 3), ("M", "DE", DAY, "Python", 3), ("M", "DE", DAY, "ETL", 5)],
        "city_name string, query_profession_eng_name string, dt date, skill_name string, cnt int",
    )
    ranked = {r.skill_name: r.top for r in marts.rank_skills(counts).collect()}
    assert ranked == {"ETL": 1, "Python": 2, "SQL": 3}


def test_rank_is_a_permutation_per_group(spark):
    rows = [("M", "DE", D(2024, 6, d), f"s{i}", (i * 7 + d) % 5) for d in (1, 2) for i in range(40)]
    counts = spark.createDataFrame(rows, "city_name string, query_profession_eng_name string, dt date, skill_name string, cnt int")
    ranked = marts.rank_skills(counts)
    per = ranked.groupBy("dt").agg(F.sort_array(F.collect_list("top")).alias("t")).collect()
    for r in per:
        assert r.t == list(range(1, 41))


def test_skill_counts_sum_link_weights(spark):
    v = vac_df(spark, [(1, "RUR", 1, 2, "noExperience", "remote"), (2, "RUR", 1, 2, "noExperience", "remote")])
    bridge = spark.createDataFrame(
        [(1, DAY, "Data engineer", "SQL", 2), (2, DAY, "Data engineer", "SQL", 1), (2, DAY, "Data engineer", "ETL", 1)],
        "vacancy_id long, dt date, query_profession_eng_name string, skill_name string, n_links long",
    )
    out = {r.skill_name: (r.cnt, r.top) for r in marts.skills_mart(bridge, v, cities_df(spark)).collect()}
    assert out == {"SQL": (3, 1), "ETL": (1, 2)}


def test_collation_option_changes_tie_order(spark):
    counts = spark.createDataFrame(
        [("M", "DE", DAY, n, 1) for n in ("sql", "Spark", "SQL")],
        "city_name string, query_profession_eng_name string, dt date, skill_name string, cnt int",
    )
    binary = [r.skill_name for r in marts.rank_skills(counts).orderBy("top").collect()]
    assert binary == ["SQL", "Spark", "sql"]
    uni = marts.rank_skills(counts, REFERENCE.with_(name_collation="UNICODE")).orderBy("top").collect()
    assert [r.skill_name for r in uni] == ["Spark", "sql", "SQL"]


@pytest.mark.parametrize("sem,expected", [(REFERENCE, None), (CORRECTED, Decimal("150.00"))])
def test_rub_alias_is_home_currency_only_when_corrected(spark, sem, expected):
    assert salaries(spark, [(1, "RUB", 100, 200, "noExperience", "remote")], [], sem)[1] == expected

"""As-of lookup of changing quotes, mergeable mart states, dyadic day blocks."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from helpers import D
from pyspark.sql import functions as F

from labormart import CORRECTED, REFERENCE
from labormart.operators import asof, marts, states, windows

VAC = "vacancy_id long, city_id int, query_profession_eng_name string, salary_currency string, salary_from decimal(18,2), salary_to decimal(18,2), experience string, schedule string, dt date"
CITY = "id int, name string, eng_name string"
RATE = "char_code string, dt date, value decimal(10,4), nominal int"


def _day(i):
    return D(2024, 1, 1) + dt.timedelta(days=i)


def test_latest_quote_not_after_the_day(spark):
    """Against a loop over all quotes: sparse, repeated, two on one day, years apart, unknown series, NULL days."""
    rng = random.Random(5)
    quotes = [(c, _day(rng.randrange(900)), rng.randrange(3)) for c in "ABC" for _ in range(25)]
    quotes += quotes[:10] + [("A", _day(-2000), 9), ("D", None, 1), (None, _day(3), 1)]
    rows = [(i, rng.choice(["A", "B", "C", "D", "Z", None]), rng.choice([_day(rng.randrange(-50, 1000)), None])) for i in range(400)]
    q = spark.createDataFrame(quotes, "code string, day date, x int")
    r = spark.createDataFrame(rows, "id long, series string, on date").withColumn("day", F.lit("kept"))
    got = {a.id: None if a.quotes is None else [y.x for y in a.quotes] for a in asof.asof_quotes(r, q, "series", "on", "code", "day", ["x"]).collect()}
    for i, series, on in rows:
        days = [d for c, d, _ in quotes if c == series and d is not None and on is not None and d <= on]
        assert got[i] == (sorted({x for c, d, x in quotes if c == series and d == max(days)}) if days and series else None)
    plan = asof.asof_quotes(r, q, "series", "on", "code", "day", ["x"])
    assert plan.count() == 400 and plan.columns[:4] == ["id", "series", "on", "day"]
    assert asof.asof_quotes(r, q.where("false"), "series", "on", "code", "day", ["x"]).where("quotes is not null").count() == 0


def test_salaries_by_changing_quotes(spark):
    vac = spark.createDataFrame([(1, 1, "p", "USD", Decimal(100), None, "e", "s", _day(5)), (2, 1, "p", "XXX", Decimal(1), None, "e", "s", _day(5)), (3, 1, "p", "RUR", Decimal(7), Decimal(9), "e", "s", _day(5))], VAC)
    quotes = [("USD", _day(1), Decimal("1.5"), 1), ("USD", _day(4), Decimal("2"), 1), ("USD", _day(4), Decimal("2"), 1), ("USD", _day(6), Decimal("9"), 1), ("XXX", _day(1), Decimal(5), 1)]
    rates = spark.createDataFrame(quotes, RATE)
    known = spark.createDataFrame([("USD",)], "char_code string")
    got = sorted((r.vacancy_id, r.avg_salary) for r in asof.salaries_asof(vac, rates, currencies=known).collect())
    assert got == [(1, Decimal("200.00")), (2, None), (3, Decimal("8.00"))]
    two = rates.unionByName(spark.createDataFrame([("USD", _day(4), Decimal("3"), 1)], RATE))
    assert sorted(r.avg_salary for r in asof.salaries_asof(vac.where("vacancy_id = 1"), two).collect()) == [Decimal("200.00"), Decimal("300.00")]


def _vacancies(rng, n):
    exp = ["noExperience", "between1And3", "between3And6", "moreThan6", None]
    return [(i, rng.choice([1, 2, 9]), rng.choice(["p", "q"]), rng.choice(["RUR", "USD", "XXX", None]), rng.choice([None, Decimal(rng.randrange(1, 99999)) / 100]), rng.choice([None, Decimal(rng.randrange(1, 99999)) / 100]), rng.choice(exp), rng.choice(["remote", "fullDay", "flyInFlyOu", "flyInFlyOut", None]), _day(rng.randrange(25))) for i in range(n)]


@pytest.mark.parametrize("sem", [REFERENCE, CORRECTED])
def test_states_in_any_order_with_replaced_versions(spark, sem):
    """Batches in two orders, later versions retracting earlier ones and a rate that changes: the mart of all rows."""
    rng = random.Random(3)
    last = _vacancies(rng, 300)
    earlier = [(v[0], *_vacancies(rng, 1)[0][1:]) for v in last if v[0] % 3 == 0]
    cities = spark.createDataFrame([(1, "M", "M"), (2, "S", "S")], CITY)
    old_rates = spark.createDataFrame([("USD", _day(i), Decimal("1.2345"), 10) for i in range(25)], RATE)
    rates = spark.createDataFrame([("USD", _day(i), Decimal("1.2345") if i % 4 else Decimal("7.7777"), 10) for i in range(25)], RATE)
    part = lambda rows, vac_rates: states.contributions(spark.createDataFrame(rows, VAC), vac_rates, cities, sem)
    changed = {r.dt for r in states.changed_rate_days(old_rates, rates).collect()}
    assert changed == {_day(i) for i in range(25) if i % 4 == 0}
    for order in (range(4), (2, 0, 3, 1)):
        stored = states.summed(part(earlier, old_rates))
        for b in order:
            batch = [v for v in last if v[0] % 4 == b]
            keys = {v[0] for v in batch}
            stored = states.merged(stored, states.changes(part([v for v in earlier if v[0] in keys] or earlier[:0], old_rates) if any(v[0] in keys for v in earlier) else part(earlier, old_rates).limit(0), part(batch, rates)))
        all_rows = spark.createDataFrame(last, VAC)
        for grain in ("day", "week"):
            want = marts.metrics_mart(all_rows, rates, cities, sem, grain)
            got = states.metrics_from_states(stored, sem, grain)
            assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_states_vanish_when_all_is_retracted(spark):
    rows = spark.createDataFrame(_vacancies(random.Random(1), 40), VAC)
    cities, rates = spark.createDataFrame([(1, "M", "M")], CITY), spark.createDataFrame([("USD", _day(1), Decimal(2), 1)], RATE)
    one = states.contributions(rows, rates, cities)
    assert states.changes(one, one).count() == 0 and states.merged(states.summed(one), states.summed(states.negated(one))).count() == 0


def test_windows_from_dyadic_blocks(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), rng.choice(["x", "y", "z"]), _day(rng.randrange(-40, 700)), rng.randrange(-3, 9)) for _ in range(900)]
    daily = spark.createDataFrame(rows, "city string, skill string, dt date, cnt int")
    path = str(tmp_path / "blocks")
    windows.write_blocks(windows.dyadic_blocks(daily, ["city", "skill"], ["cnt"]), path)
    blocks = spark.read.parquet(path)
    spans = [(i, _day(a), _day(a + n)) for i, (a, n) in enumerate((rng.randrange(-60, 720), rng.choice([-1, 0, 1, 6, 29, 30, 364, 700])) for _ in range(40))]
    found = windows.sums_of_windows(blocks, spark.createDataFrame(spans, "w int, a date, b date"), "w", "a", "b", ["city", "skill"], ["cnt"])
    got = {(r.w, r.city, r.skill): r.cnt for r in found.collect() if r.cnt}
    want = {}
    for i, a, b in spans:
        for city, skill, day, n in rows:
            if a <= day <= b:
                want[i, city, skill] = want.get((i, city, skill), 0) + n
    assert got == {k: n for k, n in want.items() if n}
    # one window: its blocks only, at most two a level, and the same sums
    i, a, b = spans[7][0], _day(-31), _day(611)
    assert len(windows.cover_of(a, b)) <= 2 * 10
    one = windows.window_sums(blocks, a, b, ["skill"], ["cnt"])
    assert {r.skill: r.cnt for r in one.collect()} == {s: sum(n for _, k, day, n in rows if k == s and a <= day <= b) for s in "xyz"}
    assert "PartitionFilters: [((" in one._jdf.queryExecution().executedPlan().toString()
    native = spark.range(1).select(windows.cover(F.lit(a), F.lit(b)).alias("c")).first().c
    assert sorted((x.level, x.block) for x in native) == sorted(windows.cover_of(a, b))
    # a day that changes adds its difference to one block a level
    extra = spark.createDataFrame([("a", "x", _day(100), 5), ("b", "z", _day(100), -2)], daily.schema)
    more = windows.merged_blocks(blocks, windows.dyadic_blocks(extra, ["city", "skill"], ["cnt"]), keys=["city", "skill"], measures=["cnt"])
    whole = windows.dyadic_blocks(daily.unionByName(extra), ["city", "skill"], ["cnt"])
    key = lambda df: sorted(tuple(r) for r in df.select("level", "block", "city", "skill", "cnt").collect())
    assert key(more) == key(whole)

"""JSON flattening, dimension filters, dedup, upsert and insert-new."""

import json
from decimal import Decimal

import pytest
from helpers import TS, D, staged, vacancy

from labormart import CORRECTED, REFERENCE
from labormart.operators import merge, parse
from labormart.schemas import D_CITY, D_QUERY_PROFESSION
from labormart.sources.dims import PROFESSION_SEED


@pytest.fixture(scope="module")
def dims(spark):
    cities = spark.createDataFrame([(1, "Москва", "Moscow"), (2, "Санкт-Петербург", "Saint Petersburg")], D_CITY)
    profs = spark.createDataFrame(PROFESSION_SEED, D_QUERY_PROFESSION)
    return profs, cities


def flat(spark, dims, rows, sem=REFERENCE):
    profs, cities = dims
    return parse.flatten_vacancies(staged(spark, rows), profs, cities, sem)


def test_typed_columns_and_truncation(spark, dims):
    doc = vacancy(7, area=1, name="x" * 120, currency="USD", lo="1000", hi=2000, sched="flyInFlyOut")
    r = flat(spark, dims, [(doc, "Data engineer", D(2024, 6, 1), TS(2024, 6, 2))]).collect()[0]
    assert r.vacancy_id == 7 and r.city_id == 1 and len(r.profession) == 100
    assert r.salary_from == Decimal("1000.00") and r.salary_to == Decimal("2000.00")
    assert r.schedule == "flyInFlyOu"
    assert r.published_at == TS(2024, 6, 1, 10, 0)
    assert r.dt == D(2024, 6, 1)


def test_corrected_keeps_full_schedule(spark, dims):
    doc = vacancy(7, sched="flyInFlyOut")
    r = flat(spark, dims, [(doc, "Data engineer", D(2024, 6, 1), TS(2024, 6, 2))], CORRECTED).collect()[0]
    assert r.schedule == "flyInFlyOut"


def test_number_and_text_ids_read_alike(spark, dims):
    a = '{"id": 7, "area": {"id": 1}}'
    b = '{"id": "7", "area": {"id": "1"}}'
    rows = parse.vacancy_rows(staged(spark, [(a, "Data engineer", D(2024, 6, 1), TS(2024, 6, 2)),
                                            (b, "Data analyst", D(2024, 6, 1), TS(2024, 6, 2))])).collect()
    assert [(r.vacancy_id, r.city_id) for r in rows] == [(7, 1), (7, 1)]


def test_unknown_area_and_profession_are_dropped(spark, dims):
    rows = [
        (vacancy(1, area=999), "Data engineer", D(2024, 6, 1), TS(2024, 6, 2)),
        (vacancy(2, area=1), "Plumber", D(2024, 6, 1), TS(2024, 6, 2)),
        (vacancy(3, area=2), "Data analyst", D(2024, 6, 1), TS(2024, 6, 2)),
    ]
    assert [r.vacancy_id for r in flat(spark, dims, rows).collect()] == [3]


def test_exact_copies_collapse(spark, dims):
    doc = vacancy(5)
    rows = [(doc, "Data engineer", D(2024, 6, 1), TS(2024, 6, 2, h)) for h in (1, 2, 3)]
    assert flat(spark, dims, rows).count() == 1


def test_changed_duplicate_fails_in_reference(spark, dims):
    rows = [
        (vacancy(5, name="old"), "Data engineer", D(2024, 6, 1), TS(2024, 6, 2, 1)),
        (vacancy(5, name="new"), "Data engineer", D(2024, 6, 1), TS(2024, 6, 2, 2)),
    ]
    with pytest.raises(Exception, match="duplicate versions"):
        flat(spark, dims, rows).collect()


def test_changed_duplicate_keeps_latest_in_corrected(spark, dims):
    rows = [
        (vacancy(5, name="new"), "Data engineer", D(2024, 6, 1), TS(2024, 6, 2, 2)),
        (vacancy(5, name="old"), "Data engineer", D(2024, 6, 1), TS(2024, 6, 2, 1)),
    ]
    out = flat(spark, dims, rows, CORRECTED).collect()
    assert [r.profession for r in out] == ["new"]


def test_skill_entries_missing_empty_and_null(spark):
    rows = [
        (vacancy(1), "Data engineer", D(2024, 6, 1), TS(2024, 6, 2)),  # no key
        (vacancy(2, skills=[]), "Data engineer", D(2024, 6, 1), TS(2024, 6, 2)),
        (json.dumps({"id": 3, "key_skills": [{"name": None}]}), "Data engineer", D(2024, 6, 1), TS(2024, 6, 2)),
        (vacancy(4, skills=["SQL", "ETL"]), "Data engineer", D(2024, 6, 1), TS(2024, 6, 2)),
    ]
    st = staged(spark, rows)
    ref = sorted((r.vacancy_id, r.skill_name or "") for r in parse.skill_entries(st, REFERENCE).collect())
    assert ref == [(3, ""), (4, "ETL"), (4, "SQL")]
    cor = sorted((r.vacancy_id, r.skill_name) for r in parse.skill_entries(st, CORRECTED).collect())
    assert cor == [(4, "ETL"), (4, "SQL")]


def test_insert_new_keeps_null_names_like_the_source(spark):
    target = spark.createDataFrame([("SQL",), (None,)], "name string")
    cand = spark.createDataFrame([("SQL",), ("ETL",), (None,)], "name string")
    out = sorted((r.name or "") for r in merge.insert_new(target, cand, ["name"]).collect())
    assert out == ["", "ETL"]


def test_upsert_insert_update_keep_and_null_overwrite(spark):
    schema = "k int, v string, dt date"
    target = spark.createDataFrame([(1, "a", D(2024, 6, 1)), (2, "b", D(2024, 6, 1))], schema)
    source = spark.createDataFrame([(2, None, D(2024, 6, 1)), (3, "c", D(2024, 6, 1))], schema)
    out = {r.k: r.v for r in merge.upsert(target, source, ["k", "dt"]).collect()}
    assert out == {1: "a", 2: None, 3: "c"}


def test_upsert_is_idempotent(spark):
    schema = "k int, v string, dt date"
    target = spark.createDataFrame([(i, f"t{i}", D(2024, 6, 1 + i % 3)) for i in range(20)], schema)
    source = spark.createDataFrame([(i, f"s{i}", D(2024, 6, 1 + i % 3)) for i in range(10, 30)], schema)
    once = merge.upsert(target, source, ["k", "dt"], partition_cols=["dt"])
    twice = merge.upsert(once, source, ["k", "dt"], partition_cols=["dt"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_upsert_partitions_returns_only_touched_days(spark):
    schema = "k int, v string, dt date"
    target = spark.createDataFrame([(1, "a", D(2024, 6, 1)), (2, "b", D(2024, 6, 2))], schema)
    source = spark.createDataFrame([(3, "c", D(2024, 6, 2))], schema)
    out = merge.upsert_partitions(target, source, ["k", "dt"], ["dt"])
    assert sorted((r.k, r.v) for r in out.collect()) == [(2, "b"), (3, "c")]


def test_upsert_rejects_duplicate_source_keys(spark):
    schema = "k int, v string"
    target = spark.createDataFrame([(1, "a")], schema)
    source = spark.createDataFrame([(2, "x"), (2, "y")], schema)
    with pytest.raises(Exception, match="duplicate versions"):
        merge.upsert(target, source, ["k"]).collect()


def test_rate_records_and_currency_dimension(spark):
    from helpers import rate_doc

    from labormart.schemas import STG_EXCHANGE_RATES

    docs = spark.createDataFrame(
        [(rate_doc("2024-06-01T11:30:00+03:00", {"USD": ("92.12345", 1), "KZT": ("20.5", "100")}), D(2024, 6, 1), TS(2024, 6, 1))],
        STG_EXCHANGE_RATES,
    )
    recs = parse.rate_records(docs)
    facts = {r.char_code: r for r in parse.rate_fact_rows(recs).collect()}
    assert facts["USD"].value == Decimal("92.1235")  # half up at the 4th place
    assert facts["KZT"].nominal == 100
    assert facts["USD"].published_at == TS(2024, 6, 1, 11, 30)
    dim = {r.char_code: r.num_code for r in parse.currency_dimension_rows(recs).collect()}
    assert set(dim) == {"USD", "KZT"}


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None)
@given(
    st.dictionaries(st.integers(0, 15), st.one_of(st.none(), st.text("abc", max_size=2)), max_size=10),
    st.dictionaries(st.integers(0, 15), st.one_of(st.none(), st.text("abc", max_size=2)), max_size=10),
)
def test_upsert_matches_a_dictionary_model(spark, target, source):
    schema = "k int, v string, dt date"
    day = lambda k: D(2024, 6, 1 + k % 3)
    t = spark.createDataFrame([(k, v, day(k)) for k, v in target.items()], schema)
    s = spark.createDataFrame([(k, v, day(k)) for k, v in source.items()], schema)
    got = {r.k: r.v for r in merge.upsert(t, s, ["k", "dt"], partition_cols=["dt"]).collect()}
    assert got == {**target, **source}

"""Documents staged as VARIANT give the rows that documents as text give."""

import json

import pytest
from helpers import TS, D, rate_doc, staged, vacancy
from test_pipeline import MON, fresh, rates_for
from test_quarantine import BAD

from labormart import CORRECTED, REFERENCE
from labormart.operators import parse, quarantine, variants
from labormart.plans.pipeline import load, stage
from labormart.schemas import STG_EXCHANGE_RATES, STG_VACANCIES

DOCS = [
    vacancy(1, skills=["SQL", "Python"], currency="USD", lo=10, hi=None),
    vacancy("2", skills=[], currency=None),
    vacancy(3, skills=[None, "x", "x"], name="\u0418\u043d\u0436\u0435\u043d\u0435\u0440", lo="7", hi=8.25),
    {"id": 4}, {"id": 5, "area": None, "salary": {"from": 1}, "key_skills": None, "more": [1, {"a": 2}]},
]


def _rows(df):
    return sorted(map(str, df.collect()))


def test_same_rows_as_from_text(spark):
    text = staged(spark, [(d, "Data engineer", MON, TS(2024, 6, 4)) for d in DOCS])
    var = variants.with_variant(text)
    assert _rows(parse.vacancy_rows(var)) == _rows(parse.vacancy_rows(text))
    for sem in (REFERENCE, CORRECTED):
        assert _rows(parse.skill_entries(var, sem)) == _rows(parse.skill_entries(text, sem))


def test_same_rate_rows_as_from_text(spark):
    docs = [rate_doc("2024-06-03T11:30:00+03:00", {"USD": ("90.12345", 1), "KZT": (20, 100)}), json.dumps({"Date": "2024-06-03"}), json.dumps({"Date": None, "Valute": {}})]
    text = spark.createDataFrame([(d, MON, TS(2024, 6, 3)) for d in docs], STG_EXCHANGE_RATES)
    typed = lambda df: _rows(parse.typed_rate_records(parse.rate_records(df)))
    assert typed(variants.with_variant(text)) == typed(text) and len(typed(text)) == 2


def test_variant_survives_parquet_and_finds_the_same_faults(spark, tmp_path):
    texts = [*BAD.values(), "[1]", "7", "null", "", '{"id": 1} x', json.dumps(vacancy(1, skills=["SQL"])), None]
    text = spark.createDataFrame([(x, "p", MON, TS(2024, 6, 4)) for x in texts], "obj string, query_profession_eng_name string, query_dt date, update_ts timestamp_ntz")
    path = str(tmp_path / "staged")
    variants.with_variant(text).write.parquet(path)
    read = spark.read.parquet(path)
    assert dict(read.dtypes)["v"] == "variant"
    reasons = lambda df: sorted((str(r.obj), tuple(r.reasons)) for r in quarantine.check_vacancies(df).collect())
    assert reasons(read) == reasons(text)


@pytest.mark.parametrize("sem", [REFERENCE, CORRECTED])
def test_load_from_variant(spark, sem):
    """Every table is the same, rejects included."""
    good = [json.dumps(vacancy(i, skills=["SQL", f"S{i % 3}"], currency="USD", lo=i, hi=i + 5)) for i in range(1, 9)]
    texts = good + (list(BAD.values()) if sem.quarantine else [])
    found = []
    for form in ("json", "variant"):
        t = fresh(spark, sem)
        stage(t, staged(spark, [(x, "Data engineer", MON, TS(2024, 6, 4)) for x in texts]), rates_for(spark, [MON, D(2024, 6, 4)]))
        load(t, sem, MON, documents=form)
        found.append({name: _rows(t.get(name)) for name in t.schemas})
    assert found[0] == found[1] and found[0]["dm_metrics"] and found[0]["dm_skills"]
    assert spark.createDataFrame([], STG_VACANCIES).count() == 0
    with pytest.raises(ValueError, match="documents must be"):
        load(t, sem, MON, documents="xml")

"""Documents that do not fit: failing loads in REFERENCE, the table of rejects in CORRECTED."""

import json

import pytest
from helpers import TS, D, rate_doc, staged, vacancy
from pyspark.sql import functions as F
from test_pipeline import MON, fresh, rates_for

from labormart import CORRECTED, REFERENCE
from labormart.operators import quarantine
from labormart.plans.pipeline import load, run_pipeline, stage
from labormart.schemas import STG_EXCHANGE_RATES

BAD = {
    "malformed": '{"id": 5',
    "id": json.dumps(vacancy("x")),
    "area": json.dumps(vacancy(6, area="here")),
    "salary_from": json.dumps(vacancy(7, lo="1,5", hi=2)),
    "salary_to": json.dumps(vacancy(8, lo=1, hi="9" * 20)),
    "published_at": json.dumps(vacancy(9, published="soon")),
    "skill_name": json.dumps(vacancy(10, skills=["SQL", "s" * 151])),
}


def _stage(spark, t, texts, rates=None):
    rows = [(x, "Data engineer", MON, TS(2024, 6, 4)) for x in texts]
    stage(t, staged(spark, rows), rates_for(spark, [MON]) if rates is None else rates)


@pytest.mark.parametrize("reason", sorted(BAD))
def test_reference_fails_on_each_fault(spark, reason):
    t = fresh(spark, REFERENCE)
    _stage(spark, t, [json.dumps(vacancy(1)), BAD[reason]])
    with pytest.raises(Exception, match="rejected document"):
        load(t, REFERENCE, MON)
    assert t.get("d_vacancies").count() == 0 and t.get("rejects").count() == 0


def test_corrected_keeps_every_rejected_document(spark):
    t = fresh(spark, CORRECTED)
    two = json.dumps(vacancy("y", lo="?", hi="?"))  # three reasons, staged twice
    _stage(spark, t, [json.dumps(vacancy(1, skills=["SQL"])), two, two, *BAD.values()])
    load(t, CORRECTED, MON)
    got = {(r.reason, r.obj): r.n_rows for r in t.get("rejects").collect()}
    want = {(k, v): 1 for k, v in BAD.items()} | {(k, two): 2 for k in ("id", "salary_from", "salary_to")}
    assert got == want
    assert sorted(r.vacancy_id for r in t.get("d_vacancies").collect()) == [1, 10]
    assert {r.name for r in t.get("d_skill").collect()} == {"SQL"}
    # the same documents again add no reject
    _stage(spark, t, list(BAD.values()))
    load(t, CORRECTED, MON)
    assert t.get("rejects").count() == len(want)


def test_rates_that_do_not_fit(spark):
    t = fresh(spark, CORRECTED)
    doc = json.loads(rate_doc("2024-06-03T11:30:00+03:00", {"EUR": ("1", 1), "USD": ("90.5", 1)}))
    doc["Valute"]["EUR"]["Value"] = "n/a"
    doc["Valute"]["USD"]["Name"] = None
    rows = [(json.dumps(doc), MON, TS(2024, 6, 3)), ("[1]", MON, TS(2024, 6, 3)), (rate_doc("never", {}), MON, TS(2024, 6, 3))]
    _stage(spark, t, [json.dumps(vacancy(1))], spark.createDataFrame(rows, STG_EXCHANGE_RATES))
    load(t, CORRECTED, MON)
    assert sorted((r.source, r.reason) for r in t.get("rejects").collect()) == [("rates", x) for x in ("malformed", "name", "rate_date", "value")]
    assert t.get("fct_exchange_rates").count() == 0 and t.get("d_vacancies").count() == 1


def test_landed_files_and_a_failed_load(spark, tmp_path):
    """Malformed lines and a cut-off rate file: CORRECTED publishes them with the load, REFERENCE refuses the files."""
    from labormart.sources.landed import landed_rejects, landed_sources

    landing = tmp_path / "landing"
    folder = landing / "vacancies" / "query_dt=2024-06-03" / "query_profession_eng_name=Data engineer"
    folder.mkdir(parents=True)
    (folder / "a.jsonl").write_text("\n".join([json.dumps(vacancy(1)), "{broken", BAD["id"]]))
    for day, text in (("2024-06-02", rate_doc("2024-06-02T11:30:00+03:00", {"USD": ("90", 1)})), ("2024-06-03", '{"Date": ')):
        (landing / "rates" / f"query_dt={day}").mkdir(parents=True)
        (landing / "rates" / f"query_dt={day}" / "r.json").write_text(text)
    t = fresh(spark, CORRECTED, str(tmp_path / "wh"))
    vs, rs = landed_sources(spark, str(landing), CORRECTED)
    run_pipeline(spark, t, dt=MON, as_of=D(2024, 6, 4), sem=CORRECTED, vacancy_source=vs, rate_source=rs, reject_source=landed_rejects(spark, str(landing)))
    assert sorted((r.source, r.reason) for r in t.get("rejects").collect()) == [("rates", "malformed"), ("vacancies", "id"), ("vacancies", "malformed")]
    assert t.get("fct_exchange_rates").where(F.col("dt") == MON).count() == 1  # the day before served
    strict = fresh(spark, REFERENCE, str(tmp_path / "wh2"))
    vs, rs = landed_sources(spark, str(landing), REFERENCE)
    with pytest.raises(Exception, match="malformed JSON document"):
        run_pipeline(spark, strict, dt=MON, as_of=D(2024, 6, 4), vacancy_source=vs, rate_source=rs)
    assert strict.get("d_vacancies").count() == 0 and strict.get("stg_vacancies").count() == 0


def test_stream_keeps_rejects(spark, tmp_path):
    from labormart.sources.landed import read_rate_documents
    from labormart.streaming.ingest import start_incremental

    landing = tmp_path / "landing"
    for i, lines in enumerate([[json.dumps(vacancy(1)), "{x"], [json.dumps(vacancy(2)), "{x", BAD["published_at"]]]):
        folder = landing / "vacancies" / f"query_dt=2024-06-0{3 + i}" / "query_profession_eng_name=Data engineer"
        folder.mkdir(parents=True)
        (folder / "a.jsonl").write_text("\n".join(lines))
    (landing / "rates" / "query_dt=2024-06-03").mkdir(parents=True)
    (landing / "rates" / "query_dt=2024-06-03" / "r.json").write_text("cut off")
    t = fresh(spark, CORRECTED, str(tmp_path / "wh"))
    rates = lambda: read_rate_documents(spark, str(landing / "rates"))
    start_incremental(spark, str(landing / "vacancies"), t, rates, str(tmp_path / "ckpt"), CORRECTED).awaitTermination()
    got = sorted((r.source, r.reason, r.query_dt.day) for r in t.get("rejects").collect())
    assert got == [("rates", "malformed", 3), ("vacancies", "malformed", 3), ("vacancies", "malformed", 4), ("vacancies", "published_at", 4)]
    assert t.get("d_vacancies").count() == 2


def test_reasons_of_rows_without_a_day_or_profession(spark):
    rows = spark.createDataFrame([(json.dumps(vacancy(1)), None, None, None), (None, "p", MON, None)], "obj string, query_profession_eng_name string, query_dt date, update_ts timestamp_ntz")
    got = sorted(tuple(r.reasons) for r in quarantine.check_vacancies(rows).collect())
    assert got == [("malformed",), ("query_profession_eng_name", "query_dt")]

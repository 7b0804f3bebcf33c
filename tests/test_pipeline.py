"""Composed loads: link multiplicity, duplicates, re-runs, grains, Parquet end to end, streaming."""

import datetime as dt
import json

import pytest
from helpers import TS, D, rate_doc, staged, vacancy
from pyspark.sql import functions as F

from labormart import CORRECTED, REFERENCE
from labormart.operators import merge, serve
from labormart.operators.quality import audit
from labormart.plans.pipeline import load, run_pipeline, stage
from labormart.plans.tables import MemoryTables, ParquetTables
from labormart.schemas import D_CITY, D_QUERY_PROFESSION, STG_EXCHANGE_RATES
from labormart.sources.dims import PROFESSION_SEED

MON = D(2024, 6, 3)


def fresh(spark, sem, parquet_root=None):
    cities = spark.createDataFrame([(1, "Москва", "Moscow"), (2, "Сочи", "Sochi")], D_CITY)
    profs = spark.createDataFrame(PROFESSION_SEED, D_QUERY_PROFESSION)
    if parquet_root:
        t = ParquetTables(spark, parquet_root, sem)
        t.put("d_city", cities)
        t.put("d_query_profession", profs)
        return t
    return MemoryTables(spark, sem, initial={"d_city": cities, "d_query_profession": profs})


def rates_for(spark, days, quotes=None):
    quotes = quotes or {"USD": ("90.0000", 1)}
    return spark.createDataFrame(
        [(rate_doc(f"{d.isoformat()}T11:30:00+03:00", quotes), d, TS(d.year, d.month, d.day, 12)) for d in days],
        STG_EXCHANGE_RATES,
    )


def skills_of(tables):
    return {
        (r.query_profession_eng_name, r.skill_name, r.dt): (r.cnt, r.top) for r in tables.get("dm_skills").collect()
    }


@pytest.mark.parametrize("sem,links,per_prof", [(REFERENCE, 4, 2), (CORRECTED, 2, 1)])
def test_same_vacancy_under_two_professions(spark, sem, links, per_prof):
    t = fresh(spark, sem)
    doc = vacancy(1, skills=["SQL"])
    stage(t, staged(spark, [(doc, p, MON, TS(2024, 6, 4)) for p in ("Data engineer", "Data analyst")]), rates_for(spark, [MON]))
    load(t, sem, MON)
    assert t.get("fct_skill_vacancy").agg(F.sum("n_links")).first()[0] == links
    got = skills_of(t)
    assert got == {("Data engineer", "SQL", MON): (per_prof, 1), ("Data analyst", "SQL", MON): (per_prof, 1)}


@pytest.mark.parametrize("sem,links", [(REFERENCE, 2), (CORRECTED, 1)])
def test_exact_duplicate_document(spark, sem, links):
    t = fresh(spark, sem)
    doc = vacancy(1, skills=["SQL"])
    stage(t, staged(spark, [(doc, "Data engineer", MON, TS(2024, 6, 4))] * 2), rates_for(spark, [MON]))
    load(t, sem, MON)
    assert t.get("d_vacancies").count() == 1
    assert t.get("fct_skill_vacancy").agg(F.sum("n_links")).first()[0] == links


def test_rank_upsert_keeps_stale_rows_only_in_reference(spark):
    schema = "city_name string, query_profession_eng_name string, skill_name string, dt date, top int, cnt int"
    run1 = spark.createDataFrame([("M", "DE", "A", MON, 1, 1), ("M", "DE", "B", MON, 2, 1)], schema)
    run2 = spark.createDataFrame([("M", "DE", "B", MON, 1, 1)], schema)
    ref = merge.upsert(run1, run2, ["city_name", "query_profession_eng_name", "skill_name", "dt"])
    assert sorted((r.skill_name, r.top) for r in ref.collect()) == [("A", 1), ("B", 1)]
    cor = merge.replace_slices(run1, run2, ["city_name", "query_profession_eng_name", "dt"])
    assert sorted((r.skill_name, r.top) for r in cor.collect()) == [("B", 1)]


@pytest.mark.parametrize("sem", [REFERENCE, CORRECTED])
def test_monday_collision(spark, sem):
    t = fresh(spark, sem)
    days = [MON, D(2024, 6, 4), D(2024, 6, 5)]
    docs = [(vacancy(i, currency="RUR", lo=100, hi=200), "Data engineer", d, TS(2024, 6, 6)) for i, d in enumerate(days)]
    stage(t, staged(spark, docs), rates_for(spark, days))
    load(t, sem, None)  # full: one weekly row dated Monday, cnt 3
    stage(t, staged(spark, [(vacancy(9, currency="RUR", lo=1, hi=1), "Data engineer", MON, TS(2024, 6, 7))]), rates_for(spark, [MON]))
    load(t, sem, MON)  # incremental for Monday: the day now has 2 vacancies
    rows = t.get("dm_metrics").where(F.col("dt") == MON).collect()
    if sem.grain_column:
        assert sorted((r.grain, r.cnt) for r in rows) == [("day", 2), ("week", 3)]
    else:
        assert [r.cnt for r in rows] == [2]  # the daily row replaced the weekly one


def test_incremental_consumes_only_its_day(spark):
    t = fresh(spark, REFERENCE)
    d1, d2 = D(2024, 6, 3), D(2024, 6, 4)
    stage(t, staged(spark, [(vacancy(1), "Data engineer", d1, TS(2024, 6, 5)), (vacancy(2), "Data engineer", d2, TS(2024, 6, 5))]), rates_for(spark, [d1, d2]))
    load(t, REFERENCE, d2)
    assert [r.query_dt for r in t.get("stg_vacancies").collect()] == [d1]
    assert [r.dt for r in t.get("dm_metrics").collect()] == [d2]


def _land(spark, root, days, docs_per_day):
    from labormart.sources.landed import land_documents

    vac_rows, rate_rows = [], []
    for d in days:
        for i in range(docs_per_day):
            vid = d.toordinal() * 100 + i
            prof = ["Data engineer", "Data analyst"][i % 2]
            doc = vacancy(vid, area=1 + i % 2, currency=["RUR", "USD"][i % 2], lo=1000 + i, hi=2000 + i,
                          exp=["noExperience", "between1And3"][i % 2], skills=["SQL", f"S{i % 3}"])
            vac_rows.append((json.dumps(doc), d, prof))
        rate_rows.append((rate_doc(f"{d.isoformat()}T11:30:00+03:00", {"USD": ("90.5000", 1)}), d))
    vac = spark.createDataFrame(vac_rows, "obj string, query_dt date, query_profession_eng_name string")
    land_documents(vac.coalesce(1), f"{root}/vacancies", ["query_dt", "query_profession_eng_name"])
    land_documents(spark.createDataFrame(rate_rows, "obj string, query_dt date").coalesce(1), f"{root}/rates", ["query_dt"])


def test_parquet_end_to_end_full_then_incremental(spark, tmp_path):
    from labormart.sources.landed import landed_sources

    landing, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    days = [D(2024, 6, 3), D(2024, 6, 4), D(2024, 6, 5)]
    _land(spark, landing, days, 6)
    t = fresh(spark, REFERENCE, wh)
    vs, rs = landed_sources(spark, landing)
    rep = run_pipeline(spark, t, dt=days[0], as_of=D(2024, 6, 6), vacancy_source=vs, rate_source=rs)
    assert rep.mode == "full"
    m = t.get("dm_metrics").collect()
    assert sum(r.cnt for r in m) == 18 and {r.dt for r in m} == {D(2024, 6, 3)}
    assert t.get("stg_vacancies").count() == 0
    assert t.get("d_vacancies").count() == 18

    _land(spark, landing, [D(2024, 6, 6)], 4)
    rep = run_pipeline(spark, t, dt=D(2024, 6, 6), as_of=D(2024, 6, 7), vacancy_source=vs, rate_source=rs)
    assert rep.mode == "incremental"
    daily = t.get("dm_metrics").where(F.col("dt") == D(2024, 6, 6)).collect()
    assert sum(r.cnt for r in daily) == 4
    assert t.get("d_vacancies").count() == 22
    assert t.get("stg_vacancies").count() == 0
    usd = [r for r in daily if r.city_name == "Сочи"]
    assert usd and all(r.between_1_and_3_avg_salary > 0 for r in usd)


def test_corrected_full_equals_daily_incrementals(spark):
    days = [D(2024, 6, 3), D(2024, 6, 4), D(2024, 6, 5)]
    docs = [
        (vacancy(10 * k + i, area=1 + i % 2, currency="USD", lo=100 * i + 1, hi=None, skills=["SQL", f"S{i}"]),
         ["Data engineer", "Data analyst"][i % 2], d, TS(2024, 6, 6))
        for k, d in enumerate(days) for i in range(4)
    ]
    full = fresh(spark, CORRECTED)
    stage(full, staged(spark, docs), rates_for(spark, days))
    load(full, CORRECTED, None)
    inc = fresh(spark, CORRECTED)
    for d in days:
        stage(inc, staged(spark, [x for x in docs if x[2] == d]), rates_for(spark, [d]))
        load(inc, CORRECTED, d)
    for name in ("d_vacancies", "fct_skill_vacancy", "dm_skills"):
        a = sorted(tuple(r) for r in full.get(name).collect())
        b = sorted(tuple(r) for r in inc.get(name).collect())
        assert a == b, name


def test_streaming_available_now_matches_batch(spark, tmp_path):
    from labormart.sources.landed import read_rate_documents
    from labormart.streaming.ingest import start_incremental

    landing = str(tmp_path / "landing")
    days = [D(2024, 6, 3), D(2024, 6, 4)]
    _land(spark, landing, days, 4)
    t = fresh(spark, CORRECTED, str(tmp_path / "wh"))
    q = start_incremental(
        spark, f"{landing}/vacancies", t, lambda: read_rate_documents(spark, f"{landing}/rates"),
        str(tmp_path / "ckpt"), CORRECTED,
    )
    q.awaitTermination(300)
    assert q.exception() is None
    got = {(r.city_name, r.query_profession_eng_name, r.dt): r.cnt for r in t.get("dm_metrics").collect()}
    assert sum(got.values()) == 8 and {k[2] for k in got} == set(days)


def test_audit_after_a_load_is_clean(spark):
    from labormart.operators.quality import audit

    t = fresh(spark, CORRECTED)
    docs = [(vacancy(i, area=1 + i % 2, skills=["SQL", "ETL"][: 1 + i % 2]), "Data engineer", MON, TS(2024, 6, 4)) for i in range(6)]
    stage(t, staged(spark, docs), rates_for(spark, [MON]))
    load(t, CORRECTED, MON)
    findings = {(r.table_name, r.check, r.target): r.n_findings for r in audit(t).collect()}
    assert findings and all(n == 0 for n in findings.values()), {k: v for k, v in findings.items() if v}
    # a broken foreign key is reported
    t.put("d_city", t.get("d_city").where("id = 1"), "overwrite")
    bad = {(r.check, r.target): r.n_findings for r in audit(t, ["d_vacancies"]).collect()}
    assert bad[("foreign_key", "city_id->d_city")] == 3
    assert bad[("foreign_key", "query_profession_eng_name->d_query_profession")] == 0


def test_streaming_micro_batches_match_daily_batch_loads(spark, tmp_path):
    from labormart.sources.landed import landed_sources, read_rate_documents
    from labormart.streaming.ingest import start_incremental

    landing = str(tmp_path / "landing")
    days = [D(2024, 6, 3), D(2024, 6, 4)]
    for d in days:  # a file for each day and profession, and a micro-batch for each file
        _land(spark, landing, [d], 3)
    stream_t = fresh(spark, CORRECTED, str(tmp_path / "wh_stream"))
    q = start_incremental(
        spark, f"{landing}/vacancies", stream_t, lambda: read_rate_documents(spark, f"{landing}/rates"),
        str(tmp_path / "ckpt"), CORRECTED, max_files_per_trigger=1,
    )
    q.awaitTermination(600)
    assert q.exception() is None
    assert q.lastProgress is not None and q.lastProgress["batchId"] >= 1

    batch_t = fresh(spark, CORRECTED, str(tmp_path / "wh_batch"))
    vs, rs = landed_sources(spark, landing)
    for d in days:
        run_pipeline(spark, batch_t, dt=d, as_of=d + dt.timedelta(days=1), sem=CORRECTED, vacancy_source=vs, rate_source=rs)
    for name in ("d_vacancies", "dm_metrics", "dm_skills"):
        cols = [c for c in batch_t.get(name).columns if c != "update_ts"]
        a = sorted(tuple(r) for r in stream_t.get(name).select(*cols).collect())
        b = sorted(tuple(r) for r in batch_t.get(name).select(*cols).collect())
        assert a == b, name


def test_catalog_tables_bucketed_end_to_end(spark, tmp_path):
    import uuid

    from labormart.operators import marts
    from labormart.plans.tables import CatalogTables
    from labormart.sources.landed import landed_sources

    landing = str(tmp_path / "landing")
    days = [D(2024, 6, 3), D(2024, 6, 4)]
    _land(spark, landing, days, 6)
    db = f"lm_{uuid.uuid4().hex[:8]}"
    t = CatalogTables(spark, db, str(tmp_path / "wh"), REFERENCE, buckets=4)
    t.put("d_city", spark.createDataFrame([(1, "Москва", "Moscow"), (2, "Сочи", "Sochi")], D_CITY))
    t.put("d_query_profession", spark.createDataFrame(PROFESSION_SEED, D_QUERY_PROFESSION))
    vs, rs = landed_sources(spark, landing)
    run_pipeline(spark, t, dt=days[0], as_of=D(2024, 6, 5), vacancy_source=vs, rate_source=rs)
    assert sum(r.cnt for r in t.get("dm_metrics").collect()) == 12
    assert t.get("stg_vacancies").count() == 0
    _land(spark, landing, [D(2024, 6, 5)], 2)
    run_pipeline(spark, t, dt=D(2024, 6, 5), as_of=D(2024, 6, 6), vacancy_source=vs, rate_source=rs)
    assert t.get("d_vacancies").count() == 14
    assert sum(r.cnt for r in t.get("dm_metrics").where("dt = date'2024-06-05'").collect()) == 2

    # the skills mart's link/vacancy join reads both bucketed tables without an exchange
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = marts.skill_counts(t.get("fct_skill_vacancy"), t.get("d_vacancies"), t.get("d_city"))
        plan = counts._jdf.queryExecution().executedPlan().toString()
        join_part = plan[plan.index("SortMergeJoin"):]
        scans = join_part.split("FileScan")
        assert "Bucketed: true" in join_part and len(scans) >= 3
        assert "Exchange" not in join_part.split("BroadcastExchange")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_command_line_run_and_audit(spark, tmp_path, capsys):
    from labormart.__main__ import main

    landing, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    _land(spark, landing, [D(2024, 6, 3), D(2024, 6, 4)], 4)
    cities = tmp_path / "city.csv"
    cities.write_text("id|name|eng_name\n1|Москва|Moscow\n2|Сочи|Sochi\n", encoding="utf-8")
    assert main(["run", "--warehouse", wh, "--landing", landing, "--dt", "2024-06-03", "--as-of", "2024-06-05",
                 "--cities", str(cities), "--preset", "corrected"]) == 0
    assert '"mode": "full"' in capsys.readouterr().out
    assert main(["audit", "--warehouse", wh, "--preset", "corrected"]) == 0
    assert capsys.readouterr().out.strip() == ""  # no constraint violated
    t = ParquetTables(spark, wh, CORRECTED)
    assert sum(r.cnt for r in t.get("dm_metrics").collect()) == 8


@pytest.mark.parametrize("sem,expected", [(REFERENCE, {("A", 1), ("B", 1)}), (CORRECTED, {("B", 1)})])
def test_rerun_that_loses_a_skill(spark, sem, expected):
    t = fresh(spark, sem)
    stage(t, staged(spark, [(vacancy(1, skills=["A", "B"]), "Data engineer", MON, TS(2024, 6, 4, 1))]), rates_for(spark, [MON]))
    load(t, sem, MON)
    got1 = {(r.skill_name, r.top) for r in t.get("dm_skills").collect()}
    assert got1 == {("A", 1), ("B", 2)}
    if sem is REFERENCE:
        # the source's append-only links keep A, so only the upsert of a ranking without A shows the quirk
        ranking_without_a = t.get("dm_skills").where("skill_name = 'B'").withColumn("top", F.lit(1))
        got = merge.upsert(t.get("dm_skills"), ranking_without_a, ["city_name", "query_profession_eng_name", "skill_name", "dt"])
        assert {(r.skill_name, r.top) for r in got.collect()} == expected
    else:
        stage(t, staged(spark, [(vacancy(1, skills=["B"]), "Data engineer", MON, TS(2024, 6, 4, 2))]), rates_for(spark, [MON]))
        load(t, sem, MON)
        assert {(r.skill_name, r.top) for r in t.get("dm_skills").collect()} == expected


def test_corrected_counts_skills_of_the_kept_version_only(spark):
    t = fresh(spark, CORRECTED)
    docs = [(vacancy(1, skills=[s]), "Data engineer", MON, TS(2024, 6, 4, h)) for s, h in (("OLD", 1), ("NEW", 2))]
    stage(t, staged(spark, docs), rates_for(spark, [MON]))
    load(t, CORRECTED, MON)
    assert [r.skill_name for r in t.get("fct_skill_vacancy").collect()] == ["NEW"]
    assert [(r.skill_name, r.cnt) for r in t.get("dm_skills").collect()] == [("NEW", 1)]


def test_corrected_clears_the_skills_of_a_vacancy_staged_without_any(spark, tmp_path):
    for t in (fresh(spark, CORRECTED), fresh(spark, CORRECTED, str(tmp_path / "wh"))):
        for skills, hour in ((["A"], 1), ([], 2)):
            stage(t, staged(spark, [(vacancy(1, skills=skills), "Data engineer", MON, TS(2024, 6, 4, hour))]), rates_for(spark, [MON]))
            load(t, CORRECTED, MON)
        assert t.get("fct_skill_vacancy").count() == 0 and t.get("dm_skills").count() == 0


def test_corrected_reads_one_grain(spark):
    t = fresh(spark, CORRECTED)
    for day in (None, MON):
        stage(t, staged(spark, [(vacancy(1), "Data engineer", MON, TS(2024, 6, 4))]), rates_for(spark, [MON]))
        load(t, CORRECTED, day)
    mart = t.get("dm_metrics")
    assert mart.count() == 2
    city = mart.first().city_name
    for grain in ("day", "week"):
        assert [r.grain for r in serve.get_metrics(mart, city, "Data engineer", MON, MON, grain=grain).collect()] == [grain]
    assert audit(t, ["dm_metrics"]).where("n_findings > 0").count() == 0


@pytest.mark.parametrize("sem,null_in_dim", [(REFERENCE, True), (CORRECTED, False)])
def test_null_skill_names(spark, sem, null_in_dim):
    t = fresh(spark, sem)
    doc = json.dumps({"id": 1, "area": {"id": "1"}, "key_skills": [{"name": None}, {"name": "SQL"}]})
    stage(t, staged(spark, [(doc, "Data engineer", MON, TS(2024, 6, 4))]), rates_for(spark, [MON]))
    load(t, sem, MON)
    names = [r.name for r in t.get("d_skill").collect()]
    assert (None in names) == null_in_dim and "SQL" in names
    assert [r.skill_name for r in t.get("fct_skill_vacancy").collect()] == ["SQL"]  # a NULL name never links


@pytest.mark.parametrize("broken,parquet", [("dm_metrics", False), ("fct_exchange_rates", True), ("dm_skills", True)])
def test_a_failed_load_changes_nothing_and_can_be_run_again(spark, tmp_path, monkeypatch, broken, parquet):
    def ready(root):
        t = fresh(spark, REFERENCE, root)
        stage(t, staged(spark, [(vacancy(1, skills=["SQL"]), "Data engineer", MON, TS(2024, 6, 4))]), rates_for(spark, [MON]))
        return t

    clean = ready(None)
    load(clean, REFERENCE, MON)
    t = ready(str(tmp_path / "wh") if parquet else None)
    before = {name: sorted(map(tuple, t.get(name).collect())) for name in t.schemas}
    real = t.put

    def put(name, df, mode="overwrite"):
        if name == broken:
            raise RuntimeError("executor lost")
        real(name, df, mode)

    with monkeypatch.context() as m:
        m.setattr(t, "put", put)
        with pytest.raises(RuntimeError, match="executor lost"):
            load(t, REFERENCE, MON)
    assert {name: sorted(map(tuple, t.get(name).collect())) for name in t.schemas} == before
    load(t, REFERENCE, MON)
    want = {name: sorted(map(tuple, clean.get(name).collect())) for name in t.schemas}
    assert {name: sorted(map(tuple, t.get(name).collect())) for name in t.schemas} == want
    assert want["fct_skill_vacancy"] and want["dm_skills"][0][3:] and not want["stg_vacancies"]
    if parquet:
        t.vacuum()
        assert {name: sorted(map(tuple, t.get(name).collect())) for name in t.schemas} == want
        folders = {p.name for p in (tmp_path / "wh" / "fct_skill_vacancy").iterdir()}
        assert len(folders) == 1 and len(list((tmp_path / "wh" / "_published").glob("*.json"))) == 1


def test_a_batch_that_comes_again_is_loaded_once(spark, tmp_path):
    from labormart.streaming.ingest import batch_loader

    t = fresh(spark, REFERENCE, str(tmp_path / "wh"))
    rates = rates_for(spark, [MON]).select("obj", F.col("query_dt").alias("doc_day"), "update_ts")
    process = batch_loader(t, lambda: rates, REFERENCE, "landing")
    batch = staged(spark, [(vacancy(1, skills=["SQL"]), "Data engineer", MON, TS(2024, 6, 4))])
    for _ in range(2):
        process(batch, 0)
    assert t.get("fct_skill_vacancy").count() == 1 and t.get("fct_exchange_rates").count() == 1
    assert [r.cnt for r in t.get("dm_skills").collect()] == [1]


def test_the_second_of_two_writers_fails(spark, tmp_path):
    a, b = (fresh(spark, REFERENCE, str(tmp_path / "wh")) for _ in range(2))
    cities = a.get("d_city")
    with pytest.raises(RuntimeError, match="another writer"), a.transaction():
        a.put("d_city", cities.where("id = 1"))
        b.put("d_city", cities.where("id = 2"))
    assert [r.id for r in a.get("d_city").collect()] == [2]

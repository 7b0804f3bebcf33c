"""Plans whose cost must not grow faster than the input: one parse, one shuffle, no misjudged broadcast."""

import pytest
from helpers import D, TS, rate_doc, staged, vacancy
from pyspark.sql import functions as F

from labormart.operators import bridge, marts, parse, quarantine, variants
from labormart.schemas import RATE_RECORD, VACANCY_DOC, VACANCY_KEY
from labormart.semantics import CORRECTED, REFERENCE

DAY, STAMP = D(2024, 6, 1), TS(2024, 6, 2)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _docs(spark, *docs):
    return staged(spark, [(d, "Data engineer", DAY, STAMP) for d in docs or (vacancy(1, skills=["a", "b"]),)])


def test_entries_of_variants_are_not_broadcast_on_an_estimate(spark):
    """a VARIANT column makes the estimate of unnested entries far too small."""
    entries = parse.skill_entries(variants.with_variant(_docs(spark)))
    vac = parse.vacancy_rows(_docs(spark))
    links = bridge.link_skills(entries, vac)
    assert "Broadcast" not in _plan(links)
    assert sorted((r.skill_name, r.n_links) for r in links.collect()) == [("a", 1), ("b", 1)]


def test_variant_is_cast_once(spark):
    """one cast of the whole document, no schema of it."""
    rows = variants.with_variant(_docs(spark, '{"id": 1, "area": "x", "key_skills": [{"name": "a"}, 3]}', "[1]", "{}"))
    cast = rows.select(variants.as_struct("v", VACANCY_DOC).alias("d"), variants.as_struct("v", RATE_RECORD).alias("r"))
    assert "schema_of_variant" not in _plan(cast.where(variants.is_object()))
    assert variants.as_struct("v", RATE_RECORD)._jc.toString().count("try_variant_get") == 1
    d, none, empty = [r.d for r in cast.collect()]
    assert (d.id, d.area, [s and s.name for s in d.key_skills]) == ("1", None, ["a", None])
    assert none is None and empty.id is None and empty.key_skills is None


def test_written_variants_stay_whole(spark):
    """readers take whole documents, which are not taken apart to be written."""
    from labormart.session import materialize

    rows = materialize(spark, variants.with_variant(_docs(spark)).select("v"), "whole")
    footer = spark.read.option("ignoreVariantAnnotation", "true").parquet(*rows.inputFiles())
    assert rows.select(F.to_json("v")).first()[0].startswith("{")
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(footer.inputFiles()[0])
    found = jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(spark._jsc.hadoopConfiguration(), path)
    assert "typed_value" not in found.getFileMetaData().getSchema().toString()


def test_guarded_documents_are_parsed_once(spark):
    """The guard is no filter that is pushed below the parsing."""
    checked = quarantine.must_fit(quarantine.check_vacancies(_docs(spark)))
    plan = _plan(checked.drop("obj"))
    assert plan.count("from_json(") == 1 and plan.count("lengthOfJsonArray") == 1
    assert checked.select("d.id").first()[0] == "1"


@pytest.mark.parametrize("variant", [False, True])
def test_guard_fails_whatever_is_read(spark, variant):
    rows = _docs(spark, vacancy("x1", skills=["a"]))
    rows = variants.with_variant(rows) if variant else rows
    with pytest.raises(Exception, match="rejected document"):
        parse.skill_entries(quarantine.must_fit(quarantine.check_vacancies(rows))).collect()


def test_well_formed_check_reads_the_text_once(spark):
    """``malformed`` is found by one more reading of the text, not by one per reason."""
    rows = _docs(spark, "{}", " \n{\"id\": 1} ", "{} {}", "{},{}", "[{}]", "{", "", "3", "null", "\x0b{}")
    checked = quarantine.check_vacancies(rows)
    plan = _plan(checked)
    assert plan.count("lengthOfJsonArray") == 1 and "jsonObjectKeys" not in plan
    assert [("malformed" in r.reasons) for r in checked.collect()] == [False, False, *[True] * 8]


def test_dimensions_without_statistics_are_broadcast(spark):
    """rows made by the driver have no size; the few distinct values are written and measured."""
    professions = spark.createDataFrame([("Data engineer",)], "eng_name string")
    cities = spark.createDataFrame([(1,)], "id int")
    kept = parse.resolve_dimensions(parse.vacancy_rows(_docs(spark)), professions, cities)
    assert _plan(kept).count("BroadcastHashJoin") == 2 and "hashpartitioning" not in _plan(kept)
    assert kept.count() == 1


@pytest.mark.parametrize("mode", ["error", "latest"])
def test_versions_are_shuffled_once(spark, mode):
    """one exchange resolves the versions of a key."""
    rows = parse.vacancy_rows(_docs(spark, vacancy(1), vacancy(1), vacancy(2)))
    out = parse.dedup_versions(rows, VACANCY_KEY, parse.VACANCY_VALUE_COLS, mode)
    assert _plan(out).count("Exchange hashpartitioning") == 1
    assert out.count() == 2


def test_versions_that_differ_in_a_null(spark):
    rows = spark.createDataFrame([(1, None, 1), (1, "a", 2), (2, None, None), (2, None, 3)], "k int, v string, update_ts int")
    latest = parse.dedup_versions(rows, ["k"], ["v"], "latest")
    assert sorted(tuple(r) for r in latest.collect()) == [(1, "a", 2), (2, None, 3)]
    assert [tuple(r) for r in parse.dedup_versions(rows.where("k = 2"), ["k"], ["v"]).collect()] == [(2, None, 3)]
    with pytest.raises(Exception, match="duplicate versions"):
        parse.dedup_versions(rows, ["k"], ["v"]).collect()


def test_keyed_links_and_counts_shuffle_links_once(spark):
    """links are dealt by vacancy once per step, not by vacancy and skill before."""
    docs = _docs(spark, vacancy(1, skills=["a", "a", "b"]), vacancy(2, skills=["a"]))
    vac = parse.vacancy_rows(docs)
    links = bridge.link_skills(parse.skill_entries(docs), vac, keyed=True)
    assert _plan(links).count("Exchange hashpartitioning") == 2  # entries and vacancies
    assert sorted((r.vacancy_id, r.skill_name, r.n_links) for r in links.collect()) == [(1, "a", 1), (1, "b", 1), (2, "a", 1)]
    cities = spark.createDataFrame([(1, "Moscow")], "id int, name string")
    twice = links.unionByName(links)  # as appended by two loads
    counts = marts.skill_counts(twice, vac, cities)
    assert sorted((r.skill_name, r.cnt) for r in counts.collect()) == [("a", 4), ("b", 2)]


def test_corrected_load_writes_links_once_and_texts_of_rejects_only(spark, monkeypatch):
    """replaced days are not copied after they were written; accepted texts are not kept."""
    from labormart.plans import pipeline, tables as back_ends

    written = {}

    def materialize(spark, df, name, folder=None, write=back_ends.materialize):
        out = write(spark, df, name, folder)
        written.setdefault(name, []).append(out)
        return out

    monkeypatch.setattr(back_ends, "materialize", materialize)
    dims = {
        "d_city": spark.createDataFrame([(1, "Moscow", "Moscow")], "id int, name string, eng_name string"),
        "d_query_profession": spark.createDataFrame([(1, "x", "Data engineer")], "id int, name string, eng_name string"),
    }
    tables = back_ends.MemoryTables(spark, CORRECTED, initial=dims)
    rates = spark.createDataFrame([(rate_doc("2024-06-01T11:30:00+03:00", {"USD": ("90.0", "1")}), DAY, STAMP)], "obj string, query_dt date, update_ts timestamp_ntz")
    pipeline.stage(tables, _docs(spark, vacancy(1, skills=["a"]), "{"), rates)
    pipeline.load(tables, CORRECTED, None)
    assert len(written["fct_skill_vacancy"]) == 1 and len(written["dm_skills"]) == 1
    parsed = written["parsed_vacancies"][0]
    assert [r.obj for r in parsed.collect() if r.obj is not None] == ["{"]
    assert [r.obj for r in tables.get("rejects").collect()] == ["{"]
    assert REFERENCE.quarantine is False

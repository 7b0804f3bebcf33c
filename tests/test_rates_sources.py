"""As-of fill, day spine, landed-document rules, ingest grid and page cap."""

import datetime as dt
import json

from helpers import TS, D, rate_doc
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labormart.functions.dates import day_spine
from labormart.operators.rates import asof_fill
from labormart.sources import landed


def test_spine_is_inclusive_and_gapless(spark):
    days = [r.dt for r in day_spine(spark, D(2024, 6, 1), D(2024, 6, 5)).orderBy("dt").collect()]
    assert days == [D(2024, 6, d) for d in range(1, 6)]


def test_spine_is_empty_when_start_after_end(spark):
    assert day_spine(spark, D(2024, 6, 5), D(2024, 6, 1)).count() == 0


def _brute_asof(obs, end):
    out = {}
    for key in {k for k, _, _ in obs}:
        days = sorted((d, v) for k, d, v in obs if k == key)
        first = days[0][0]
        d = first
        while d <= end:
            src = max(x for x in days if x[0] <= d)
            out[(key, d)] = src
            d += dt.timedelta(days=1)
    return out


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.integers(0, 900), st.integers(0, 1000)),
        min_size=1,
        max_size=25,
        unique_by=lambda t: (t[0], t[1]),
    ),
    st.integers(0, 950),
)
def test_asof_matches_brute_force_across_years(spark, raw, end_off):
    base = D(2022, 11, 1)  # offsets up to 900 days cross two year boundaries
    obs = [(k, base + dt.timedelta(days=o), v) for k, o, v in raw]
    end = base + dt.timedelta(days=end_off)
    df = spark.createDataFrame(obs, "k int, day date, v int")
    got = {(r.k, r.dt): (r.day, r.v) for r in asof_fill(df, ["k"], "day", end=end).collect()}
    want = _brute_asof(obs, end)
    assert got == want
    # never a value from a later day
    assert all(src_day <= d for (_, d), (src_day, _) in got.items())


def test_asof_without_keys(spark):
    obs = spark.createDataFrame([(D(2023, 12, 30), 1), (D(2024, 1, 2), 2)], "day date, v int")
    got = {r.dt: r.v for r in asof_fill(obs, [], "day", end=D(2024, 1, 3)).collect()}
    assert got == {D(2023, 12, 30): 1, D(2023, 12, 31): 1, D(2024, 1, 1): 1, D(2024, 1, 2): 2, D(2024, 1, 3): 2}


def test_missing_rate_days_take_the_earlier_document(spark):
    fri = rate_doc("2024-06-07T11:30:00+03:00", {"USD": ("90.0", 1)})
    err = json.dumps({"error": "not found", "code": 404})
    docs = spark.createDataFrame(
        [(fri, D(2024, 6, 7)), (err, D(2024, 6, 8)), (err, D(2024, 6, 9))], "obj string, doc_day date"
    )
    staged = landed.rate_documents_for_days(docs, end=D(2024, 6, 9), start=D(2024, 6, 7))
    got = {r.query_dt: json.loads(r.obj)["Date"] for r in staged.collect()}
    assert got == {D(2024, 6, d): "2024-06-07T11:30:00+03:00" for d in (7, 8, 9)}


def test_error_key_rejects_even_a_null_value(spark):
    docs = spark.createDataFrame([('{"errors": null}',), ('{"id": 1}',), ('{"errors": [1]}',)], "obj string")
    assert [r.obj for r in landed.reject_errors(docs).collect()] == ['{"id": 1}']


def test_page_cap_and_counts(spark):
    rows = [(D(2024, 6, 1), 1, "Data engineer", i) for i in range(350)] + [(D(2024, 6, 1), 2, "Data engineer", 1)]
    df = spark.createDataFrame(rows, "dt date, city_id int, query_profession_eng_name string, vacancy_id long")
    capped = landed.cap_pages(df, ["dt", "city_id", "query_profession_eng_name"], ["vacancy_id"])
    counts = {(r.city_id, r.page): r.n_docs for r in landed.accepted_per_request(capped, ["city_id"]).collect()}
    assert counts == {(1, 0): 100, (1, 1): 100, (1, 2): 100, (2, 0): 1}


def test_ingest_grid_and_missing_cells(spark):
    from labormart.schemas import D_CITY, D_QUERY_PROFESSION
    from labormart.sources.dims import PROFESSION_SEED

    cities = spark.createDataFrame([(1, "a", "A"), (2, "b", "B")], D_CITY)
    profs = spark.createDataFrame(PROFESSION_SEED, D_QUERY_PROFESSION)
    spine = day_spine(spark, D(2024, 6, 1), D(2024, 6, 2))
    grid = landed.ingest_grid(spine, cities, profs, pages=3)
    assert grid.count() == 2 * 2 * 3 * 3
    landed_cells = spark.createDataFrame([(D(2024, 6, 1), 1, "Data engineer", 0)], "dt date, city_id int, query_profession_eng_name string, page int")
    missing = landed.missing_cells(grid.where("page = 0"), landed_cells, ["dt", "city_id", "query_profession_eng_name", "page"])
    assert missing.count() == 2 * 2 * 3 - 1


def test_list_pages_to_details(spark):
    pages = spark.createDataFrame(
        [(json.dumps({"items": [{"id": "1", "url": "u1"}, {"id": "2", "url": "u2"}]}), 0), ('{"errors": []}', 1)],
        "obj string, page int",
    )
    items = landed.list_page_items(pages)
    details = spark.createDataFrame([('{"id": 1}', "u1"), ('{"errors": 1}', "u3")], "obj string, url string")
    assert [r.url for r in landed.detail_documents_for_pages(items, details).collect()] == ["u1"]
    assert [r.url for r in landed.missing_details(items, details).collect()] == ["u2"]


def test_landed_files_read_with_partitions(spark, tmp_path):
    root = tmp_path / "vacancies" / "query_dt=2024-06-01" / "query_profession_eng_name=Data engineer"
    root.mkdir(parents=True)
    (root / "part-0.jsonl").write_text('{"id": 1}\n{"errors": null}\n\n{"id": 2}\n', encoding="utf-8")
    df = landed.read_vacancy_documents(spark, str(tmp_path / "vacancies"))
    rows = df.collect()
    assert sorted(json.loads(r.obj)["id"] for r in rows) == [1, 2]
    assert {(r.query_profession_eng_name, r.query_dt) for r in rows} == {("Data engineer", D(2024, 6, 1))}
    assert all(isinstance(r.update_ts, dt.datetime) for r in rows)


def test_city_file(spark, tmp_path):
    from labormart.sources.dims import read_cities

    p = tmp_path / "city.csv"
    p.write_text("id|name|eng_name\n1|Москва|Moscow\n237|Сочи|Sochi\n", encoding="utf-8")
    rows = read_cities(spark, str(p)).collect()
    assert [(r.id, r.name, r.eng_name) for r in rows] == [(1, "Москва", "Moscow"), (237, "Сочи", "Sochi")]


def test_timestamp_offsets_are_dropped(spark):
    from labormart.functions.dates import local_timestamp

    df = spark.createDataFrame([("2024-06-01T10:00:00+0300",), ("2024-06-01T10:00:00+03:00",)], "s string")
    assert {r.t for r in df.select(local_timestamp("s").alias("t")).collect()} == {TS(2024, 6, 1, 10, 0)}


def test_caption_and_prev_day(spark):
    from labormart.functions.dates import caption_date, prev_day

    r = spark.range(1).select(caption_date(F.lit(D(2024, 6, 1))).alias("c"), prev_day(D(2024, 6, 1)).alias("p")).first()
    assert (r.c, r.p) == ("01.06.2024", D(2024, 5, 31))


def test_request_selection_on_landed_rows(spark):
    rows = spark.createDataFrame(
        [(1, 1, TS(2024, 6, 1, 10)), (2, 2, TS(2024, 6, 1, 11)), (3, 1, TS(2024, 6, 2, 9))],
        "vacancy_id long, city_id int, published_at timestamp_ntz",
    )
    got = [r.vacancy_id for r in landed.select_for_request(rows, "2024-06-01", 1).collect()]
    assert got == [1]


def test_variant_access_reads_numbers_and_text_alike(spark):
    from labormart.functions.json import as_variant, variant_field

    df = spark.createDataFrame([('{"id": 7, "area": {"id": "1"}}',), ('{"id": "7"}',)], "obj string")
    rows = df.select(as_variant("obj").alias("v")).select(
        variant_field("v", "id").alias("id"), variant_field("v", "area.id", "int").alias("area")
    ).collect()
    assert [(r.id, r.area) for r in rows] == [("7", 1), ("7", None)]


def test_cluster_sizing():
    from labormart.session import cluster_conf

    conf = cluster_conf(100 * 1024**4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(1024, 8)["spark.sql.shuffle.partitions"]) == 16


def test_malformed_documents_fail_or_are_kept(spark, tmp_path):
    import pytest

    root = tmp_path / "vacancies" / "query_dt=2024-06-01" / "query_profession_eng_name=Data engineer"
    root.mkdir(parents=True)
    (root / "part-0.jsonl").write_text('{"id": 1}\n{"id": 2\n[1, 2]\n', encoding="utf-8")
    path = str(tmp_path / "vacancies")
    assert landed.read_vacancy_documents(spark, path, on_malformed="keep").count() == 3
    raw = spark.read.text(path).withColumnRenamed("value", "obj")
    assert sorted(r.obj for r in landed.malformed_documents(raw).collect()) == ['[1, 2]', '{"id": 2']
    with pytest.raises(Exception, match="malformed JSON document"):
        landed.read_vacancy_documents(spark, path).collect()


def test_empty_request_fills_no_days(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from labormart.operators.rates import asof_fill

    obs = spark.createDataFrame([(dt.date(2024, 1, 1), "a"), (dt.date(2024, 1, 5), "b")], "day date, obj string")
    none = F.lit(None).cast("date")
    assert asof_fill(obs, [], "day", end=none, start=none).count() == 0
    assert asof_fill(obs, [], "day", end="2024-01-06", start="2024-01-02").count() == 5


def test_one_json_object_and_nothing_after_it(spark):
    from labormart.sources.landed import is_json_object

    rows = [('{"id": 1}', True), ('{"id": 1} x', False), ('{"id": 1}{"id": 2}', False), ('{"id": ', False), ("[1]", False), ('  {"a": {"b": [1, 2]}}  ', True), (None, False)]
    df = spark.createDataFrame(rows, "obj string, want boolean")
    from pyspark.sql import functions as F

    assert df.where(F.coalesce(is_json_object("obj"), F.lit(False)) != F.col("want")).count() == 0


def test_cut_off_rate_document_does_not_serve(spark):
    import datetime as dt

    from labormart.sources.landed import rate_documents_for_days

    docs = spark.createDataFrame([('{"Valute": {}}', dt.date(2024, 1, 1)), ('{"Valute": {"USD": ', dt.date(2024, 1, 2))], "obj string, doc_day date")
    days = {r.query_dt: r.obj for r in rate_documents_for_days(docs, end="2024-01-03").collect()}
    assert set(days.values()) == {'{"Valute": {}}'} and len(days) == 3


def test_pages_are_numbered_without_a_cap(spark):
    from labormart.sources.landed import number_pages

    rows = spark.range(1234).selectExpr("id", "1 AS cell")
    pages = {r.page: r["count"] for r in number_pages(rows, ["cell"], ["id"]).groupBy("page").count().collect()}
    assert pages == {**{p: 100 for p in range(12)}, 12: 34}

"""Checks while a load writes, states of micro-batches, and requests counted on a stream."""

import json
import random

import pytest
from helpers import TS, D, staged, vacancy
from pyspark.sql import functions as F
from test_pipeline import MON, fresh, rates_for

from labormart import CORRECTED, REFERENCE
from labormart.operators.observed import ObservedTables
from labormart.operators.quality import audit
from labormart.plans.pipeline import load, stage
from labormart.schemas import STG_EXCHANGE_RATES, STG_VACANCIES
from labormart.sources.pages import requests_made


@pytest.mark.parametrize("sem", [REFERENCE, CORRECTED])
def test_observed_findings_equal_the_audit(spark, sem):
    t = ObservedTables(fresh(spark, sem))
    docs = [vacancy(i, skills=["SQL", f"S{i % 3}"], currency="USD", lo=i, hi=i + 5) for i in range(1, 7)]
    with t.transaction():
        stage(t, staged(spark, [(d, "Data engineer", MON, TS(2024, 6, 4)) for d in docs]), rates_for(spark, [MON]))
        load(t, sem, None)
    seen = {(r.table_name, r.check, r.target): r.n_findings for r in t.findings().collect() if r.check != "rows"}
    names = sorted({k[0] for k in seen})
    assert {"stg_vacancies", "d_vacancies", "d_skill", "fct_skill_vacancy", "dm_metrics", "dm_skills"} <= set(names)
    want = {(r.table_name, r.check, r.target): r.n_findings for r in audit(t, [n for n in names if not n.startswith("stg_") and n in __import__("labormart.operators.quality", fromlist=["x"]).CONSTRAINTS]).collect()}
    assert {k: v for k, v in seen.items() if not k[0].startswith("stg_")} == want and not any(seen.values())
    assert sorted(map(tuple, t.get("load_audit").collect())) == sorted(map(tuple, t.findings().collect()))


def test_observed_faults(spark):
    """NULLs, lengths, keys that repeat a stored row, references without a parent: counted on the rows written."""
    t = ObservedTables(fresh(spark, REFERENCE))
    skills = "city_name string, query_profession_eng_name string, skill_name string, dt date, top int, cnt int"
    t.put("dm_skills", spark.createDataFrame([("M", "p", "a", MON, 1, 1), ("M", "p", "b", D(2024, 6, 4), 1, 1)], skills), "append")
    with t.transaction():
        t.put("dm_skills", spark.createDataFrame([("M", "p", "a", MON, 1, 1), ("M", "p", None, MON, 2, 1), ("C" * 101, "p", "c", MON, 1, None)], skills), "append")
        links = spark.createDataFrame([(1, "p", "SQL", 2, MON), (1, "p", "x", 1, MON)], "vacancy_id long, query_profession_eng_name string, skill_name string, n_links long, dt date")
        t.put("d_skill", spark.createDataFrame([(1, "SQL"), (2, "s" * 151)], "id long, name string"), "append")
        t.put("fct_skill_vacancy", links, "append")
    found = {(r.table_name, r.check, r.target): r.n_findings for r in t.get("load_audit").collect() if r.n_findings}
    assert found == {
        ("dm_skills", "not_null", "skill_name"): 1, ("dm_skills", "not_null", "cnt"): 1, ("dm_skills", "length", "city_name"): 1,
        ("dm_skills", "unique", "city_name,query_profession_eng_name,skill_name,dt"): 1, ("d_skill", "length", "name"): 1,
        ("fct_skill_vacancy", "foreign_key", "vacancy_id,dt,query_profession_eng_name->d_vacancies"): 2, ("fct_skill_vacancy", "foreign_key", "skill_name->d_skill"): 1,
    }
    with pytest.raises(RuntimeError, match="stop"), t.transaction():
        t.put("dm_skills", spark.createDataFrame([("M", "p", "z", MON, 9, 9)], skills), "append")
        raise RuntimeError("stop")
    assert t.get("dm_skills").count() == 5


@pytest.mark.parametrize("sem", [REFERENCE, CORRECTED])
def test_micro_batches_in_any_order_equal_the_full_load(spark, sem):
    """Replaced versions (CORRECTED) and late rates: day rows from merged states equal those from all rows."""
    rng = random.Random(2)
    days = [MON, D(2024, 6, 4)]
    exp = ["noExperience", "between1And3", "moreThan6"]
    make = lambda i: json.dumps(vacancy(i, area=1 + i % 2, currency=rng.choice(["RUR", "USD"]), lo=rng.randrange(99), hi=rng.randrange(99), exp=rng.choice(exp)))
    first = [(make(i), "Data engineer", days[i % 2], TS(2024, 6, 5)) for i in range(12)]
    again = [(make(i), "Data engineer", days[i % 2], TS(2024, 6, 6)) for i in range(0, 12, 3)] if sem.on_duplicate == "latest" else []
    batches = [first[:5], first[5:], again]
    rates = rates_for(spark, days, {"USD": ("90.1234", 10)})
    rows = lambda df: sorted(map(str, df.collect()))
    found = []
    for order in ((0, 1, 2), (1, 0, 2)):
        t = fresh(spark, sem)
        for b in order:
            if batches[b]:
                load(t, sem, batch=(spark.createDataFrame(batches[b], STG_VACANCIES), rates))
        found.append((rows(t.get("dm_metrics")), rows(t.get("dm_metric_states"))))
    t = fresh(spark, sem)
    load(t, sem, batch=(spark.createDataFrame([r for b in batches for r in b], STG_VACANCIES), rates))
    assert found[0] == found[1] == (rows(t.get("dm_metrics")), rows(t.get("dm_metric_states"))) and found[0][0]
    # a day whose quotes change is summed anew, with vacancies that the batch does not hold
    other = rates_for(spark, days[:1], {"USD": ("50", 10)})
    one = spark.createDataFrame(first[:1], STG_VACANCIES)
    if sem.replace_facts:
        load(t, sem, batch=(one, other))
        whole = fresh(spark, sem)
        last = [r for r in first if r not in first[:1]] + again + [(first[0][0], *first[0][1:3], TS(2024, 6, 4))]
        both = other.unionByName(rates.where(F.col("query_dt") == days[1]))
        load(whole, sem, batch=(spark.createDataFrame(last, STG_VACANCIES), both))
        key = lambda x: rows(x.get("dm_metrics").where(F.col("dt") == days[1]))
        assert key(t) == key(whole)
        assert t.get("dm_metrics").where(F.col("dt") == days[0]).agg(F.sum("cnt")).first()[0] == 6
    assert spark.createDataFrame([], STG_EXCHANGE_RATES).count() == 0


CELL = ["query_dt", "city_id", "query_profession_eng_name"]


def test_requests_on_a_stream_in_any_split_and_after_a_restart(spark, tmp_path):
    from labormart.streaming.requests import expected_rows, request_rows, stream_requests

    rng = random.Random(6)
    cells = [(D(2024, 6, d), c, p) for d in (3, 4) for c in (1, 2) for p in ("DE", "DA")]
    docs = [(*cell, rng.randrange(4), '{"id": 1}' if rng.random() < 0.7 else '{"errors": null}') for cell in cells[:-1] for _ in range(rng.randrange(1, 9))]
    schema = "query_dt date, city_id int, query_profession_eng_name string, page int, obj string"
    batch = spark.createDataFrame(docs, schema)
    grid = spark.createDataFrame(cells, "query_dt date, city_id int, query_profession_eng_name string")
    want = sorted(map(tuple, requests_made(batch, grid, CELL).collect()))
    end = spark.createDataFrame([(D(2024, 6, 9), 0, "end", None, 0)], "query_dt date, city_id int, query_profession_eng_name string, page int, accepted int")
    for split in (1, 3):
        landing, out, ckpt = (str(tmp_path / f"{x}{split}") for x in ("landing", "out", "ckpt"))
        rows = request_rows(batch, CELL, "query_dt").unionByName(expected_rows(grid, CELL)).collect()
        rng.shuffle(rows)
        # rows of both days in every file: the first day stays open until the last file
        parts = [rows[i::split] for i in range(split)]

        def run():
            read = spark.readStream.schema(end.schema).option("maxFilesPerTrigger", 1).parquet(landing)
            query = stream_requests(read, CELL, "query_dt", lateness="2 days").writeStream.format("parquet").option("checkpointLocation", ckpt).option("path", out).outputMode("append").trigger(availableNow=True)
            query.start().awaitTermination()

        for part in parts:  # the query is started again for every file
            spark.createDataFrame(part, end.schema).coalesce(1).write.mode("append").parquet(landing)
            run()
        end.coalesce(1).write.mode("append").parquet(landing)
        run()
        assert sorted(map(tuple, spark.read.parquet(out).select(*CELL, "page", "n_docs").collect())) == want

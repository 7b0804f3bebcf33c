"""Size-checked broadcast decisions and table-version lineage helpers."""

from pyspark.sql import functions as F

from labormart.operators import joins
from labormart.operators.numbering import numbered
from labormart.plans.tables import empty_table
from labormart.schemas import D_CITY
from labormart.session import materialize


def _is_broadcast_hinted(df) -> bool:
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString() or "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()


def test_small_scan_is_broadcast_without_counting(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.createDataFrame([(i, f"c{i}") for i in range(5)], "id int, name string").write.parquet(path)
    dim = spark.read.parquet(path)
    assert joins.estimated_bytes(dim) is not None and joins._estimate_is_bound(dim)
    sc = spark.sparkContext
    sc.setJobGroup("bis-scan", "bis-scan")
    out = joins.broadcast_if_small(dim)
    assert len(sc.statusTracker().getJobIdsForGroup("bis-scan")) == 0  # decided from the estimate
    assert _is_broadcast_hinted(out)


def test_row_multiplying_plan_is_written_and_sized(spark):
    a = spark.range(50).withColumn("k", F.col("id") % 5)
    b = spark.range(50).withColumn("k", F.col("id") % 5)
    joined = a.join(b, "k").select("k")  # 500 rows: the estimate is no bound
    assert not joins._estimate_is_bound(joined)
    small, large = joins.broadcast_if_small(joined), joins.broadcast_if_small(joined, max_bytes=100)
    assert _is_broadcast_hinted(small) and not _is_broadcast_hinted(large)
    assert small.count() == large.count() == 500
    assert "Join" not in large._jdf.queryExecution().optimizedPlan().toString()  # the written rows, not the plan


def test_distinct_values_have_no_limit(spark):
    df = spark.range(300_000).select((F.col("id") % 150_000).alias("d"))
    assert spark.range(1).select(F.size(joins.distinct_values(df, "d")).alias("n")).first().n == 150_000


def test_places_within_groups_of_any_size(spark):
    """A group over many partitions, equal rows, null keys, and columns named like the inner ones."""
    rows = [(None if i % 50 == 7 else "hot" if i % 3 else f"k{i % 11}", i % 37, i % 2, 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, o int, tag int, part int").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [(r.k, r.o, r.place) for r in numbered(df, ["k"], ["o"]).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    groups = {}
    for k, o, place in got:
        groups.setdefault(k, []).append((place, o))
    assert len(got) == 3000
    for places in groups.values():
        assert [p for p, _ in sorted(places)] == list(range(len(places)))
        assert [o for _, o in sorted(places)] == sorted(o for _, o in places)
    assert numbered(df.where("false"), ["k"], ["o"]).count() == 0


def test_empty_tables_vanish_from_unions(spark):
    e = empty_table(spark, D_CITY)
    other = spark.createDataFrame([(1, "a", "A")], D_CITY)
    plan = e.unionByName(other)._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan and "Union" not in plan


def test_materialize_ends_the_plan_at_files(spark):
    agg = spark.range(100).withColumn("g", F.col("id") % 3).groupBy("g").count()
    m = materialize(spark, agg, "t")
    assert "Aggregate" not in m._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(tuple(r) for r in m.collect()) == sorted(tuple(r) for r in agg.collect())


def test_join_against_a_bucketed_table_shuffles_one_side(spark, tmp_path):
    import uuid

    db = f"lmj_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    a = spark.createDataFrame([(i, i % 5) for i in range(500)], "vacancy_id long, city_id int")
    a.write.bucketBy(4, "vacancy_id").sortBy("vacancy_id").option("path", str(tmp_path / "a")).saveAsTable(f"{db}.a")
    entries = spark.range(1500).selectExpr("id % 500 as vacancy_id", "id as x")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = entries.join(spark.table(f"{db}.a"), "vacancy_id")
        assert j.count() == 1500
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_incremental_links_broadcast_the_days_entries(spark):
    import datetime as dt

    from helpers import TS, staged, vacancy

    from labormart.operators import bridge, parse

    day = dt.date(2024, 6, 3)
    docs = staged(spark, [(vacancy(i, skills=["SQL", f"S{i % 3}"]), "Data engineer", day, TS(2024, 6, 4)) for i in range(30)])
    parsed = materialize(spark, parse.parse_vacancy_documents(docs), "p")
    vac = spark.range(100000).selectExpr("id as vacancy_id", "date'2024-06-03' as dt", "'Data engineer' as query_profession_eng_name")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = bridge.link_skills(parse.skill_entries(parsed), vac, keyed=False, small_entries=True)
        plan = links._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "BuildLeft" in plan and "SortMergeJoin" not in plan
        assert links.count() == 60
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)

"""Registered queries against their DuckDB statements on the smallest generated tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from labormart.sources.testdata import TABLES

SF = "/root/testdata/sf0.001"
# the composed pipelines are covered in test_pipeline; here the single operators
FAST = [
    "metrics_daily", "metrics_weekly", "skills_rank", "skills_top30", "json_extract", "json_array_explode",
    "json_map_explode", "error_doc_filter", "dedup_distinct", "insert_new_anti", "upsert_merge",
    "upsert_null_overwrite", "rates_asof", "fx_salary", "dim_lookup_inner", "dim_lookup_left",
    "skill_links_reference", "skill_links_keyed", "metrics_by_params", "dash_avg_salary",
    "dash_schedule_share", "dash_top_skills", "page_cap", "ingest_counts", "ingest_grid_missing",
    "list_page_details", "list_page_missing", "dq_nulls", "dq_unique", "dq_fk", "dq_length", "dq_range",
    "varchar_truncate", "ts_offset_strip", "week_trunc", "prev_day", "metrics_weekly_corrected", "dq_audit_vacancies",
    "page_stop", "page_requests", "variant_extract", "variant_array_explode", "variant_map_explode",
    "salary_asof_changing", "rates_changing_daily", "metrics_from_states", "metrics_weekly_from_states", "skills_any_window",
    "schedules_any_window", "observed_checks", "skill_dimension", "currency_upsert", "skills_upsert", "metrics_by_city_code",
    "records_unescaped",
    "records_json", "get_cities", "get_professions", "skills_by_params", "dash_cnt_trend",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_an_oracle():
    from labormart.plans.catalog import ORACLE, QUERIES

    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rel = con.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, df.collect()) == _rows(d_cols, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "cnt" in df.columns

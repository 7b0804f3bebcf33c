"""Flattening of staged JSON documents into typed rows.

Vacancy documents → d_vacancies rows (P1, J1, J2, A7, Q7) and skill entries
(J3); rate documents → currency records (J7, P2, A9) and rate facts (P3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labormart.functions.dates import local_timestamp
from labormart.functions.json import parse_doc, variant_field
from labormart.functions.text import truncate
from labormart.operators import variants
from labormart.operators.joins import broadcast_if_small
from labormart.schemas import RATE_RECORD, RATES_DOC, VACANCY_DOC, VACANCY_KEY
from labormart.semantics import REFERENCE, Semantics

VACANCY_VALUE_COLS = [
    "city_id",
    "profession",
    "salary_currency",
    "salary_from",
    "salary_to",
    "experience",
    "schedule",
    "published_at",
]


def parse_vacancy_documents(staging: DataFrame) -> DataFrame:
    """Staged rows with the document parsed once into the struct column ``d``.

    Parsing is the costly step; vacancy rows, skill names and skill entries
    all read ``d`` instead of parsing the text again.
    """
    if "d" in staging.columns:
        return staging
    if "v" in staging.columns:
        return staging.withColumn("d", variants.as_struct("v", VACANCY_DOC)).drop("obj")
    return staging.select(
        parse_doc("obj", VACANCY_DOC).alias("d"), "query_profession_eng_name", "query_dt", "update_ts"
    )


def vacancy_rows(staging: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """Typed columns out of each staged vacancy document (no joins, no dedup).

    Every JSON leaf is read as text and cast here; ``::varchar(n)`` casts are
    explicit truncations. ``published_at`` keeps its wall-clock time.
    """
    return parse_vacancy_documents(staging).select(
        F.col("d.id").cast("bigint").alias("vacancy_id"),
        F.col("d.area.id").cast("int").alias("city_id"),
        F.col("query_profession_eng_name"),
        truncate(F.col("d.name"), sem.name_len).alias("profession"),
        truncate(F.col("d.salary.currency"), sem.currency_len).alias("salary_currency"),
        F.col("d.salary.from").cast("decimal(18,2)").alias("salary_from"),
        F.col("d.salary.to").cast("decimal(18,2)").alias("salary_to"),
        truncate(F.col("d.experience.id"), sem.experience_len).alias("experience"),
        truncate(F.col("d.schedule.id"), sem.schedule_len).alias("schedule"),
        local_timestamp(F.col("d.published_at")).alias("published_at"),
        F.col("query_dt").cast("date").alias("dt"),
        F.col("update_ts"),
        F.col("d.key_skills").alias("key_skills"),
    )


def resolve_dimensions(rows: DataFrame, professions: DataFrame, cities: DataFrame) -> DataFrame:
    """J1 + J2: keep rows whose profession and city exist in the dimensions (inner joins)."""
    prof = broadcast_if_small(professions.select(F.col("eng_name").alias("query_profession_eng_name")).distinct())
    city = broadcast_if_small(cities.select(F.col("id").alias("city_id")).distinct())
    return rows.join(prof, "query_profession_eng_name", "left_semi").join(city, "city_id", "left_semi")


def dedup_versions(
    rows: DataFrame,
    key: list[str],
    value_cols: list[str],
    on_duplicate: str = "error",
    ts_col: str = "update_ts",
) -> DataFrame:
    """A7 + Q7: drop exact repeats, then resolve keys that still hold several versions.

    One grouping by key: the versions of a key are merged map-side, so a document
    staged many times is cheap, and each key's row is shuffled once.
    ``on_duplicate="error"`` fails the job like the source's upsert does (two
    rows for one conflict key); ``"latest"`` keeps the version with the greatest
    ``ts_col``.
    """
    if on_duplicate not in ("error", "latest"):
        raise ValueError("on_duplicate must be 'error' or 'latest'")
    has_ts = ts_col in rows.columns
    ts = F.col(ts_col) if has_ts else F.lit(None).cast("timestamp_ntz")
    grouped, values = rows.groupBy(*key), F.struct(*[F.col(c) for c in value_cols])
    if on_duplicate == "latest":
        # order by (timestamp, values): never NULL, so max always picks a version,
        # and equal timestamps resolve deterministically
        latest = F.max(F.struct(ts.alias("_ts"), values.alias("_v"))).alias("_l")
        per_key = grouped.agg(latest).select(*key, F.col("_l._v").alias("_v"), F.col("_l._ts").alias("_ts"))
    else:
        # the least and the greatest values differ where a key has several versions;
        # evaluated in the filter, so the job fails on the first conflicting key
        per_key = grouped.agg(F.min(values).alias("_least"), F.max(values).alias("_v"), F.max(ts).alias("_ts"))
        guard = F.when(
            ~F.col("_least").eqNullSafe(F.col("_v")),
            F.raise_error(F.concat(F.lit("duplicate versions for key "), F.to_json(F.struct(*[F.col(k) for k in key])))),
        )
        per_key = per_key.where(guard.isNull())
    out = per_key.select(*key, *[F.col(f"_v.{c}").alias(c) for c in value_cols], F.col("_ts").alias(ts_col))
    return out if has_ts else out.drop(ts_col)


def flatten_vacancies(
    staging: DataFrame, professions: DataFrame, cities: DataFrame, sem: Semantics = REFERENCE
) -> DataFrame:
    """Staged vacancy documents → one d_vacancies row per (vacancy_id, dt, profession)."""
    return flatten_with_skills(staging, professions, cities, sem).drop("key_skills")


def flatten_with_skills(
    staging: DataFrame, professions: DataFrame, cities: DataFrame, sem: Semantics = REFERENCE
) -> DataFrame:
    """``flatten_vacancies`` plus the ``key_skills`` of the version that was kept.

    The entries only travel where links are keyed; elsewhere every staged copy
    counts (Q14), so versions that differ in nothing but skills stay one.
    """
    rows = resolve_dimensions(vacancy_rows(staging, sem), professions, cities)
    if sem.keyed_bridge:
        return dedup_versions(rows, VACANCY_KEY, [*VACANCY_VALUE_COLS, "key_skills"], sem.on_duplicate)
    return dedup_versions(rows.drop("key_skills"), VACANCY_KEY, VACANCY_VALUE_COLS, sem.on_duplicate).withColumn(
        "key_skills", F.lit(None)
    )


def kept_skill_entries(vacancies: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """Skill entries of the kept versions; same columns as ``skill_entries``."""
    rows = vacancies.select(*VACANCY_KEY, F.explode("key_skills").alias("s")).select(*VACANCY_KEY, F.col("s.name").alias("skill_name"))
    return rows.where(F.col("skill_name").isNotNull()) if sem.drop_null_skills else rows


def skill_entries(staging: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """One row per element of ``key_skills`` (missing or empty list → no row).

    Output: (vacancy_id, dt, query_profession_eng_name, skill_name). A NULL
    name is kept unless ``sem.drop_null_skills``.
    """
    if "v" in staging.columns:
        keep = [variant_field("v", "id").cast("bigint").alias("vacancy_id"), F.col("query_dt").cast("date").alias("dt"), F.col("query_profession_eng_name")]
        found = variants.unnested(staging, "$.key_skills", keep, value="s")
        rows = found.select("vacancy_id", "dt", "query_profession_eng_name", variant_field("s", "name").alias("skill_name"))
        if "d" in staging.columns:  # checked rows: names that do not fit were taken out of ``d``
            rows = rows.where(F.col("skill_name").isNull() | (F.length("skill_name") <= sem.skill_name_len))
        return rows.where(F.col("skill_name").isNotNull()) if sem.drop_null_skills else rows
    d = F.col("d")
    rows = parse_vacancy_documents(staging).select(
        d["id"].cast("bigint").alias("vacancy_id"),
        F.col("query_dt").cast("date").alias("dt"),
        "query_profession_eng_name",
        F.explode(d["key_skills"]).alias("s"),
    ).select("vacancy_id", "dt", "query_profession_eng_name", F.col("s.name").alias("skill_name"))
    if sem.drop_null_skills:
        rows = rows.where(F.col("skill_name").isNotNull())
    return rows


def skill_names(entries: DataFrame) -> DataFrame:
    """Distinct skill names of the entries."""
    return entries.select(F.col("skill_name").alias("name")).distinct()


def rate_records(rate_staging: DataFrame) -> DataFrame:
    """One row per currency entry of each rate document (``Valute`` map)."""
    d = parse_doc("obj", RATES_DOC)
    extra = [c for c in rate_staging.columns if c not in ("obj", "v", "query_dt", "update_ts")]
    if "v" in rate_staging.columns:
        stamp = F.col("update_ts") if "update_ts" in rate_staging.columns else F.lit(None).cast("timestamp_ntz").alias("update_ts")
        keep = [*[F.col(c) for c in extra], variant_field("v", "Date").alias("doc_date"), F.col("query_dt").cast("date").alias("dt"), stamp]
        found = variants.unnested(rate_staging, "$.Valute", keep, key="code_key", value="entry")
        return found.withColumn("v", variants.as_struct("entry", RATE_RECORD)).drop("entry")
    base = rate_staging.select(
        *extra,
        d["Date"].alias("doc_date"),
        F.col("query_dt").cast("date").alias("dt"),
        F.col("update_ts") if "update_ts" in rate_staging.columns else F.lit(None).cast("timestamp_ntz").alias("update_ts"),
        F.explode(d["Valute"]).alias("code_key", "v"),
    )
    return base


def typed_rate_records(records: DataFrame) -> DataFrame:
    """P2 + P3: every typed column of a currency entry, with the source's truncations.

    (exchange_rates_id, num_code, char_code, name, value, previous, nominal,
    published_at, dt, update_ts); values are rounded half up to 4 places and
    the document date keeps its wall-clock time.
    """
    extra = [c for c in records.columns if c not in ("doc_date", "dt", "update_ts", "code_key", "v")]
    return records.select(
        *extra,
        truncate(F.col("v.ID"), 20).alias("exchange_rates_id"),
        truncate(F.col("v.NumCode"), 5).alias("num_code"),
        truncate(F.col("v.CharCode"), 5).alias("char_code"),
        truncate(F.col("v.Name"), 70).alias("name"),
        F.col("v.Value").cast("decimal(10,4)").alias("value"),
        F.col("v.Previous").cast("decimal(10,4)").alias("previous"),
        F.col("v.Nominal").cast("int").alias("nominal"),
        local_timestamp(F.col("doc_date")).alias("published_at"),
        F.col("dt"),
        F.col("update_ts"),
    )


def currency_dimension_rows(records: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """P2 + A9 + Q7: currency dimension rows, one per char_code.

    Output: (exchange_rates_id, num_code, char_code, name).
    """
    rows = typed_rate_records(records).select("exchange_rates_id", "num_code", "char_code", "name", "update_ts")
    return dedup_versions(rows, ["char_code"], ["exchange_rates_id", "num_code", "name"], sem.on_duplicate).select(
        "exchange_rates_id", "num_code", "char_code", "name"
    )


def rate_fact_rows(records: DataFrame) -> DataFrame:
    """(char_code, value, previous, nominal, published_at, dt)."""
    return typed_rate_records(records).select("char_code", "value", "previous", "nominal", "published_at", "dt")

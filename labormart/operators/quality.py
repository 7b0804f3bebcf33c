"""Data-quality audits: the source's declared constraints, checked as jobs.

NOT NULL, unique and primary keys, foreign keys, varchar lengths and
numeric ranges become reports instead of load-time aborts. Each check is one
pass (a single aggregate or one anti/grouped join).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labormart.schemas import METRIC_AVG_COLS, METRIC_KEY, METRIC_MEASURES


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Q-NN: (column_name, n_rows, n_null) for each column, in one aggregate pass."""
    cols = cols or df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(F.col(c).isNull()).alias(f"_n_{i}") for i, c in enumerate(cols)
    ]
    one = df.agg(*aggs)
    stacked = one.select(
        F.col("_rows").alias("n_rows"),
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n_{i}").alias("n_null")) for i, c in enumerate(cols)])
        ).alias("s"),
    )
    return stacked.select("s.column_name", "n_rows", "s.n_null")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q-UQ / Q-PK: key values held by more than one row, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_keys: list[str], parent_keys: list[str] | None = None) -> DataFrame:
    """Q-FK: child rows whose non-null key has no parent row."""
    parent_keys = parent_keys or child_keys
    p = parent.select(*[F.col(pk).alias(ck) for pk, ck in zip(parent_keys, child_keys)]).distinct()
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_keys])
    return child.where(present).join(p, child_keys, "left_anti")


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Q-LEN: per column, values longer than the declared length (column_name, max_len, n_too_long, longest)."""
    aggs = []
    for i, (c, n) in enumerate(limits.items()):
        aggs += [
            F.count_if(F.length(c) > n).alias(f"_n_{i}"),
            F.max(F.length(c)).alias(f"_l_{i}"),
        ]
    one = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(n).alias("max_len"),
            F.col(f"_n_{i}").alias("n_too_long"),
            F.col(f"_l_{i}").cast("int").alias("longest"),
        )
        for i, (c, n) in enumerate(limits.items())
    ]
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def out_of_range(df: DataFrame, col: str, precision: int, scale: int) -> DataFrame:
    """Q-RNG: rows whose value does not fit ``numeric(precision, scale)`` (the load would abort)."""
    c = F.col(col)
    return df.where(c.isNotNull() & c.try_cast(f"decimal({precision},{scale})").isNull())


def audit_summary(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, n_findings) for a dict of finding DataFrames."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_findings")).select(F.lit(name).alias("check"), "n_findings") for name, df in checks.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


# The source's declared constraints, per table of this library's layout.
# fixed values: NOT NULL columns, keys and column lengths are the DDL's
_MART_NAMES = {"city_name": 100, "query_profession_eng_name": 100}
CONSTRAINTS = {
    "stg_vacancies": {"not_null": ["obj", "query_profession_eng_name", "query_dt", "update_ts"], "length": {"query_profession_eng_name": 100}},
    "stg_exchange_rates": {"not_null": ["obj", "query_dt"]},
    "d_city": {"not_null": ["id", "name", "eng_name"], "unique": [["id"]], "length": {"name": 100, "eng_name": 100}},
    "d_query_profession": {"not_null": ["id", "name", "eng_name"], "unique": [["id"], ["eng_name"]], "length": {"name": 100, "eng_name": 100}},
    "d_vacancies": {
        "not_null": ["vacancy_id", "city_id", "query_profession_eng_name"],
        "unique": [["vacancy_id", "dt", "query_profession_eng_name"]],
        "fk": [(["city_id"], "d_city", ["id"]), (["query_profession_eng_name"], "d_query_profession", ["eng_name"])],
        "length": {"profession": 100, "salary_currency": 10, "experience": 20, "schedule": 20},
    },
    "d_skill": {"length": {"name": 150}},
    "fct_skill_vacancy": {
        "not_null": ["vacancy_id", "skill_name", "n_links"],
        "fk": [
            (["vacancy_id", "dt", "query_profession_eng_name"], "d_vacancies", ["vacancy_id", "dt", "query_profession_eng_name"]),
            (["skill_name"], "d_skill", ["name"]),
        ],
    },
    "d_exchange_rates": {
        "not_null": ["exchange_rates_id", "num_code", "char_code", "name"],
        "unique": [["char_code"]],
        "length": {"exchange_rates_id": 20, "num_code": 5, "char_code": 5, "name": 70},
    },
    "fct_exchange_rates": {
        "not_null": ["char_code", "value", "previous", "nominal", "published_at"],
        "fk": [(["char_code"], "d_exchange_rates", ["char_code"])],
    },
    "dm_metrics": {
        "not_null": [*METRIC_KEY, *METRIC_MEASURES],
        "unique": [METRIC_KEY],
        "length": _MART_NAMES,
    },
    "dm_skills": {
        "not_null": ["city_name", "query_profession_eng_name", "skill_name", "dt", "top", "cnt"],
        "unique": [["city_name", "query_profession_eng_name", "skill_name", "dt"]],
        "length": {**_MART_NAMES, "skill_name": 150},
    },
}


def constraints_of(name: str, columns: list[str], constraints: dict | None = None) -> dict:
    """The constraints of a table as it is laid out.

    Where the metrics mart has a grain, it belongs to the key, and an average
    without salaries is NULL by design.
    """
    spec = dict((constraints or CONSTRAINTS).get(name, {}))
    if name == "dm_metrics" and "grain" in columns:
        spec["unique"] = [[*keys, "grain"] for keys in spec.get("unique", [])]
        spec["not_null"] = [c for c in spec.get("not_null", []) if c not in METRIC_AVG_COLS]
    return spec


def audit(tables, names: list[str] | None = None, constraints: dict | None = None) -> DataFrame:
    """Check every declared constraint; one row per (table_name, check, target) with its finding count.

    ``tables`` is any back end with ``get(name)``. NOT NULL and length checks
    are one aggregate pass per table; unique keys are one grouped count;
    foreign keys one anti join each.
    """
    spec = constraints or CONSTRAINTS
    parts: list[DataFrame] = []
    for name in names or list(spec):
        df = tables.get(name)
        c = constraints_of(name, df.columns, spec)
        if c.get("not_null"):
            nn = null_counts(df, c["not_null"])
            parts.append(nn.select(F.lit(name).alias("table_name"), F.lit("not_null").alias("check"),
                                   F.col("column_name").alias("target"), F.col("n_null").alias("n_findings")))
        for keys in c.get("unique", []):
            dup = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("n_findings"))
            parts.append(dup.select(F.lit(name).alias("table_name"), F.lit("unique").alias("check"),
                                    F.lit(",".join(keys)).alias("target"), "n_findings"))
        for child_keys, parent, parent_keys in c.get("fk", []):
            orph = orphans(df, tables.get(parent), child_keys, parent_keys).agg(F.count(F.lit(1)).alias("n_findings"))
            parts.append(orph.select(F.lit(name).alias("table_name"), F.lit("foreign_key").alias("check"),
                                     F.lit(f"{','.join(child_keys)}->{parent}").alias("target"), "n_findings"))
        if c.get("length"):
            ln = too_long(df, c["length"])
            parts.append(ln.select(F.lit(name).alias("table_name"), F.lit("length").alias("check"),
                                   F.col("column_name").alias("target"), F.col("n_too_long").alias("n_findings")))
    return reduce(lambda a, b: a.unionByName(b), parts).withColumn("n_findings", F.col("n_findings").cast("long"))

"""Read queries over the marts and dimensions (the source's HTTP API as functions)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labormart.functions.dates import as_date, to_day

QUERY_NAMES = ("metrics", "skills", "cities", "professions")

# fixed values: default selection of the read API
DEFAULT_CITY = "Москва"
DEFAULT_PROFESSION = "Data engineer"


def _yesterday(as_of: _dt.date | None) -> _dt.date:
    return (as_of or _dt.date.today()) - _dt.timedelta(days=1)


def normalize_params(params: dict) -> dict:
    """P5: datetimes become ``YYYY-MM-DD`` text, other values pass through."""
    return {k: (v.strftime("%Y-%m-%d") if isinstance(v, (_dt.datetime, _dt.date)) else v) for k, v in params.items()}


def _select(
    mart: DataFrame,
    city: str,
    profession: str,
    date_from: str | _dt.date | None,
    date_to: str | _dt.date | None,
    as_of: _dt.date | None,
) -> DataFrame:
    y = _yesterday(as_of)
    lo = as_date(date_from) if date_from is not None else y
    hi = as_date(date_to) if date_to is not None else y
    return mart.where(
        (F.col("city_name") == F.lit(city))
        & (F.col("query_profession_eng_name") == F.lit(profession))
        & (F.col("dt") >= to_day(lo))
        & (F.col("dt") <= to_day(hi))
    )


def get_metrics(
    metrics: DataFrame,
    city: str = DEFAULT_CITY,
    profession: str = DEFAULT_PROFESSION,
    date_from: str | _dt.date | None = None,
    date_to: str | _dt.date | None = None,
    as_of: _dt.date | None = None,
    grain: str = "day",
) -> DataFrame:
    """Mart rows of one city and profession with ``date_from <= dt <= date_to``.

    A mart with a ``grain`` column holds daily and weekly rows side by side; only
    those of ``grain`` ("day" or "week") are read, so no vacancy counts twice.

    Dates default to the day before ``as_of`` (today when not given). On a
    ``dt``-partitioned table the range prunes partitions and the equalities
    reach the Parquet reader as pushed filters.
    """
    if grain not in ("day", "week"):
        raise ValueError("grain must be 'day' or 'week'")
    if "grain" in metrics.columns:
        metrics = metrics.where(F.col("grain") == grain)
    return _select(metrics, city, profession, date_from, date_to, as_of)


def get_skills(
    skills: DataFrame,
    city: str = DEFAULT_CITY,
    profession: str = DEFAULT_PROFESSION,
    date_from: str | _dt.date | None = None,
    date_to: str | _dt.date | None = None,
    as_of: _dt.date | None = None,
) -> DataFrame:
    """Ranking rows of one city and profession in the date range."""
    return _select(skills, city, profession, date_from, date_to, as_of)


def get_cities(cities: DataFrame) -> DataFrame:
    """The whole city dimension."""
    return cities


def get_professions(professions: DataFrame) -> DataFrame:
    """The whole profession dimension."""
    return professions


def query(name: str, tables: dict[str, DataFrame], **params) -> DataFrame:
    """dispatch by query name; anything else raises ValueError."""
    if name == "metrics":
        return get_metrics(tables["dm_metrics"], **params)
    if name == "skills":
        return get_skills(tables["dm_skills"], **params)
    if name == "cities":
        return get_cities(tables["d_city"])
    if name == "professions":
        return get_professions(tables["d_query_profession"])
    raise ValueError("The query value must be metrics, skills, cities, professions.")


def check_window(date_from: _dt.date, date_to: _dt.date, earliest: _dt.date = _dt.date(2024, 6, 1), today: _dt.date | None = None) -> None:
    """a dashboard window needs ``earliest <= date_from < date_to <= today``."""
    today = today or _dt.date.today()
    if not (earliest <= date_from <= today and earliest <= date_to <= today):
        raise ValueError(f"dates must lie between {earliest.isoformat()} and {today.isoformat()}")
    if not date_to > date_from:
        raise ValueError("date_to must be later than date_from")


def to_records(df: DataFrame) -> DataFrame:
    """SNK7: rows as JSON records; decimals as text like the source's responses."""
    cols = [F.col(c).cast("string").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes]
    return df.select(F.to_json(F.struct(*cols)).alias("record"))


def read_records(spark, path: str, schema) -> DataFrame:
    """SRC7: exported JSON records back into a DataFrame, typed by an explicit schema."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)

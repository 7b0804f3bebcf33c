"""Dimension sources: the delimited city file and the profession seed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.schemas import D_CITY, D_QUERY_PROFESSION

# fixed values: profession seed rows (id, local name, English name)
PROFESSION_SEED = [
    (1, "Инженер данных", "Data engineer"),
    (2, "Аналитик данных", "Data analyst"),
    (3, "Специалист по данным", "Data scientist"),
]


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: ``id|name|eng_name`` with a header line, UTF-8, explicit schema."""
    return (
        spark.read.schema(D_CITY)
        .option("sep", "|")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def seed_professions(spark: SparkSession) -> DataFrame:
    """SRC4: the three seeded professions."""
    return spark.createDataFrame(PROFESSION_SEED, D_QUERY_PROFESSION)


def city_lookup(cities: DataFrame) -> DataFrame:
    """Name → id lookup (used to turn a chosen city name into its code)."""
    return cities.select(F.col("name").alias("city_name"), F.col("id").alias("city_id"), "eng_name")

"""X3-X5 on VARIANT: documents parsed once into Spark's binary JSON type.

A staged document becomes the column ``v``. Fields are read from it without
parsing text again, arrays and objects are unnested by the lateral table
function ``variant_explode``, and a written copy stays VARIANT in Parquet. The
readers in :mod:`labormart.operators.parse` and
:mod:`labormart.operators.quarantine` take ``v`` where it is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_variant(staging: DataFrame, col: str = "obj") -> DataFrame:
    """``staging`` with ``v``: the document as VARIANT, NULL where the text is not one well-formed value.

    The parser stops at the end of a value; as the only element of an array the
    text must also end there.
    """
    alone = F.try_parse_json(F.concat(F.lit("["), F.col(col), F.lit("]")))
    first, second = (F.try_variant_get("_alone", f"$[{i}]", "variant") for i in (0, 1))
    return staging.withColumn("_alone", alone).withColumn("v", F.when(second.isNull(), first)).drop("_alone")


def is_object(v: Column | str = "v") -> Column:
    """True for one JSON object, the only kind of document that is staged: nothing else casts to a struct."""
    return F.try_variant_get(v, "$", "struct<_:boolean>").isNotNull()


def as_struct(v: Column | str, schema: T.DataType) -> Column:
    """The document as a struct with text leaves, like ``->>``; what is missing or of another shape is NULL.

    One cast of the whole value: a path per field would read the document once for each.
    """
    return F.try_variant_get(v, "$", schema.simpleString())


def unnested(rows: DataFrame, path: str, keep: list[Column], key: str = "key", value: str = "value", v: str = "v") -> DataFrame:
    """One row per element of the array, or field of the object, at ``path``; none if it is missing or empty.

    ``key`` is the field's name (NULL for an array), ``value`` a VARIANT. ``keep``
    is read once per document, which does not go on with its elements.
    """
    kept = rows.select(*keep, F.try_variant_get(F.col(v), path, "variant").alias("_inner"))
    joined = kept.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("_inner").outer()))
    return joined.select(*kept.columns[:-1], F.col("key").alias(key), F.col("value").alias(value))

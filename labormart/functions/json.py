"""JSON document access.

Documents arrive as text. They are parsed once with an explicit schema whose
leaves are all STRING; typed columns are cast afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_doc(col: Column | str, schema: T.DataType) -> Column:
    """Parse JSON text into a struct/map. Malformed text yields NULL (PERMISSIVE)."""
    return F.from_json(_c(col), schema)


def has_key(col: Column | str, key: str) -> Column:
    """True when the top-level object has ``key``, whatever its value (null included)."""
    return F.coalesce(F.array_contains(F.json_object_keys(_c(col)), F.lit(key)), F.lit(False))


def json_field(col: Column | str, path: str) -> Column:
    """Field as text (``->>``); a missing field or parent gives NULL."""
    return F.get_json_object(_c(col), path if path.startswith("$") else f"$.{path}")


def as_variant(col: Column | str) -> Column:
    """JSON text → VARIANT (parsed once, binary-encoded; fields are read without re-parsing)."""
    return F.parse_json(_c(col))


def variant_field(variant: Column | str, path: str, type_name: str = "string") -> Column:
    """A field of a VARIANT as ``type_name`` (a number read as string gives its text, like ``->>``)."""
    p = path if path.startswith("$") else f"$.{path}"
    return F.try_variant_get(_c(variant), p, type_name)

"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncate(col: Column | str, n: int) -> Column:
    """``::varchar(n)``: keep the first ``n`` characters (Spark's varchar cast does not cut)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.left(c, F.lit(n))

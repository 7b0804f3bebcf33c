"""Column-level building blocks (all JVM-side expressions, no UDFs)."""

from labormart.functions.dates import (
    caption_date,
    day_spine,
    local_timestamp,
    prev_day,
    to_day,
    week_start,
)
from labormart.functions.json import has_key, json_field, parse_doc
from labormart.functions.salary import exact_avg, money, salary_midpoint
from labormart.functions.text import truncate

__all__ = [
    "caption_date",
    "day_spine",
    "local_timestamp",
    "prev_day",
    "to_day",
    "week_start",
    "has_key",
    "json_field",
    "parse_doc",
    "exact_avg",
    "money",
    "salary_midpoint",
    "truncate",
]

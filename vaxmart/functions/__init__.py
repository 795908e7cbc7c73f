"""Column-level building blocks (all JVM-side built-in expressions)."""

from vaxmart.functions.categories import VACCINE_TYPE_RULES, normalize_category
from vaxmart.functions.keys import surrogate_key
from vaxmart.functions.temporal import (
    calendar_fields,
    is_month_end,
    load_mode,
    week_start,
    weeks_between,
    year_month,
)

__all__ = [
    "VACCINE_TYPE_RULES",
    "calendar_fields",
    "is_month_end",
    "load_mode",
    "normalize_category",
    "surrogate_key",
    "week_start",
    "weeks_between",
    "year_month",
]

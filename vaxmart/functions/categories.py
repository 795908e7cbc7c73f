"""Rule-based normalisation of free-text categories (searched CASE)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: vaccine type rules, (label, substrings of lower(name)) --
# First matching rule wins; names matching none keep their original text.
VACCINE_TYPE_RULES: list[tuple[str, list[str]]] = [
    ("Coronavac", ["butantan"]),
    ("AstraZeneca", ["astrazeneca", "covishield"]),
    ("Pfizer", ["pfizer"]),
    ("Janssen", ["janssen"]),
]


def normalize_category(
    col: str | Column, rules: Sequence[tuple[str, Sequence[str]]] = VACCINE_TYPE_RULES
) -> Column:
    """Chained ``when`` over ``lower(col)``: first rule with a matching substring wins."""
    source = F.col(col) if isinstance(col, str) else col
    lowered = F.lower(source)
    expr = None
    for label, needles in rules:
        cond = None
        for needle in needles:
            hit = lowered.contains(needle)
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return source if expr is None else expr.otherwise(source)

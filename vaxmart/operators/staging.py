"""Typed staging layer: rename, cast and add hashed surrogate keys.

Narrow transformations only (one projection), so staging is a single
map-side stage: no shuffle, and whole-stage codegen covers it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaxmart.functions.keys import surrogate_key
from vaxmart.schemas import STAGING_COLUMNS, SURROGATE_KEYS

REJECT_REASON = "_reject_reason"


def rename_and_cast(
    raw: DataFrame,
    mapping: Sequence[tuple[str, str, str | None]] = STAGING_COLUMNS,
    strict: bool = True,
) -> DataFrame:
    """Rename raw columns to staging names and cast the typed ones.

    ``strict=True`` uses ANSI casts (a bad value fails the job, as the
    warehouse does). ``strict=False`` uses ``try_cast``: bad values become
    null; pair it with :func:`cast_rejects` to quarantine those rows.
    """
    out = []
    for src, dst, to in mapping:
        c = F.col(src)
        if to is not None:
            c = c.cast(to) if strict else c.try_cast(to)
        out.append(c.alias(dst))
    return raw.select(*out)


def reject_reason(mapping: Sequence[tuple[str, str, str | None]] = STAGING_COLUMNS):
    """Column naming the first raw column whose non-null value does not cast (else null)."""
    reason = None
    for src, _dst, to in mapping:
        if to is None:
            continue
        bad = F.col(src).isNotNull() & F.col(src).try_cast(to).isNull()
        reason = F.when(bad, F.lit(src)) if reason is None else reason.when(bad, F.lit(src))
    return reason if reason is not None else F.lit(None).cast("string")


def cast_rejects(raw: DataFrame, mapping: Sequence[tuple[str, str, str | None]] = STAGING_COLUMNS) -> DataFrame:
    """Raw rows with at least one non-null value that does not cast.

    Adds ``_reject_reason`` naming the first failing column. One filter over
    the raw rows; no shuffle.
    """
    return raw.withColumn(REJECT_REASON, reject_reason(mapping)).where(F.col(REJECT_REASON).isNotNull())


def add_surrogate_keys(
    staged: DataFrame, keys: Sequence[tuple[str, Sequence[str]]] = SURROGATE_KEYS, separator: str = ""
) -> DataFrame:
    """Prepend one MD5 key column per ``(name, columns)`` entry."""
    return staged.select(*[surrogate_key(*cols, separator=separator).alias(name) for name, cols in keys], "*")


def build_staging(
    raw: DataFrame, strict: bool = True, separator: str = "", normalized_type: bool = False
) -> DataFrame:
    """staging_vaccinations: 5 surrogate keys + 38 renamed/typed columns.

    ``normalized_type=True`` appends ``vaccine_normalized_type`` (the vaccine
    type rules applied once at load time instead of in every analysis).
    """
    staged = add_surrogate_keys(rename_and_cast(raw, strict=strict), separator=separator)
    if normalized_type:
        from vaxmart.functions.categories import normalize_category

        staged = staged.withColumn("vaccine_normalized_type", normalize_category("vaccine_type_name"))
    return staged

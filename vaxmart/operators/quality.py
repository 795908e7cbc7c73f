"""Data-quality checks that return a report DataFrame.

Every check is an aggregate that yields one row ``(check, observed,
expected, passed)``; :func:`run_checks` unions them into one report and
:func:`assert_report` raises on failures. Only the report (one row per
check) is ever brought to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaxmart.schemas import CONTRACT_NULLABLE, CONTRACT_TYPES
from vaxmart.sources.tables import short_keys

REPORT_COLUMNS = ["check", "observed", "expected", "passed"]
BLANK_KEY = "d41d8cd98f00b204e9800998ecf8427e"  # md5('') = key of a missing id


class DataQualityError(AssertionError):
    pass


def _report_row(check: str, observed: DataFrame, expected: int) -> DataFrame:
    """Turn a one-row, one-column aggregate into a report row."""
    value = F.col(observed.columns[0]).cast("long")
    return observed.select(
        F.lit(check).alias("check"),
        value.alias("observed"),
        F.lit(expected).cast("long").alias("expected"),
        (value == F.lit(expected)).alias("passed"),
    )


_WIDE_TYPES = (T.StringType, T.BinaryType)


def duplicate_groups(df: DataFrame, keys: Sequence[str], prehash: bool | None = None) -> DataFrame:
    """Keys that occur more than once, with their count (HAVING count(*) > 1).

    ``prehash`` (default: when a key is a string or binary column) first
    groups a 64-bit hash of the keys — the shuffle then carries 8 bytes per
    row instead of e.g. a 32-character MD5 — and re-checks only the hash
    values seen more than once on the real keys. The result is exact: hash
    collisions are resolved in the second step, which reads the key columns
    again but shuffles only rows of candidate hashes (few when the keys are
    unique, which is what the check expects).
    """
    if prehash is None:
        types = {f.name: f.dataType for f in df.schema.fields}
        prehash = any(isinstance(types[k], _WIDE_TYPES) for k in keys)
    counted = F.count(F.lit(1)).alias("n")
    if not prehash:
        return df.groupBy(*keys).agg(counted).where(F.col("n") > 1)
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_h"))
    candidates = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1).select("_h")
    # Where the join is a shuffle, or is planned as one before the candidates are seen to be few, all keys cross it.
    return (
        short_keys(hashed, lambda rows, _: rows.join(candidates, "_h", "left_semi"))
        .groupBy(*keys)
        .agg(counted)
        .where(F.col("n") > 1)
    )


def check_unique(df: DataFrame, keys: str | Sequence[str], name: str | None = None, expected: int = 0) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    observed = duplicate_groups(df, keys).agg(F.count(F.lit(1)).alias("n"))
    return _report_row(name or f"unique:{','.join(keys)}", observed, expected)


def check_not_null(df: DataFrame, key: str, name: str | None = None, expected: int = 0) -> DataFrame:
    """Number of groups whose key is null (0 or 1), as GROUP BY ... HAVING key IS NULL."""
    observed = df.where(F.col(key).isNull()).agg(
        F.when(F.count(F.lit(1)) > 0, F.lit(1)).otherwise(F.lit(0)).alias("n")
    )
    return _report_row(name or f"not_null:{key}", observed, expected)


def check_no_blank_key(df: DataFrame, key: str, name: str | None = None, expected: int = 0) -> DataFrame:
    """Rows whose hashed key is the hash of an empty input (all parts missing)."""
    observed = df.agg(F.count_if(F.col(key) == F.lit(BLANK_KEY)).alias("n"))
    return _report_row(name or f"no_blank_key:{key}", observed, expected)


def distinct_through_join(fact: DataFrame, dim: DataFrame, key: str, attribute: str) -> DataFrame:
    """Distinct ``attribute`` values of ``dim`` reached from ``fact`` over ``key``.

    The fact's keys are de-duplicated first (partial aggregate map-side), so
    the join sees one row per key, not one row per fact row. Nulls count as
    one value, like SELECT DISTINCT.
    """
    keys = fact.select(key).distinct()
    return keys.join(dim.select(key, attribute), key).select(attribute).distinct()


def check_distinct_count(
    fact: DataFrame, dim: DataFrame, key: str, attribute: str, expected: int, name: str | None = None
) -> DataFrame:
    observed = distinct_through_join(fact, dim, key, attribute).agg(F.count(F.lit(1)).alias("n"))
    return _report_row(name or f"distinct_count:{attribute}", observed, expected)


def check_fact(
    fact: DataFrame, dim: DataFrame, key: str, dim_key: str, attribute: str, expected: int, prefix: str = "fact"
) -> DataFrame:
    """The three checks of a fact (``key`` unique, ``key`` never null, number of distinct ``attribute`` values reached
    through ``dim_key``) from one scan of it.

    One Expand gives each row twice, to the groups of ``key`` and to those of ``dim_key``; both are counted map-side.
    The groups of ``dim_key``, few, meet the dimension's unique keys, and one aggregate reads all three results."""
    keys = fact.select(F.col(key).alias("_key"), F.col(dim_key).alias("_dim"))
    groups = keys.groupingSets([["_key"], ["_dim"]], "_key", "_dim").agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"))
    by_key = F.col("_set") == 1  # the second column is rolled up
    # The groups of the key, as many as the fact has rows, have no value to join on and would all meet in one task: each
    # task sums up its own before anything is dealt by ``dim_key``.
    few = groups.groupBy("_set", "_dim").agg(
        F.count_if(by_key & (F.col("_n") > 1)).alias("_repeated"),
        F.max(F.when(by_key & F.col("_key").isNull(), 1).otherwise(0)).alias("_null"))
    reached = dim.select(F.col(dim_key).alias("_reached"), F.col(attribute).alias("_value"), F.lit(True).alias("_found"))
    joined = few.join(reached, ~by_key & (F.col("_dim") == F.col("_reached")), "left")
    found = ~by_key & F.col("_found")
    counts = joined.agg(
        F.sum("_repeated").alias("unique"),
        F.max("_null").alias("nulls"),
        (F.count_distinct(F.when(found, F.col("_value"))) + F.coalesce(F.max(F.when(found & F.col("_value").isNull(), 1)), F.lit(0))).alias("values"))
    row = lambda name, value, want: F.struct(
        F.lit(name).alias("check"), F.coalesce(value, F.lit(0)).cast("long").alias("observed"), F.lit(want).cast("long").alias("expected"))
    rows = F.array(row(f"{prefix}_unique_{key}", F.col("unique"), 0), row(f"{prefix}_not_null_{key}", F.col("nulls"), 0),
                   row(f"{prefix}_distinct_{attribute}", F.col("values"), expected))
    return counts.select(F.inline(rows)).withColumn("passed", F.col("observed") == F.col("expected"))


def check_scalar(df: DataFrame, expected, message: str | None = None):
    """First cell of ``df`` must equal ``expected``; raise otherwise.

    ``df`` is expected to be an aggregate (one small row)."""
    row = df.first()
    result = None if row is None else row[0]
    if result != expected:
        raise DataQualityError(message or f"Expected {expected} but got {result}")
    return result


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    report = checks[0]
    for c in checks[1:]:
        report = report.unionByName(c)
    return report


def assert_report(report: DataFrame) -> list:
    rows = report.collect()  # one row per check
    failed = [r for r in rows if not r["passed"]]
    if failed:
        detail = "; ".join(f"{r['check']}: expected {r['expected']} got {r['observed']}" for r in failed)
        raise DataQualityError(f"{len(failed)} data-quality check(s) failed: {detail}")
    return rows


def _mistyped(df: DataFrame, contract_types: dict[str, str]) -> list[str]:
    simple = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    alias = {"integer": "int", "long": "bigint"}
    return [c for c, t in contract_types.items() if c in simple and simple[c] != alias.get(t, t)]


def contract_report(
    df: DataFrame,
    contract_types: dict[str, str] = CONTRACT_TYPES,
    nullable: set[str] = CONTRACT_NULLABLE,
) -> DataFrame:
    """One row per contract field and per extra column of ``df``.

    Columns: column_name, declared_type, declared_nullable, present,
    null_count, passed. All null counts come from a single aggregate pass.
    A column of another type than declared does not pass.
    """
    mistyped = _mistyped(df, contract_types)
    present = [c for c in contract_types if c in df.columns]
    extra = [c for c in df.columns if c not in contract_types]
    counted = present + extra
    if counted:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(counted)])
    else:
        counts = df.agg(F.count(F.lit(1)).alias("_rows"))

    entries: list[Column] = []
    for c, t in contract_types.items():
        n = F.col(f"n{counted.index(c)}") if c in present else F.lit(None).cast("long")
        entries.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(t).alias("declared_type"),
                F.lit(c in nullable).alias("declared_nullable"),
                F.lit(c in present).alias("present"),
                n.cast("long").alias("null_count"),
            )
        )
    for c in extra:
        entries.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(None).cast("string").alias("declared_type"),
                F.lit(None).cast("boolean").alias("declared_nullable"),
                F.lit(True).alias("present"),
                F.col(f"n{counted.index(c)}").cast("long").alias("null_count"),
            )
        )
    rows = counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    passed = (
        F.col("present")
        & ~F.col("column_name").isin(mistyped)
        & F.col("declared_type").isNotNull()
        & (F.col("declared_nullable") | (F.col("null_count") == 0))
    )
    return rows.withColumn("passed", F.coalesce(passed, F.lit(False)))


def conform_to_contract(df: DataFrame, contract_types: dict[str, str] = CONTRACT_TYPES) -> DataFrame:
    """Select the contract's columns in contract order (extra columns dropped);
    raise if a contract column is missing or has another type than declared.
    A projection: no data is read."""
    missing = [c for c in contract_types if c not in df.columns]
    if missing:
        raise DataQualityError(f"missing contract columns: {', '.join(missing)}")
    mistyped = _mistyped(df, contract_types)
    if mistyped:
        raise DataQualityError(f"contract columns of another type: {', '.join(mistyped)}")
    return df.select(*contract_types)

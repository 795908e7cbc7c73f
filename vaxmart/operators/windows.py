"""Window building blocks: running total, row-based moving average, percent of max.

Callers aggregate to one row per (partition, order) key first, so the window
partitions hold one row per day per group, not one row per event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ordered(partition_by: Sequence[str], order_by: str):
    return Window.partitionBy(*partition_by).orderBy(F.col(order_by).asc_nulls_last())


def running_total(
    df: DataFrame, partition_by: Sequence[str], order_by: str, value: str, out: str, as_double: bool = False
) -> DataFrame:
    """Add ``out`` = sum of ``value`` from the first row of the partition to the current row."""
    w = _ordered(partition_by, order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum(value).over(w)
    return df.withColumn(out, total.cast("double") if as_double else total)


def moving_average(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: str,
    value: str,
    out: str,
    n_rows: int = 30,
    round_digits: int | None = None,
) -> DataFrame:
    """Add ``out`` = average of ``value`` over the current row and the ``n_rows - 1`` rows before it.

    A row frame: missing days are not filled and the first rows of each
    partition average fewer values. ``round_digits`` rounds the result
    (double sums differ in the last bits between engines).
    """
    w = _ordered(partition_by, order_by).rowsBetween(-(n_rows - 1), Window.currentRow)
    avg: Column = F.avg(value).over(w)
    if round_digits is not None:
        avg = F.round(avg, round_digits)
    return df.withColumn(out, avg)


def percent_of_max(df: DataFrame, value: str, out: str = "pct_of_total", digits: int = 2) -> DataFrame:
    """Add ``out`` = round(100 * value / max(value) over the whole input, digits).

    The maximum is a scalar subquery (computed once by a partial + final
    aggregate, then inlined as a value), so no single-partition window and no
    join with the one-row maximum are needed.
    """
    peak = df.select(F.max(value)).scalar()
    ratio = F.try_divide(F.col(value).cast("double"), peak.cast("double"))
    return df.withColumn(out, F.round(100 * ratio, digits))

"""What a large job keeps on disk at a time: shuffles given back after each job, and jobs that take their rows in passes.

Spark holds the files of a shuffle until the driver's garbage collector finds that nothing refers to them any more, and
those of all joins of one job until its end.  Here a write gives its shuffles back when it ends, and a table that is
larger than ``PASS_BYTES`` is written in up to ``MOST_PASSES`` jobs, each over the rows of some keys or of a range: every
row is in exactly one of them.  The number of passes is bounded, so the input is read a fixed number of times at most."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of the files read for each pass, and passes at most: fewer rows at a time would leave cores without work and make
# more, smaller files.
PASS_BYTES = 256 << 20
MOST_PASSES = 4

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Spark takes so many bytes for inputs of which it knows no size.
_UNKNOWN = 1 << 62


@contextmanager
def released_shuffles(*sessions: SparkSession) -> Iterator[None]:
    """Queries that are made and run in it remove their shuffle files when they end (one that runs again makes them again)."""
    before = [(s, s.conf.get(_CLEANUP, None)) for s in sessions]
    for s in sessions:
        s.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        for s, value in reversed(before):
            s.conf.unset(_CLEANUP) if value is None else s.conf.set(_CLEANUP, value)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the inputs of a plan as Spark knows them, all columns counted; 0 where one of them is not known."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return 0 if any(n >= _UNKNOWN for n in sizes) else sum(sizes)


def pass_count(df: DataFrame) -> int:
    return max(1, min(MOST_PASSES, math.ceil(input_bytes(df) / PASS_BYTES)))


def hash_passes(df: DataFrame, by: Sequence[str]) -> list[DataFrame]:
    """The rows in parts, those with the same values of ``by`` in one; all in one part without ``by``.

    ``df`` is evaluated once for each part and must give the same rows each time.  A filter on columns of one table goes
    below its joins, and from a join's key to the other side, so each part joins its own rows only."""
    n = pass_count(df) if by else 1
    part = F.pmod(F.xxhash64(*by), F.lit(n)) if n > 1 else None
    return [df] if part is None else [df.where(part == i) for i in range(n)]


def range_passes(df: DataFrame, column: str) -> list[DataFrame]:
    """The rows in parts of about one size, in the order of ``column`` (a number, date or time; nulls first)."""
    n = pass_count(df)
    if n == 1:
        return [df]
    c = F.col(column)
    found = df.agg(F.min(c).alias("low"), F.percentile_approx(c, [i / n for i in range(1, n)]).alias("cuts")).first()
    cuts = sorted({v for v in found["cuts"] or [] if v > found["low"]})
    if not cuts:
        return [df]
    inner = [df.where((c >= F.lit(a)) & (c < F.lit(b))) for a, b in zip(cuts, cuts[1:])]
    return [df.where(c.isNull() | (c < F.lit(cuts[0]))), *inner, df.where(c >= F.lit(cuts[-1]))]

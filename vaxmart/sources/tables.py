"""Table sinks on Parquet paths: create, load-if-empty, rebuild, land, layout.

Tables are Parquet directories. Overwrites of partitioned tables use
dynamic partition overwrite (set by the session), so only partitions that
receive rows are replaced, and only when the write job commits.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaxmart.schemas import LANDING_PARTITIONS, SURROGATE_KEYS
from vaxmart.sources.blocks import in_blocks
from vaxmart.sources.passes import hash_passes, released_shuffles


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema  # noqa: B018 - listing only
        return True
    except AnalysisException:
        return False


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS: write an empty table with ``schema`` when
    the path is absent (``mode("ignore")``). Returned with ``schema``, since an
    empty partitioned table has no data file to infer it from."""
    writer = spark.createDataFrame([], schema).write.mode("ignore")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def is_empty(spark: SparkSession, path: str, schema: T.StructType | None = None) -> bool:
    if schema is not None:
        try:
            return spark.read.schema(schema).parquet(path).isEmpty()
        except AnalysisException:
            return True
    return (not table_exists(spark, path)) or spark.read.parquet(path).isEmpty()


def load_if_empty(spark: SparkSession, path: str, df: DataFrame, partition_by: Sequence[str] = ()) -> bool:
    """Load ``df`` into the table at ``path`` only if the table has no rows.

    Returns True when it loaded. (A table that is never emptied is loaded
    only once; use :func:`vaxmart.operators.merge.write_merge` for increments.)
    """
    if not is_empty(spark, path):
        return False
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return True


def write_layout(
    df: DataFrame,
    distribute_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    range_by: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Physical layout before a write.

    ``distribute_by`` hash-partitions on a key (a distribution key);
    ``range_by`` range-partitions (an ordered layout, so Parquet row-group
    min/max statistics prune well); ``sort_by`` sorts within each partition
    (a sort key). A replicated small table needs nothing here: it is
    broadcast at join time.
    """
    out = df
    if range_by:
        out = short_keys(df, lambda rows, at: rows.repartitionByRange(*[num_partitions] * bool(num_partitions), *map(at, range_by)))
    elif distribute_by:
        out = out.repartition(num_partitions, *distribute_by) if num_partitions else out.repartition(*distribute_by)
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    return out


# --- rows as they cross a shuffle ---------------------------------------------

# Texts of a row that has at least so many of them cross a shuffle as one line.
MANY_TEXTS = 8
_SEPARATOR, _NULL = "\x1f", "\x1e"


def short_keys(df: DataFrame, exchange: Callable[[DataFrame, Callable[[str], Column]], DataFrame]) -> DataFrame:
    """``exchange`` over rows whose MD5 keys are 16 bytes instead of 32 digits, which a shuffle cannot compress.

    ``exchange`` gets the rows and a function from a column's name to its value in them. Keys that are no such
    digits stay text, so every value comes back as it was."""
    kinds = dict(df.dtypes)
    keys = [k for k, _ in SURROGATE_KEYS if kinds.get(k) == "string"]

    def value(name: str) -> Column:
        return F.coalesce(F.lower(F.hex(F.col(f"_b_{name}"))), F.col(f"_t_{name}")) if name in keys else F.col(name)

    def digits(k: str) -> Column:
        return F.col(k).rlike("^[0-9a-f]{32}\\z")

    rest = [F.col(quoted_name(c)) for c in df.columns if c not in keys]
    short = [F.when(digits(k), F.unhex(k)).alias(f"_b_{k}") for k in keys]
    other = [F.when(~digits(k), F.col(k)).alias(f"_t_{k}") for k in keys]
    moved = exchange(df.select(*rest, *short, *other) if keys else df, value)
    return moved.select(*[value(c).alias(c) if c in keys else F.col(quoted_name(c)) for c in df.columns]) if keys else moved


def quoted_name(column: str) -> str:
    return f"`{column.replace('`', '``')}`"


def one_line(df: DataFrame, keep: Sequence[str], exchange: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``exchange`` over rows whose many texts are one line: their offsets and padding take more than half of a wide
    row and differ from row to row, so the shuffle's compression keeps them.

    Rows with a text that holds the separator or the mark of a null cross as hex digits; every value comes back as
    it was. Columns of ``keep`` stay columns for ``exchange`` to deal by; those it adds are kept."""
    texts = [c for c, kind in df.dtypes if kind == "string" and c not in keep]
    if len(texts) < MANY_TEXTS:
        return exchange(df)
    column = {c: F.col(quoted_name(c)) for c in df.columns}
    values = [column[c] for c in texts]
    together = F.concat_ws("", *values)
    odd = together.contains(_SEPARATOR) | together.contains(_NULL)
    line = F.concat_ws(_SEPARATOR, *[F.coalesce(v, F.lit(_NULL)) for v in values])
    digits = F.concat_ws(_SEPARATOR, *[F.coalesce(F.hex(v), F.lit(_NULL)) for v in values])
    lines = df.select(*[column[c] for c in df.columns if c not in texts],
                      F.when(~odd, line).alias("_line"), F.when(odd, digits).alias("_digits"))
    moved = exchange(lines)
    parts = F.transform(F.split("_line", _SEPARATOR, -1), lambda v: F.nullif(v, F.lit(_NULL)))
    bytes_of = F.transform(F.split("_digits", _SEPARATOR, -1), lambda v: F.unhex(F.nullif(v, F.lit(_NULL))).cast("string"))
    back = moved.withColumn("_texts", F.coalesce(bytes_of, parts))
    at = {c: F.get("_texts", F.lit(i)).alias(c) for i, c in enumerate(texts)}
    added = [F.col(quoted_name(c)) for c in moved.columns if c not in lines.columns]
    return back.select(*[at.get(c, column[c]) for c in df.columns], *added)


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Shuffle rows by the output partition columns with the ``rebalance``
    hint before a partitioned write: AQE merges small shuffle partitions and
    splits skewed ones, so each output directory gets few, evenly sized
    files, and a partition holding a third of the rows is written by many
    tasks, not one. The texts of wide rows cross the shuffle as one line."""
    return one_line(df, partition_by, lambda rows: rows.hint("rebalance", *partition_by)) if partition_by else df


def rebalanced_in_blocks(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """:func:`rebalanced`, the lines of wide rows in compressed blocks of one output partition each."""

    def deal(rows: DataFrame) -> DataFrame:
        return rows.hint("rebalance", *partition_by)

    return one_line(df, partition_by, lambda rows: in_blocks(rows, partition_by, deal) if "_line" in rows.columns else deal(rows))


def rebuild_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), dealt: bool = False, more: bool = False) -> None:
    """DROP + CREATE TABLE AS: replace the whole table at ``path``. ``dealt``: its rows already are, by ``partition_by``;
    ``more``: a further pass of a table (see :mod:`vaxmart.sources.passes`), whose rows are added."""
    with released_shuffles(df.sparkSession):
        writer = (df if dealt else rebalanced(df, partition_by)).write.mode("append" if more else "overwrite")
        # Half the size of Spark's default codec on keys that are digests.
        writer = writer.option("partitionOverwriteMode", "static").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)


IN_FILE_SUFFIX = "_value"

# Landing files that a task writes at a time; rows of further partition folders are sorted and written after them.
OPEN_FILES = 64


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Writes in it keep up to ``OPEN_FILES`` files open instead of sorting a task's wide rows by folder: blocks bring
    more rows into a task, and the sort would hold them all. For landing files only, whose writers hold little."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def land_partitioned(
    df: DataFrame,
    base: str,
    mode: str = "append",
    partition_by: Sequence[str] = LANDING_PARTITIONS,
    compression: str = "gzip",
    max_records_per_file: int | None = None,
    passes_by: Sequence[str] = (),
) -> None:
    """Write gzip CSV landing files under ``base/<p1>=v/<p2>=v/``.

    The partition columns stay inside the files too, at their positions
    (the files are read positionally, so only the header names of those two
    columns differ: they carry a ``_value`` suffix). ``mode='append'`` adds
    files; ``mode='replace'`` replaces exactly the partitions present in
    ``df``, on job commit, so a failed run leaves the old files in place.
    Values come back as they were, blanks at their ends included; only an
    empty text reads back as null, since the format does not tell them apart.

    ``passes_by``: a large input is appended in passes, each the rows of some
    values of these columns, so that the shuffles of one pass only are on disk
    at a time. Each pass commits for itself: land in a new ``base``.
    """
    if mode not in ("append", "replace"):
        raise ValueError("mode must be 'append' or 'replace'")
    if passes_by and mode != "append":
        raise ValueError("passes add files; a later one would replace folders of those before")
    for rows in hash_passes(df, passes_by):
        with released_shuffles(df.sparkSession), open_files(df.sparkSession):
            _land(rows, base, mode, partition_by, compression, max_records_per_file)


def _land(
    df: DataFrame, base: str, mode: str, partition_by: Sequence[str], compression: str, max_records_per_file: int | None
) -> None:
    data_cols = [F.col(c).alias(c + IN_FILE_SUFFIX) if c in partition_by else F.col(c) for c in df.columns]
    out = rebalanced_in_blocks(df.select(*data_cols, *[F.col(p) for p in partition_by]), partition_by)
    writer = _landing_writer(out, partition_by, compression, max_records_per_file)
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.csv(base)


def land_run(
    df: DataFrame,
    base: str,
    until: dt.date,
    mode: str,
    states: Sequence[str] | None = None,
    partition_by: Sequence[str] = LANDING_PARTITIONS,
    compression: str = "gzip",
) -> None:
    """Land the rows of the run of ``until`` under the month of that date,
    whatever month the rows name: ``base/<month>/<state>/run_until=<until>/``.

    ``append`` replaces the run's own folders only, so a run that is repeated
    after a crash lands its rows once. ``replace`` first empties the month, of
    the given states or of all, also where the run has no rows; a crash in
    between leaves the month to the next run.
    """
    month_col, state_col = partition_by
    month = f"{until:%Y-%m}-01"
    data_cols = [F.col(c).alias(c + IN_FILE_SUFFIX) if c in partition_by else F.col(c) for c in df.columns]
    out = df.select(*data_cols, F.lit(month).alias(month_col), F.col(state_col), F.lit(str(until)).alias("run_until"))
    if mode == "append":
        dirs = [month_col, state_col, "run_until"]
        writer = _landing_writer(rebalanced_in_blocks(out, dirs), dirs, compression).mode("overwrite")
        with open_files(df.sparkSession):
            writer.option("partitionOverwriteMode", "dynamic").csv(base)
        return
    folder = f"{base.rstrip('/')}/{month_col}={month}"
    whole = [(out.drop(month_col), folder, [state_col, "run_until"])]
    for rows, path, dirs in whole if states is None else [
        (out.where(F.col(state_col) == s).drop(month_col, state_col), f"{folder}/{state_col}={s}", ["run_until"]) for s in states
    ]:
        writer = _landing_writer(rebalanced_in_blocks(rows, dirs), dirs, compression).mode("overwrite")
        with open_files(df.sparkSession):
            writer.option("partitionOverwriteMode", "static").csv(path)


def csv_landing_writer(
    df: DataFrame, partition_by: Sequence[str], folder: Mapping[str, str] | None = None, compression: str = "gzip"
) -> DataFrameWriter:
    """Writer of landing files (see :func:`land_partitioned`); ``folder`` gives fixed values for partition folders."""
    fixed = folder or {}
    data_cols = [F.col(c).alias(c + IN_FILE_SUFFIX) if c in partition_by else F.col(c) for c in df.columns]
    dirs = [F.lit(fixed[p]).alias(p) if p in fixed else F.col(p) for p in partition_by]
    return _landing_writer(rebalanced_in_blocks(df.select(*data_cols, *dirs), partition_by), partition_by, compression)


def _landing_writer(
    out: DataFrame, partition_by: Sequence[str], compression: str, max_records_per_file: int | None = None
) -> DataFrameWriter:
    writer = (
        out.write.partitionBy(*partition_by)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("compression", compression)
        # Spark's CSV writer trims values by default.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    return writer

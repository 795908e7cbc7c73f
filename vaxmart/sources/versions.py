"""Tables whose writes are all or nothing: new files beside the old ones, one pointer row last.

Layout below a table's folder::

    data/table_version=<id>/<p1>=<v1>/<p2>=<v2>/part-*   rows, one version for each staged write
    _commits/part-*                                one file, one row for each commit: the live (folder, version) pairs

A transaction stages any number of writes (merge, replace, append, rebuild), each into a version of its own, and reads
its own staged state.  When it ends well, one row naming the live folders is appended by a job with a single output
file; that file's appearance is the commit.  Readers take the latest row and open exactly the folders it names, so they
see the state before or after, never one in between, and no partition is emptied before its replacement exists.  A
writer that dies leaves files that nothing names; ``vacuum`` removes them.  A repeated run of a labelled transaction
finds its label among the commits and does nothing.  One writer at a time: a commit that finds another one made since
it began is refused.

Scale: only what a write touches is rewritten (the loaded partition of a merge; the rows of other partitions are added
as further folders), partitions are addressed by path, so neither reads nor merges list or open others, and what the
driver holds is the list of live folders, one entry for each partition and version.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaxmart.operators.merge import merge_rows
from vaxmart.sources.csv import CORRUPT, DATA_FILES, RejectBudgetExceeded, load_csv, read_csv_bulk, rejected_lines, rejects_allowed
from vaxmart.sources.tables import csv_landing_writer, open_files, rebalanced

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
COMMIT_SCHEMA = "commit long, label string, live array<struct<folder:string, version:string>>, committed_at timestamp"
REJECT_SCHEMA = "load string, file string, record string, lines long"
REJECTED = "rejected"

Live = tuple[tuple[str, str], ...]


class ConcurrentCommit(RuntimeError):
    """Another commit was made since the transaction began."""


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative names of the folders ``depth`` levels below ``path``."""
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory() and not s.getPath().getName().startswith("_")]
    if depth <= 1:
        return names
    return [f"{n}/{inner}" for n in names for inner in _folders(spark, f"{path}/{n}", depth - 1)]


def partition_values(folder: str) -> dict[str, str | None]:
    """Partition values of a folder ``a=1/b=2``."""
    pairs = (part.partition("=") for part in folder.split("/") if part)
    return {name: None if value == NULL_PARTITION else unquote(value) for name, _, value in pairs}


@dataclass(frozen=True)
class VersionedTable:
    """A table of Parquet files, or of landing CSV files (``fmt='csv'``), below ``base``."""

    spark: SparkSession
    base: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    fmt: str = "parquet"

    @property
    def data(self) -> str:
        return f"{self.base.rstrip('/')}/data"

    def commits(self) -> DataFrame:
        """One row for each commit, the live folders as an array."""
        path = f"{self.base.rstrip('/')}/_commits"
        try:
            return self.spark.read.schema(COMMIT_SCHEMA).parquet(path)
        except AnalysisException:  # nothing committed yet
            return self.spark.createDataFrame([], COMMIT_SCHEMA)

    def _latest(self) -> tuple[int, Live]:
        row = self.commits().orderBy(F.desc("commit")).select("commit", "live").first()  # the one that counts
        return (row["commit"], tuple((p["folder"], p["version"]) for p in row["live"])) if row else (0, ())

    def is_committed(self, label: str) -> bool:
        return not self.commits().where(F.col("label") == label).isEmpty()

    def paths(self, live: Live | None = None, where: Mapping[str, str | None] | None = None) -> list[str]:
        """Folders of the current state, of the partitions with the given values."""
        return [f"{self.data}/table_version={v}/{f}".rstrip("/") for f, v in (self._latest()[1] if live is None else live) if _fits(f, where)]

    def read(self, where: Mapping[str, str | None] | None = None, live: Live | None = None) -> DataFrame:
        """The current state, or its partitions with the given values."""
        paths = self.paths(live, where)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        if self.fmt == "csv":
            return load_csv(self.spark, [f"{p}/{DATA_FILES}" for p in paths], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.data).parquet(*paths).select(*self.schema.names)

    def read_rejects(self) -> DataFrame:
        """(load, file, record, lines) of the rejected records of all loads, those over budget included."""
        path = f"{self.base.rstrip('/')}/_rejects"
        try:
            return self.spark.read.schema(REJECT_SCHEMA).parquet(path)
        except AnalysisException:  # no load had any
            return self.spark.createDataFrame([], REJECT_SCHEMA)

    def transaction(self, label: str | None = None) -> Transaction:
        return Transaction(self, label)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Removes the versions that none of the last ``keep`` commits names; returns them.  Not while a writer runs."""
        rows = self.commits().orderBy(F.desc("commit")).limit(keep)
        named = {r["version"] for r in rows.select(F.explode("live.version").alias("version")).distinct().collect()}
        gone = [f for f in _folders(self.spark, self.data, 1) if partition_values(f).get("table_version") not in named]
        for folder in gone:
            fs, at = _fs(self.spark, f"{self.data}/{folder}")
            fs.delete(at, True)
        return gone


def _fits(folder: str, where: Mapping[str, str | None] | None) -> bool:
    held = partition_values(folder)
    return all(held.get(k) == v for k, v in (where or {}).items())


class Transaction:
    """Staged writes of one commit; a context manager.  ``skipped`` tells that the label is committed already."""

    def __init__(self, table: VersionedTable, label: str | None) -> None:
        self.table, self.label = table, label
        self.skipped = label is not None and table.is_committed(label)
        self.began, self.live = table._latest()
        self.staged: list[str] = []

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.commit()
        else:
            self._discard()

    def read(self, where: Mapping[str, str | None] | None = None) -> DataFrame:
        """The table with what this transaction has staged."""
        return self.table.read(where, self.live)

    def _stage(self, rows: DataFrame, folder: Mapping[str, str] | None = None) -> Live:
        """Writes a new version; its (folder, version) pairs.  ``folder`` fixes partition folders of landing files, whatever
        month, say, their rows name."""
        table, version = self.table, uuid.uuid4().hex[:16]
        self.staged.append(version)
        path, dirs = f"{table.data}/table_version={version}", list(table.partition_by)
        out = rows.select(*table.schema.names)
        if table.fmt == "csv":
            with open_files(table.spark):
                csv_landing_writer(out, dirs, folder).csv(path)
        else:
            writer = rebalanced(out, dirs).write
            (writer.partitionBy(*dirs) if dirs else writer).parquet(path)
        found = _folders(table.spark, path, len(dirs)) if dirs else [""]
        return tuple((f, version) for f in sorted(found))

    def _without(self, *partitions: Mapping[str, str | None]) -> Live:
        return tuple(p for p in self.live if not any(_fits(p[0], w) for w in partitions))

    def append(self, rows: DataFrame, folder: Mapping[str, str] | None = None) -> None:
        if not self.skipped:
            self.live = self.live + self._stage(rows, folder)

    def rebuild(self, rows: DataFrame) -> None:
        """Drop and create: the rows are the whole table."""
        if not self.skipped:
            self.live = self._stage(rows)

    def replace(self, rows: DataFrame, partitions: Sequence[Mapping[str, str | None]], folder: Mapping[str, str] | None = None) -> None:
        """The given partitions (by some or all of their values) go, whether or not ``rows`` has any for them; the rows are added."""
        if not self.skipped:
            added = self._stage(rows, folder)
            self.live = self._without(*partitions) + added

    def replace_present(self, rows: DataFrame) -> None:
        """Every partition that ``rows`` has is replaced by its rows."""
        if not self.skipped:
            added = self._stage(rows)
            self.live = self._without(*(partition_values(f) for f, _ in added)) + added

    def merge(self, batch: DataFrame, pk: str | Sequence[str], value: str | None) -> None:
        """The partition merge: rows of partition ``value`` whose key is in the batch go, all batch rows are added.

        Only that partition is rewritten; batch rows of other partitions are further folders of theirs."""
        if self.skipped:
            return
        (column,) = self.table.partition_by
        self.replace(merge_rows(self.read({column: value}), batch, pk), [{column: value}])

    def upsert(self, batch: DataFrame, pk: str | Sequence[str]) -> None:
        """Merges a batch into all partitions it has: rows of those partitions whose key is in the batch's rows of the same
        partition go, all batch rows are added.  The partitions' values come to the driver, one for each."""
        if self.skipped:
            return
        (column,) = self.table.partition_by
        keys = [pk] if isinstance(pk, str) else list(pk)
        values = [r[0] for r in batch.select(F.col(column).cast("string")).distinct().collect()]
        touched = [{column: v} for v in values if any(_fits(f, {column: v}) for f, _ in self.live)]
        rows = batch.select(*self.table.schema.names)
        if touched:
            live = tuple(p for p in self.live if any(_fits(p[0], w) for w in touched))
            gone = batch.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(column).alias("_p")).distinct()
            same = F.col(column).eqNullSafe(F.col("_p"))
            for i, k in enumerate(keys):
                same = same & (F.col(k) == F.col(f"_k{i}"))
            rows = self.table.read(live=live).join(gone, same, "left_anti").unionByName(rows)
        self.replace(rows, touched)

    def load_csv(
        self, path: str | list[str], max_errors: int = 0, header: bool = True, multi_line: bool = True, load: str | None = None
    ) -> int:
        """Adds the good rows of CSV files, which are parsed once: one write deals good rows and rejects to two folders.

        The rejects are counted in the second folder, in lines, and kept under the name of the load (by default the
        transaction's label, else the version).  Over budget the load raises, and nothing of it is committed."""
        if self.skipped:
            return 0
        table, version = self.table, uuid.uuid4().hex[:16]
        self.staged.append(version)
        parsed = read_csv_bulk(table.spark, path, table.schema, max_errors, header, multi_line).parsed
        rows = parsed.withColumn("_file", F.input_file_name()).withColumn(REJECTED, F.col(CORRUPT).isNotNull())
        rows = rows.withColumnRenamed(CORRUPT, "_record")
        dirs = [REJECTED, *table.partition_by]
        target = f"{table.data}/table_version={version}"
        (rebalanced(rows, dirs) if table.partition_by else rows).write.partitionBy(*dirs).parquet(target)
        n = 0
        if f"{REJECTED}=true" in _folders(table.spark, target, 1):
            bad = table.spark.read.schema("_record string, _file string").parquet(f"{target}/{REJECTED}=true")
            kept = bad.select(F.lit(load or self.label or version).alias("load"), F.col("_file").alias("file"), F.col("_record").alias("record"),
                              rejected_lines("_record").cast("long").alias("lines"))
            n = int(kept.agg(F.sum("lines").alias("n")).first()["n"] or 0)
            kept.write.mode("append").parquet(f"{table.base.rstrip('/')}/_rejects")
        if not rejects_allowed(n, max_errors):
            raise RejectBudgetExceeded(f"{n} rejected lines; budget {max_errors}; nothing was committed")
        good = f"{REJECTED}=false"
        inner = _folders(table.spark, f"{target}/{good}", len(table.partition_by)) if table.partition_by else [""]
        if good in _folders(table.spark, target, 1):
            self.live = self.live + tuple((f"{good}/{f}".rstrip("/"), version) for f in sorted(inner))
        return n

    def commit(self) -> None:
        """Appends the pointer row."""
        if self.skipped:
            return
        table = self.table
        if table._latest()[0] != self.began:
            self._discard()
            raise ConcurrentCommit(f"{table.base}: commit {self.began + 1} was made by another writer")
        row = table.spark.createDataFrame([(self.began + 1, self.label, [list(p) for p in self.live], None)], COMMIT_SCHEMA)
        row = row.withColumn("committed_at", F.current_timestamp())
        row.coalesce(1).write.mode("append").parquet(f"{table.base.rstrip('/')}/_commits")

    def _discard(self) -> None:
        for version in self.staged:
            fs, at = _fs(self.table.spark, f"{self.table.data}/table_version={version}")
            fs.delete(at, True)


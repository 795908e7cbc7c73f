"""CSV landing files: bulk load with a bad-row budget, single-partition load.

Format of the landing files: comma separated, ``"`` quote with doubled quotes
inside quoted fields, fields may hold newlines, one header line per file,
optionally gzip (detected from the extension). Columns are positional: the
header's names are ignored and the explicit schema applies (no inference).

Scale: gzip files are not splittable, so each file is one task; the landing
writer produces many files per partition for that reason.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaxmart.schemas import LANDING_PARTITIONS

CORRUPT = "_corrupt_record"
# Files of a landing partition, or of one run in it.
DATA_FILES = "{*.csv*,run_until=*/*.csv*}"


class RejectBudgetExceeded(RuntimeError):
    pass


def rejected_lines(column: str = CORRUPT):
    """Physical lines of the rejected record of a row (0 for a good row). An
    unbalanced quote swallows the lines after it into one record; counted in
    lines, it spends the budget like the rows it hides."""
    text = F.col(column)
    body = F.regexp_replace(text, r"[\r\n]+$", "")
    return F.when(text.isNull(), 0).otherwise(1 + F.length(body) - F.length(F.regexp_replace(body, "\n", "")))


def csv_reader(
    spark: SparkSession, schema: T.StructType, header: bool = True, with_corrupt: bool = False, multi_line: bool = True
):
    """Reader for the landing format. ``multi_line`` allows newlines inside
    quoted fields; it reads each file in one task, which costs nothing for
    gzip files (never splittable) — set it False for large plain files whose
    fields hold no newlines, so they split."""
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)]) if with_corrupt else schema
    reader = (
        spark.read.schema(full)
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
    )
    if with_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader


def landing_glob(base: str, partitions: list[str] | None = None) -> str:
    """Data files under ``base/<p1>=*/<p2>=*/``, in the folders of single runs
    there too; excludes anything else such as a left-over ``trash/`` folder,
    and turns partition discovery off (the partition columns are also inside
    the files)."""
    parts = "/".join(f"{p}=*" for p in (partitions or LANDING_PARTITIONS))
    return f"{base.rstrip('/')}/{parts}/{DATA_FILES}"


def rejects_allowed(n_rejects: int, max_errors: int) -> bool:
    """The warehouse rule: the load fails once errors reach ``max_errors``;
    a budget of 0 allows none."""
    return n_rejects < max(max_errors, 1)


@dataclass
class CsvLoad:
    """Parsed CSV input split into loadable rows and rejected rows."""

    parsed: DataFrame
    columns: list[str]
    max_errors: int

    @property
    def good(self) -> DataFrame:
        """Rows that parsed. Consume whole rows (write, collect): Spark parses
        only the columns a query references, so a narrower projection would
        miss bad values in the other columns, and a bare ``count()`` (corrupt
        column only) is refused. :func:`load_csv_to_table` does this."""
        return self.parsed.where(F.col(CORRUPT).isNull()).select(*self.columns)

    @property
    def rejects(self) -> DataFrame:
        return self.parsed.where(F.col(CORRUPT).isNotNull())

    def rejects_table(self) -> DataFrame:
        """(file, record, lines) of every rejected record, and the columns as far as they parsed; all of them are
        selected so that every field is parsed (see ``good``)."""
        rows = self.rejects.select(F.input_file_name().alias("_file"), CORRUPT, *self.columns)
        return rows.withColumnRenamed(CORRUPT, "_record").withColumn(
            "_lines", rejected_lines("_record").cast("long"))

    def reject_count(self) -> int:
        # Spark converts only the columns a query references, and refuses a
        # query on the corrupt column alone: hashing the whole row makes every
        # field parse, so a bad value in any column counts, in one pass.
        row = self.parsed.agg(
            F.sum(rejected_lines()).alias("bad"), F.max(F.xxhash64(*self.columns)).alias("_all")
        ).first()
        return int(row["bad"] or 0)

    def check_budget(self) -> int:
        n = self.reject_count()
        if not rejects_allowed(n, self.max_errors):
            raise RejectBudgetExceeded(f"{n} rejected rows; budget {self.max_errors}")
        return n


def read_csv_bulk(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    max_errors: int = 0,
    header: bool = True,
    multi_line: bool = True,
) -> CsvLoad:
    """Positional CSV read with an explicit schema; malformed rows (wrong
    field count, bad number) are kept aside instead of failing the read."""
    parsed = csv_reader(spark, schema, header=header, with_corrupt=True, multi_line=multi_line).csv(path)
    return CsvLoad(parsed=parsed, columns=schema.names, max_errors=max_errors)


def load_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, max_errors: int = 0, header: bool = True
) -> DataFrame:
    """Good rows of a bulk load, after checking the bad-row budget (raises).

    Two passes over the files (count, then whatever consumes the result);
    :func:`load_csv_to_table` loads in one pass."""
    load = read_csv_bulk(spark, path, schema, max_errors=max_errors, header=header)
    load.check_budget()
    return load.good


def rejects_path(target_path: str) -> str:
    return f"{target_path.rstrip('/')}__rejects"


def read_rejects(spark: SparkSession, target_path: str) -> DataFrame:
    """The rejected records of the last load into ``target_path`` that had some."""
    rows = spark.read.parquet(rejects_path(target_path))
    return rows.select(F.col("_file").alias("file"), F.col("_record").alias("record"), F.col("_lines").alias("lines"))


def load_csv_to_table(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    target_path: str,
    max_errors: int = 0,
    header: bool = True,
    budget_check: str = "during",
    partition_by: list[str] | None = None,
    multi_line: bool = True,
    rejects_to: str | None = None,
) -> DataFrame:
    """Bulk-load CSV into the Parquet table at ``target_path``; return it.

    ``budget_check="during"``: one parsing pass — the reject count is an
    ``observe`` metric of the write job and is checked when it commits; on
    excess the table is written but :class:`RejectBudgetExceeded` is raised,
    so load into a fresh path and publish it only on success.
    The observed count can only over-count (a shuffle-map stage re-run after
    a lost executor adds its rows again), so it never lets a load through
    that is over budget.
    Rejected records are kept in the table at ``rejects_to``, by default
    ``rejects_path(target_path)`` (file, record, lines), written only when
    there are some.
    ``budget_check="before"``: a counting pass first; nothing is written
    when the budget is exceeded (the warehouse behaviour), at the price of
    parsing the files twice.
    """
    from vaxmart.sources.tables import rebalanced

    load = read_csv_bulk(spark, path, schema, max_errors=max_errors, header=header, multi_line=multi_line)
    if budget_check == "before":
        n = load.check_budget()
        parsed = load.parsed
        obs = None
    elif budget_check == "during":
        obs = Observation("csv_rejects")
        parsed = load.parsed.observe(obs, F.sum(rejected_lines()).alias("bad"))
    else:
        raise ValueError("budget_check must be 'during' or 'before'")
    good = parsed.where(F.col(CORRUPT).isNull()).select(*load.columns)
    writer = rebalanced(good, partition_by or []).write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target_path)
    if obs is not None:
        n = int(obs.get.get("bad", 0) or 0)
    if n:
        load.rejects_table().write.mode("overwrite").parquet(rejects_to or rejects_path(target_path))
    if obs is not None:
        if not rejects_allowed(n, max_errors):
            raise RejectBudgetExceeded(f"{n} rejected rows; budget {max_errors} (table written to {target_path})")
    return spark.read.parquet(target_path).select(*load.columns)


def partition_path(base: str, column: str, value: str) -> str:
    return f"{base.rstrip('/')}/{column}={value}"


def read_partition(
    spark: SparkSession,
    base: str,
    column: str,
    value: str,
    schema: T.StructType,
    sub_partitions: list[str] | None = None,
    header: bool = True,
    max_errors: int = 0,
) -> DataFrame:
    """Read one partition directory (``base/column=value``) only: the other
    partitions' files are never listed or opened. Malformed rows are held
    against the budget like in a bulk load (default: none allowed)."""
    subs = sub_partitions if sub_partitions is not None else [p for p in LANDING_PARTITIONS if p != column]
    inner = "/".join(f"{p}=*" for p in subs)
    root = partition_path(base, column, value)
    pattern = f"{root}/{inner}/{DATA_FILES}" if inner else f"{root}/{DATA_FILES}"
    return load_csv(spark, pattern, schema, max_errors=max_errors, header=header)

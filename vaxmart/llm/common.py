"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaxmart.session import scratch_path

ARROW_ROWS = 2000


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches: texts reach 100 KB and more, so the default of 10,000 rows a batch is too many."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    current = int(spark.conf.get(key))
    if current <= 0 or current > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: the lineage ends at shared files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(text: Column) -> Column:
    """A null text counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def total_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one partial sum a task; used to size buckets in proportion to the input."""
    return docs.select(F.sum(F.octet_length(F.col(text))).alias("n")).first()["n"] or 0


def parts(n_bytes: int, each: int, least: int = 1) -> int:
    return max(least, -(-n_bytes // each))

"""Partition merge (upsert) and partition replace.

``merge_partition`` keeps the warehouse semantics exactly: delete target
rows whose key is in the new batch *and* whose partition is the loaded one,
then insert every batch row. So target rows of the partition that are not
in the batch stay, a key that also lives in another partition stays there,
duplicate keys inside the batch are all inserted, and batch rows of another
partition are inserted too. ``replace_partition`` is the other contract:
every partition present in the batch is replaced by the batch's rows.

Scale: the anti join only reads the loaded partition of the target
(partition pruning on the Parquet table) and the batch's keys, de-duplicated
map-side; written back with dynamic partition overwrite only the partitions
that receive rows are rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaxmart.sources.tables import rebalanced


def _keys(pk: str | Sequence[str]) -> list[str]:
    return [pk] if isinstance(pk, str) else list(pk)


def merge_rows(target_partition: DataFrame, batch: DataFrame, pk: str | Sequence[str]) -> DataFrame:
    """Rows of the loaded partition after the merge: survivors + all batch rows."""
    keys = _keys(pk)
    survivors = target_partition.join(batch.select(*keys).distinct(), keys, "left_anti")
    return survivors.unionByName(batch.select(*target_partition.columns))


def merge_partition(
    target: DataFrame, batch: DataFrame, pk: str | Sequence[str], partition_col: str, partition_value
) -> DataFrame:
    """The whole table after merging ``batch`` into partition ``partition_value``."""
    in_partition = F.col(partition_col).eqNullSafe(F.lit(partition_value))
    others = target.where(~F.col(partition_col).eqNullSafe(F.lit(partition_value)))
    return others.unionByName(merge_rows(target.where(in_partition), batch, pk))


def replace_partition(target: DataFrame, batch: DataFrame, partition_col: str) -> DataFrame:
    """The whole table after replacing every partition present in ``batch``."""
    parts = batch.select(F.col(partition_col).alias("_p")).distinct()
    kept = target.join(parts, target[partition_col].eqNullSafe(parts["_p"]), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def write_merge(
    spark: SparkSession,
    target_path: str,
    batch: DataFrame,
    pk: str | Sequence[str],
    partition_col: str,
    partition_value,
    schema=None,
) -> None:
    """Merge ``batch`` into the partitioned Parquet table at ``target_path``.

    Pass the table's ``schema`` when it may still be empty (no data file to
    infer it from).

    Rewritten partitions: the loaded one (survivors + its batch rows) and any
    other partition the batch carries (its target rows kept + the batch rows,
    since nothing is deleted outside the loaded partition). The loaded
    partition is read through a static partition filter; the carried ones
    through a semi join with the batch's partition values, which AQE
    broadcasts when they measure small. Untouched partitions are not
    written (dynamic overwrite); the swap happens on job commit.
    """
    if schema is not None:
        target = spark.read.schema(schema).parquet(target_path).select(*schema.names)
    else:
        target = spark.read.parquet(target_path)
    keys = _keys(pk)
    in_partition = F.col(partition_col).eqNullSafe(F.lit(partition_value))
    survivors = target.where(in_partition).join(batch.select(*keys).distinct(), keys, "left_anti")
    # One row per partition value the batch carries; null is a partition too.
    other_parts = batch.where(~in_partition).select(F.col(partition_col).alias("_p")).distinct()
    carried = target.where(~in_partition).join(other_parts, F.col(partition_col).eqNullSafe(F.col("_p")), "left_semi")
    rows = survivors.unionByName(carried).unionByName(batch.select(*target.columns))
    # Dynamic overwrite cannot empty a partition. If the batch has no row of
    # the loaded partition and deletes all of its rows, clear the partition
    # directory with a static overwrite of an empty frame (nothing is read
    # from it then: the survivors are empty).
    clear = batch.where(in_partition).isEmpty() and survivors.isEmpty()
    (
        rebalanced(rows, [partition_col]).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(target_path)
    )
    if clear:
        empty = spark.createDataFrame([], target.drop(partition_col).schema)
        empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{target_path.rstrip('/')}/{partition_col}={'__HIVE_DEFAULT_PARTITION__' if partition_value is None else partition_value}"
        )


def write_replace(batch: DataFrame, target_path: str, partition_col: str) -> None:
    """Replace exactly the partitions present in ``batch`` (dynamic overwrite)."""
    (
        rebalanced(batch, [partition_col]).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(target_path)
    )

"""Session configuration shared by the library, the tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on for correct results (not tuning knobs).
REQUIRED_CONF = {
    # Zone-less timestamps and date arithmetic must not depend on the host.
    "spark.sql.session.timeZone": "UTC",
    # Bad casts raise, like the warehouse does on a bad literal.
    "spark.sql.ansi.enabled": "true",
    # Overwrite replaces only the partitions present in the output.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partition values such as year_month=2021-07-01 stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Runtime re-planning: broadcast only what AQE measured as small, coalesce
# tiny shuffle partitions, split skewed join partitions.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "vaxmart",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's required settings."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = {**REQUIRED_CONF, **ADAPTIVE_CONF, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.sql.execution.arrow.pyspark.enabled": "true"}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings on an existing session (idempotent).

    The adaptive ones are set, too: the skew handling of joins and the
    ``rebalance`` of partitioned writes have no effect without them."""
    for key, value in {**REQUIRED_CONF, **ADAPTIVE_CONF}.items():
        spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent (local tests) is a private folder
    created and registered, so cluster jobs always use the shared one.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        current = tempfile.mkdtemp(prefix="vaxmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more; refuses paths outside the checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    if not path.startswith(f"{base}/") or ".." in path:
        raise ValueError(f"{path} is not a scratch path")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")

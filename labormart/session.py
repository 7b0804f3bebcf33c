"""Spark session defaults and the shared checkpoint folder.

The library never creates a session on its own inside an operator; callers
pass one in. ``build_session`` is the convenience used by tests, the bench
and the command-line entry points.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Settings that hold from local[8] up to a large cluster. Shuffle partition
# count is a starting point only: AQE coalesces small partitions and splits
# skewed ones at runtime.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # local mode runs everything in the driver JVM; ignored once a JVM is up
    "spark.driver.memory": "16g",
}


def build_session(
    master: str | None = None,
    app_name: str = "labormart",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. On a local master, where
    driver and executors are one machine, an unset one is replaced by a fresh
    scratch folder; any other master must name a folder that all nodes share.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="labormart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for staged intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(spark: SparkSession, df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the cluster's checkpoint folder (or ``folder``) and read it back.

    One pass over the input (an eager RDD checkpoint computes it twice), the
    lineage ends at the files, and Catalyst sees the real file size.
    """
    path = f"{folder or scratch_path(spark, 'labormart-stage')}/{name}-{uuid.uuid4().hex}"
    with _whole_variants(spark, df):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _whole_variants(spark: SparkSession, df: DataFrame) -> Iterator[None]:
    """VARIANT columns are written as they are: readers take whole documents, which shredded ones are put together for."""
    key = "spark.sql.variant.inferShreddingSchema"
    if not any(isinstance(f.dataType, T.VariantType) for f in df.schema.fields):
        yield
        return
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at input / 256 MB (at least 2 per core) so that
    no reducer spills on the largest shuffle; AQE then coalesces small ones
    and splits skewed ones. Scan splits stay at 256 MB.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }

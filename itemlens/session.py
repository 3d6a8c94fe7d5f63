"""Session helpers.

The library never creates a global session: every operator takes DataFrames. These helpers are for tests, the
bench and the driver entry point, and for resolving the shared checkpoint folder that the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Used only by local sessions that don't name a shared checkpoint folder (tests, laptops).
_LOCAL_FALLBACK_DIR = "/tmp/itemlens-checkpoints"
# Spark's own switch: shuffle files of a query go when it has run.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "itemlens", extra_conf: dict | None = None
) -> SparkSession:
    """A local session configured like a small cluster: AQE on, UI off, UTC, ANSI on (the 4.x default)."""
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ITEMLENS_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir``). Only a local master may leave it unset: on a cluster a folder of
    one machine would lose rows, so that is an error.
    """
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return conf_dir or _LOCAL_FALLBACK_DIR


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable: set the context's checkpoint dir from the session setting."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    root = checkpoint_root(spark)
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for an intermediate table (never a machine-local tmp dir)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/itemlens-scratch/{name}-{uuid.uuid4().hex}"


@contextmanager
def configured(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session's setting ``key`` is ``value`` within it."""
    held = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if held is None else spark.conf.set(key, held)


def shuffles_freed(spark: SparkSession):
    """Shuffle files of the queries that run within it are removed when each has ended, not at some later garbage collection of
    the driver. For tables that are written once and read back, whose shuffles nothing needs again."""
    return configured(spark, _FREE_SHUFFLES, "true")


def write_scratch_table(spark: SparkSession, df, name: str):
    """Write ``df`` once as parquet under the shared checkpoint folder and return the table read back.

    Cuts lineage like ``checkpoint()`` but computes the input a single time (a reliable RDD checkpoint of an
    unpersisted input recomputes it while writing) and keeps the data columnar for later pruning and pushdown.
    """
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_bucketed_scratch_table(spark: SparkSession, df, name: str, key: str, buckets: int):
    """:func:`write_scratch_table` with the rows bucketed by ``key``, so that a join on it leaves this side in place. Rows that
    a join has partitioned by ``key`` into as many partitions make one file per bucket. Compressed with zstd, as what is bucketed
    here are texts."""
    path = scratch_path(spark, name)
    entry = f"itemlens_{name}_{path.rsplit('-', 1)[-1]}"
    writer = df.write.mode("overwrite").option("compression", "zstd").bucketBy(buckets, key)
    with shuffles_freed(spark):
        writer.option("path", path).saveAsTable(entry)
    return spark.table(entry)

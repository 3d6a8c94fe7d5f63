"""Hot tables (S9): derived tables that are written once and read by many queries, owned by a context object.

A table is kept under the name, the folder and the state of the source tables that it was derived from: their size, number
of files and time of change, asked of the file system in three calls per table. A folder that changes is read anew, and the
table of its former state is removed. ``close`` removes all of them, files and catalog entries; it runs at the latest when
the Python process ends, if the session is still alive.
"""

from __future__ import annotations

import atexit
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from itemlens.session import scratch_path, shuffles_freed
from itemlens.sources.catalog import table_path


def fingerprint(spark: SparkSession, folder: str, names: tuple[str, ...]) -> tuple:
    """(name, bytes, files, time of change) of each source table, on whatever store holds the folder."""
    out, conf = [], spark._jsc.hadoopConfiguration()
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(table_path(folder, name))
        fs = path.getFileSystem(conf)
        held = fs.getContentSummary(path)
        out.append((name, held.getLength(), held.getFileCount(), fs.getFileStatus(path).getModificationTime()))
    return tuple(out)


class HotTables:
    """Derived tables and fitted models of one session. A context manager: leaving it removes the tables."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._tables: dict[tuple[str, str], tuple[tuple, str, str | None]] = {}
        self._values: dict[tuple[str, str], tuple[tuple, Any]] = {}
        atexit.register(self.close)

    def __enter__(self) -> HotTables:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def table(
        self, folder: str, name: str, sources: tuple[str, ...], build: Callable[[], DataFrame], bucket_by: str | None = None
    ) -> DataFrame:
        """The table ``name`` of ``folder``, built at most once per state of its ``sources``.

        Later queries read a columnar table with pruning and pushdown instead of repeating the joins and aggregations
        behind it, and a lost executor re-reads files. With ``bucket_by`` the table is bucketed on that key
        (``spark.sql.shuffle.partitions`` buckets) and registered in the session catalog, so later joins on the key read
        it already partitioned. Bucket only on a key that is unique or evenly spread: a hot key makes one bucket, hence
        one task, hold all of its rows.
        """
        state = fingerprint(self.spark, folder, sources)
        held = self._tables.get((folder, name))
        if held is None or held[0] != state:
            path = scratch_path(self.spark, name)
            entry = None
            if bucket_by:
                entry = f"itemlens_{name}_{path.rsplit('-', 1)[-1]}"
                n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
                # Repartitioning on the bucket key first (same hash as bucketing) writes one file per bucket instead of
                # one per (task, bucket).
                rows = build().repartition(n, bucket_by).write.mode("overwrite")
                with shuffles_freed(self.spark):
                    rows.bucketBy(n, bucket_by).sortBy(bucket_by).option("path", path).saveAsTable(entry)
            else:
                rows = build().write.mode("overwrite")
                with shuffles_freed(self.spark):
                    rows.parquet(path)
            if held is not None:
                self._remove(*held[1:])
            self._tables[folder, name] = held = (state, path, entry)
        return self.spark.table(held[2]) if held[2] else self.spark.read.parquet(held[1])

    def value(self, folder: str, name: str, sources: tuple[str, ...], build: Callable[[], Any]) -> Any:
        """A driver-side object derived from ``sources``, such as a fitted model, built at most once per state of them."""
        state = fingerprint(self.spark, folder, sources)
        held = self._values.get((folder, name))
        if held is None or held[0] != state:
            self._values[folder, name] = held = (state, build())
        return held[1]

    def paths(self) -> list[str]:
        return [path for _, path, _ in self._tables.values()]

    def _remove(self, path: str, entry: str | None) -> None:
        if entry:
            self.spark.sql(f"DROP TABLE IF EXISTS {entry}")
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def close(self) -> None:
        """Removes all tables. Nothing is done if the session has ended already."""
        atexit.unregister(self.close)
        alive = getattr(self.spark.sparkContext, "_jsc", None) is not None
        for _, path, entry in self._tables.values() if alive else ():
            self._remove(path, entry)
        self._tables.clear()
        self._values.clear()


def hot_tables(spark: SparkSession) -> HotTables:
    """The session's own context; it lives as long as the session object."""
    held = getattr(spark, "_itemlens_hot", None)
    if held is None:
        held = spark._itemlens_hot = HotTables(spark)
    return held

"""Sinks (S10): the data behind each chart is written as a table instead of a rendered image."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_series(df: DataFrame, path: str, *, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Write an aggregated chart series (for example a panel from ``eda_panel``) as parquet, optionally partitioned
    (e.g. by ``panel``) so one chart's data is read without scanning the others."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)

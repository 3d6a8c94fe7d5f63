"""Sort, limit and top-k (T1-T9), plus distributed ranking helpers.

- :func:`top_k` is ``orderBy(...).limit(k)``, which Spark plans as ``TakeOrderedAndProject``: every task keeps its own
  k best rows and only k rows per task reach the final merge, so no full sort or single-partition stage happens.
- :func:`global_rank` gives every row its 1-based position in a total order without a single-partition window: a
  range-partitioned sort, per-partition counts (one row per partition, a proven-small broadcast) and an offset.
- :func:`ordinal_within_group` numbers rows inside a group by an integer rank with windows of bounded size (rank
  blocks), so a hot group that holds a third of all rows never lands in one window partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemlens.session import write_scratch_table


def _sort_cols(order: list) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def top_k(df: DataFrame, k: int, order: list) -> DataFrame:
    """The first ``k`` rows of ``df`` in ``order`` (include an id as the last key to break ties)."""
    return df.orderBy(*_sort_cols(order)).limit(k)


def truncate_label(c: Column | str, width: int) -> Column:
    """A label cut to ``width`` characters with ``...`` appended when it was longer."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("..."))).otherwise(c)


def global_rank(df: DataFrame, order: list, rank_col: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """1-based position of every row in the total order ``order`` (must be unique, e.g. ending in an id).

    The sorted rows get ``monotonically_increasing_id`` (partition index in the high bits, position in the low bits)
    and ``spark_partition_id`` in the same stage as the sort, and are written once to the shared checkpoint folder,
    so both uses below read the same tags even if an executor is lost and tasks are retried. The per-partition row
    counts are one row per partition, so their broadcast is bounded by the partition count.
    """
    sort_cols = _sort_cols(order)
    sorted_df = df.repartitionByRange(num_partitions, *sort_cols) if num_partitions else df.repartitionByRange(*sort_cols)
    tagged = write_scratch_table(
        df.sparkSession,
        sorted_df.sortWithinPartitions(*sort_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id()),
        "rank",
    )
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_pid")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0)))
        .select("_pid", "_offset", "_first")
    )
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(rank_col, F.col("_offset") + (F.col("_mid") - F.col("_first")) + 1)
        .drop("_pid", "_mid", "_offset", "_first", "_n")
    )


def ordinal_within_group(
    df: DataFrame, group_col: str, rank_col: str, ordinal_col: str = "ordinal", block: int = 1024
) -> DataFrame:
    """1-based position of each row inside its group by the positive integer ``rank_col`` (unique per group).

    Skew-safe without a global sort: ranks are cut into blocks of ``block`` consecutive values; a group-by counts rows
    per (group, block) (partial aggregation, so a hot group collapses before the shuffle), a window over one group's
    block counts gives the rows before each block (at most ``max rank / block`` rows per window partition, whatever
    the group's size), and ``row_number`` inside a (group, block) sees at most ``block`` rows.
    """
    b = F.floor((F.col(rank_col) - 1) / block).cast("long")
    tagged = df.withColumn("_blk", b)
    counts = tagged.groupBy(group_col, "_blk").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(group_col).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0))).drop("_cnt")
    inner = Window.partitionBy(group_col, "_blk").orderBy(rank_col)
    return (
        tagged.withColumn("_rn", F.row_number().over(inner))
        .join(offsets, [group_col, "_blk"])
        .withColumn(ordinal_col, F.col("_before") + F.col("_rn"))
        .drop("_blk", "_rn", "_before")
    )

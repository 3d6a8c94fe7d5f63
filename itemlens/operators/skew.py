"""Joins on keys that may hold a large share of one side's rows (J1, J2, §2.12).

Heavy hitters are found by an exact count per key, which combines partially before its shuffle. Only keys above an average
partition's share are salted, each into a number of parts that follows from its own count, so nothing is dealt out for the
other keys and no fixed number of salts is outgrown by the data. There are fewer such keys than partitions, whatever the
input's size, which bounds the table of hot keys that both sides receive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts per average partition that a hot key's rows would fill; more parts spread more evenly over the partitions.
FINENESS = 4


def hot_keys(df: DataFrame, key: str, parts: int) -> DataFrame:
    """(key, salts) of the keys with more than one ``parts``-th of the rows: fewer than ``parts`` rows."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    share = F.col("_n") * F.lit(parts) / total
    return counts.withColumn("_share", share).filter("_share > 1").select(
        key, F.ceil(F.col("_share") * FINENESS).cast("int").alias("_salts")
    )


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def deal(df: DataFrame, hot: DataFrame, key: str, spread: list[str]) -> DataFrame:
    """``df`` with the column ``_salt``: the part of a hot key (of ``hot_keys``) that a hash of ``spread`` deals a row to, 0 for
    other keys."""
    dealt = df.join(F.broadcast(hot), key, "left")  # fewer than ``parts`` rows
    salt = F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*spread), F.col("_salts")).cast("int"))
    return dealt.withColumn("_salt", salt).drop("_salts")


def salted_join(big: DataFrame, small: DataFrame, key: str, spread: list[str], parts: int | None = None) -> DataFrame:
    """The inner join of ``big`` and ``small`` on ``key`` where a key may hold any share of ``big``.

    A hot key's rows of ``big`` are dealt to parts by a hash of the columns ``spread`` (the same part again if a task is
    retried); its rows of ``small`` are repeated once per part. Rows with a null key drop, as in any inner join. ``big`` is
    read twice, so hand in a stored table.
    """
    hot = hot_keys(big, key, parts or shuffle_partitions(big))
    dealt = deal(big, hot, key, spread)
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = small.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(every)).drop("_salts")
    return dealt.join(repeated, [key, "_salt"]).drop("_salt")

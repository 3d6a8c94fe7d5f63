"""Sampling and splitting.

:func:`hash_split` is the default: membership depends only on the key, so the split is identical across runs,
partitionings and task retries (a lost executor recomputes the same rows). ``randomSplit``/``rand`` splits are kept
for parity with the reference but change with the partitioning of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemlens.functions.hashing import hash_bucket


def hash_split(df: DataFrame, key_cols: list[str], train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """(train, test) where a row is in train when the md5 bucket of its key is below ``train_pct``."""
    b = hash_bucket(*key_cols)
    return df.filter(b < train_pct), df.filter(b >= train_pct)


def tag_hash_split(df: DataFrame, key_cols: list[str], train_pct: int = 80, col: str = "split") -> DataFrame:
    """R4 as a column: ``'train'`` or ``'test'`` per row (one pass, no second scan)."""
    return df.withColumn(col, F.when(hash_bucket(*key_cols) < train_pct, F.lit("train")).otherwise(F.lit("test")))


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """``randomSplit`` (depends on the input's partitioning; prefer :func:`hash_split`)."""
    return df.randomSplit(list(weights), seed=seed)


def rand_split(df: DataFrame, train_fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """R2: split on one ``rand(seed)`` column, dropped afterwards (same caveat as :func:`random_split`)."""
    tagged = df.withColumn("_rand", F.rand(seed))
    return (
        tagged.filter(F.col("_rand") < train_fraction).drop("_rand"),
        tagged.filter(F.col("_rand") >= train_fraction).drop("_rand"),
    )


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Every row with probability ``fraction``, whatever the input's size (depends on its partitioning)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


HASH_SPACE = 1 << 28  # md5 buckets of 7 hex digits


def sample_fraction(df: DataFrame, key_cols: list[str], fraction: float) -> DataFrame:
    """R3 in the stable form of R4: the rows whose 28-bit md5 key bucket is below ``fraction`` of all buckets.

    Membership depends only on the key, so reruns, other partitionings and retried tasks keep the same rows. One narrow
    filter: no count, no shuffle.
    """
    return df.filter(hash_bucket(*key_cols, buckets=HASH_SPACE) < int(fraction * HASH_SPACE))

"""Exact quantiles with linear interpolation (pandas' default, SQL ``quantile_cont``) by distributed selection.

Spark's built-in exact ``percentile``/``median`` keeps every distinct value of a group in one task's buffer, so a
hot group or a large catalogue puts an unbounded map in one task. A sort would move every value. Here values are only
counted:

- a value's :func:`order_key` is a 64-bit integer that orders like the value;
- the first pass counts rows per (group, top bits of the key); running sums of these counts show which bucket holds
  each wanted ordinal, and how far into the bucket it lies;
- each further pass counts the next bits, of the rows in those buckets only; after the last one the key is complete.

Counts combine partially before their shuffle, so a hot group or a hot value costs one row per task and bucket. A running
sum sees at most 2**22 buckets of one group and prefix, whatever the number of rows. Nothing is sorted by value or
written; the input is read once per pass.

For probability ``p`` and ``n`` values the answer is ``v[lo] + (h - floor(h)) * (v[hi] - v[lo])`` with ``h = p * (n - 1)``,
``lo = floor(h)`` and ``hi = ceil(h)``, ordinals from 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemlens.session import write_scratch_table

#: Bits of the key that the passes look at, from the top.
PASS_BITS = (22, 21, 21)


def _name(p: float) -> str:
    return f"q{str(p).replace('.', '_')}"


def order_key(v: Column) -> Column:
    """A 64-bit integer that orders like the double ``v``: its exponent and mantissa, negated for negative values.

    Both zeros have key 0, infinities lie beyond all finite values, and NaN is the largest, as in Spark's own order.
    """
    size = F.abs(v)
    # log2 may be off by one step next to a power of two; powers of two and divisions by them are exact.
    guess = F.coalesce(F.floor(F.log2(size)), F.lit(-1022)).cast("double")
    power = F.pow(F.lit(2.0), guess)
    guess = F.when(power > size, guess - 1).when(F.pow(F.lit(2.0), guess + 1) <= size, guess + 1).otherwise(guess)
    exponent = F.greatest(guess, F.lit(-1022.0))
    mantissa = size / F.pow(F.lit(2.0), exponent)
    step = F.lit(float(1 << 52))
    finite = F.when(
        mantissa >= 1, (exponent + 1023).cast("bigint") * (1 << 52) + ((mantissa - 1) * step).cast("bigint")
    ).otherwise((mantissa * step).cast("bigint"))
    key = F.when(size == float("inf"), F.lit(2047 << 52)).otherwise(finite)
    return F.when(F.isnan(v), F.lit((1 << 63) - 1)).when(v < 0, -key).otherwise(key)


def _digits(key: Column) -> list[Column]:
    """The key cut into the bits of each pass; the first keeps the sign."""
    out, below = [], 64
    for k, bits in enumerate(PASS_BITS):
        below -= bits
        part = F.shiftright(key, below)
        out.append(part if k == 0 else part.bitwiseAND(F.lit((1 << bits) - 1)))
    return out


def _holding(counts: DataFrame, within: list[str], digit: str, wanted: Column) -> DataFrame:
    """For each wanted ordinal the bucket that holds it: adds ``which`` and ``rest`` (ordinal inside the bucket).

    ``wanted`` is an array of (which, rest) of the rows before cutting by ``digit``.
    """
    order = Window.partitionBy(*within).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("_before", F.coalesce(F.sum("_c").over(order), F.lit(0))).withColumn("_wanted", wanted)
    here = F.filter(
        "_wanted", lambda w: (w["rest"] >= F.col("_before")) & (w["rest"] < F.col("_before") + F.col("_c"))
    )
    found = placed.withColumn("_w", F.explode(here))
    return found.withColumn("_which", F.col("_w.which")).withColumn("_rest", F.col("_w.rest") - F.col("_before")).drop(
        "_w", "_wanted", "_before"
    )


def exact_quantiles(
    df: DataFrame, col: str, probs: list[float], group_cols: list[str] | tuple = (), names: list[str] | None = None
) -> DataFrame:
    """One row per group (one row overall without groups) with a column per probability; nulls are skipped.

    Groups with no non-null value are absent (an empty input without groups gives one row of nulls, like an
    aggregate over no rows). Rows with a null group are a group of their own.
    """
    groups = [f"_g{i}" for i in range(len(group_cols))]
    names = names or [_name(p) for p in probs]
    digits = [f"_d{k}" for k in range(len(PASS_BITS))]
    vals = df.select(*(F.col(c).alias(g) for c, g in zip(group_cols, groups)), F.col(col).cast("double").alias("_v"))
    vals = vals.filter(F.col("_v").isNotNull()).withColumn("_key", order_key(F.col("_v")))
    vals = vals.select(*groups, "_v", *(d.alias(n) for d, n in zip(_digits(F.col("_key")), digits)))

    def same(left: DataFrame, right: DataFrame, on: list[str]) -> Column:
        out = F.lit(True)
        for c in on:
            out = out & (left[c].eqNullSafe(right[f"_r{c}"]) if c in groups else left[c] == right[f"_r{c}"])
        return out

    # Ordinal number 2 i is the lower neighbour of probability i, 2 i + 1 the upper one.
    counts = vals.groupBy(*groups, "_d0").agg(F.count(F.lit(1)).alias("_c"))
    counts = counts.withColumn("_n", F.sum("_c").over(Window.partitionBy(*groups)))
    ordinals = []
    for i, p in enumerate(probs):
        h = F.lit(float(p)) * (F.col("_n") - 1)
        for j, at in enumerate((F.floor(h), F.ceil(h))):
            ordinals.append(F.struct(F.lit(2 * i + j).alias("which"), at.cast("bigint").alias("rest")))
    spark = df.sparkSession
    found = write_scratch_table(spark, _holding(counts, groups, "_d0", F.array(*ordinals)).drop("_c"), "ordinals")
    for k in range(1, len(digits)):
        prefix = [*groups, *digits[:k]]
        wanted = found.groupBy(*prefix).agg(
            F.max("_n").alias("_n"),
            F.collect_list(F.struct(F.col("_which").alias("which"), F.col("_rest").alias("rest"))).alias("_list"),
        )
        keys = wanted.select(*(F.col(c).alias(f"_r{c}") for c in prefix))
        near = vals.join(keys, same(vals, keys, prefix), "left_semi")
        last = k == len(digits) - 1
        counts = near.groupBy(*prefix, digits[k]).agg(
            F.count(F.lit(1)).alias("_c"), *([F.min("_v").alias("_value")] if last else [])
        )
        lists = wanted.select(*(F.col(c).alias(f"_r{c}") for c in prefix), "_n", "_list")
        counts = counts.join(lists, same(counts, lists, prefix)).drop(*(f"_r{c}" for c in prefix))
        found = _holding(counts, prefix, digits[k], F.col("_list")).drop("_c", "_list")
        found = found if last else write_scratch_table(spark, found, "ordinals")
    aggs = []
    for i, (p, name) in enumerate(zip(probs, names)):
        h = F.lit(float(p)) * (F.max("_n") - 1)
        lo = F.max(F.when(F.col("_which") == 2 * i, F.col("_value")))
        hi = F.max(F.when(F.col("_which") == 2 * i + 1, F.col("_value")))
        aggs.append(F.when(lo == hi, lo).otherwise(lo + (h - F.floor(h)) * (hi - lo)).alias(name))
    out = found.groupBy(*groups).agg(*aggs) if groups else found.agg(*aggs)
    return out.select(*(F.col(g).alias(c) for g, c in zip(groups, group_cols)), *names)

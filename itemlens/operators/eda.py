"""Exploratory statistics (A9-A23, Q11-Q14) as Spark aggregates: nothing is collected to the driver.

Group-bys aggregate partially on the map side, so a hot key costs one row per task before the shuffle. Scalars that
feed another step (a median, quantiles, histogram range) are scalar subqueries (``DataFrame.scalar()``), which Spark
runs once and inlines: no cross join. Fixed small tables (six runtime bins) are broadcast: their size is fixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemlens.functions import numeric as NX
from itemlens.operators.quantiles import exact_quantiles


def explode_list(df: DataFrame, list_col: str, out_col: str, keep: list[str]) -> DataFrame:
    """One row per list element (null or empty lists give no rows)."""
    return df.select(*keep, F.explode(list_col).alias(out_col))


def mean_by_key(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Mean of ``value`` per ``key``; rows with a null key are dropped (as a pandas group-by does)."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias(out))


def top_groups_by_mean(df: DataFrame, key: str, value: str, k: int, out: str = "avg_value") -> DataFrame:
    """The ``k`` groups with the highest mean (ties by key)."""
    return mean_by_key(df, key, value, out).orderBy(F.desc(out), key).limit(k)


def value_counts(df: DataFrame, key: str, k: int | None = None, out: str = "n") -> DataFrame:
    """Frequency per non-null key, most frequent first; ``k`` keeps the top rows."""
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out))
    ordered = counted.orderBy(F.desc(out), key)
    return ordered.limit(k) if k else ordered


def group_profile(
    df: DataFrame,
    key: str,
    *,
    rating: str = "vote_average",
    votes: str | None = "vote_count",
    revenue: str = "revenue",
    min_count: int = 10,
    strict: bool = False,
    k: int | None = 10,
) -> DataFrame:
    """Per group mean rating, row count, total votes, mean revenue; groups below ``min_count`` rows are
    dropped (``>=`` by default, ``>`` with ``strict``), best mean rating first, then the top ``k``.

    The count filter is a HAVING on the same aggregate, so the reference's second pass (membership in the set of
    frequent groups, F11) needs no join.
    """
    aggs = [F.avg(rating).alias("avg_rating"), F.count(F.lit(1)).alias("movie_count")]
    if votes:
        aggs.append(F.sum(votes).cast("bigint").alias("total_votes"))
    aggs.append(F.avg(revenue).alias("avg_revenue"))
    g = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    g = g.filter(F.col("movie_count") > min_count) if strict else g.filter(F.col("movie_count") >= min_count)
    g = g.orderBy(F.desc("avg_rating"), key)
    return g.limit(k) if k else g


def quantiles(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas' default), one row, one column per probability.

    Distributed (see :mod:`itemlens.operators.quantiles`): no task holds all values.
    """
    return exact_quantiles(df, col, probs, names=[f"q{int(round(p * 100)):02d}" for p in probs])


def winsorize(df: DataFrame, col: str, lower_p: float = 0.01, upper_p: float = 0.99, out: str | None = None) -> DataFrame:
    """X12 + A16: clip ``col`` to its own lower/upper quantiles (computed once, used as scalar subqueries)."""
    q = exact_quantiles(df, col, [lower_p, upper_p], names=["lo", "hi"])
    return df.withColumn(out or f"{col}_clean", NX.clip(col, q.select("lo").scalar(), q.select("hi").scalar()))


def runtime_bin_means(spark: SparkSession, df: DataFrame, runtime: str = "runtime", value: str = "vote_average") -> DataFrame:
    """Mean ``value`` per right-closed runtime bin after winsorizing at 1%/99%; empty bins are shown with a null
    mean (a left join from the fixed six-row bin table, broadcast because its size is fixed)."""
    clean = winsorize(df, runtime, out="runtime_clean")
    per_bin = (
        clean.withColumn("runtime_bin", NX.runtime_bin("runtime_clean"))
        .filter(F.col("runtime_bin").isNotNull())
        .groupBy("runtime_bin")
        .agg(F.avg(value).alias("avg_rating"), F.count(F.lit(1)).alias("movie_count"))
    )
    bins = spark.createDataFrame(
        [(i + 1, label) for i, label in enumerate(NX.RUNTIME_LABELS)], "bin_order int, runtime_bin string"
    )
    return (
        F.broadcast(bins)
        .join(per_bin, "runtime_bin", "left")
        .select("bin_order", "runtime_bin", "avg_rating", F.coalesce("movie_count", F.lit(0)).alias("movie_count"))
    )


def summary(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, median and sample standard deviation of ``col`` (nulls skipped)."""
    med = exact_quantiles(df, col, [0.5], names=["median"]).scalar()
    return df.agg(
        F.count(col).alias("n"),
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
    ).select("n", "mean", med.alias("median"), "std")


def correlations(df: DataFrame, target: str, features: list[str]) -> DataFrame:
    """Pearson correlation of each feature with ``target`` (pairwise null drop), as (feature, corr) rows.

    One aggregation pass computes all pairs; ``stack`` unpivots the single row.
    """
    wide = df.agg(*[F.corr(f, target).alias(f) for f in features])
    pairs = ", ".join(f"'{f}', `{f}`" for f in features)
    return wide.selectExpr(f"stack({len(features)}, {pairs}) as (feature, corr)")


def era_compare(df: DataFrame, year: str = "release_year", value: str = "vote_average", cut: int = 2010) -> DataFrame:
    """Mean value since ``cut`` and before it, and their difference, in one pass."""
    recent = F.avg(F.when(F.col(year) >= cut, F.col(value)))
    old = F.avg(F.when(F.col(year) < cut, F.col(value)))
    return df.agg(recent.alias("avg_recent"), old.alias("avg_older"), (recent - old).alias("difference"))


def cohort_split_by_median(df: DataFrame, split_col: str = "budget", value: str = "vote_average") -> DataFrame:
    """Mean value above vs at-or-below the median of ``split_col`` (median as a scalar subquery)."""
    med = exact_quantiles(df, split_col, [0.5], names=["median"]).scalar()
    tagged = df.select(split_col, value).withColumn("_med", med)
    high = F.col(split_col) > F.col("_med")
    low = F.col(split_col) <= F.col("_med")
    return tagged.agg(
        F.max("_med").alias("median_split"),
        F.avg(F.when(high, F.col(value))).alias("avg_high"),
        F.avg(F.when(low, F.col(value))).alias("avg_low"),
        F.count(F.when(high, 1)).alias("n_high"),
        F.count(F.when(low, 1)).alias("n_low"),
    )


def histogram(df: DataFrame, value: Column | str, bins: int = 20) -> DataFrame:
    """Fixed-width histogram between the data's min and max (scalar subqueries); the max falls in the last bin.

    Returns (bin, lower, upper, n) for non-empty bins.
    """
    v = F.col(value) if isinstance(value, str) else value
    vals = df.select(v.alias("v")).filter(F.col("v").isNotNull())
    rng = vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    tagged = vals.withColumn("_lo", rng.select("lo").scalar()).withColumn("_hi", rng.select("hi").scalar())
    width = (F.col("_hi") - F.col("_lo")) / bins
    idx = F.least(
        F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("_lo"), width)), F.lit(0)).cast("int"), F.lit(bins - 1)
    )
    return (
        tagged.groupBy(idx.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
        .select(
            "bin",
            (F.col("_lo") + F.col("bin") * width).alias("lower"),
            (F.col("_lo") + (F.col("bin") + 1) * width).alias("upper"),
            "n",
        )
    )


def box_summary(df: DataFrame, key: str, value: str) -> DataFrame:
    """Five-number summary (min, q1, median, q3, max; linear quantiles) of ``value`` per ``key``.

    Quartiles are distributed exact quantiles; min, max and count are partial aggregates; both are one row per group
    and meet in an equi-join on the key.
    """
    keyed = df.filter(F.col(key).isNotNull())
    q = exact_quantiles(keyed, value, [0.25, 0.5, 0.75], [key], names=["q1", "median", "q3"])
    mm = keyed.groupBy(key).agg(
        F.min(value).alias("min"), F.max(value).alias("max"), F.count(F.lit(1)).alias("n")
    )
    return mm.join(q, key).select(key, "min", "q1", "median", "q3", "max", "n")


def density_grid(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Q14 at scale: a 2-D histogram (counts per x-bin, y-bin) replaces shipping every point of a scatter plot."""
    vals = df.select(F.col(x).alias("x"), F.col(y).alias("y")).na.drop()
    rng = vals.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    for c in ("x0", "x1", "y0", "y1"):
        vals = vals.withColumn(c, rng.select(c).scalar())

    def idx(v, lo, hi):
        return F.least(F.coalesce(F.floor(F.try_divide(v - lo, (hi - lo) / bins)), F.lit(0)).cast("int"), F.lit(bins - 1))

    return (
        vals.select(
            idx(F.col("x"), F.col("x0"), F.col("x1")).alias("x_bin"),
            idx(F.col("y"), F.col("y0"), F.col("y1")).alias("y_bin"),
        )
        .groupBy("x_bin", "y_bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def density_grids(
    df: DataFrame, pairs: dict[str, tuple[str, str]], bins: int = 20, colours: dict[str, str] | None = None
) -> DataFrame:
    """Q11/Q12/Q14: 2-D histograms of several scatter charts at once, as (series, x_bin, y_bin, n, colour).

    One aggregation finds the ranges of all charts, a second pass bins the points of all of them (``stack``), and the
    counts combine partially before the shuffle. ``colours`` names, for charts whose points are coloured by a third column,
    that column; ``colour`` is its mean in the cell, null for other charts.
    """
    colours = colours or {}
    ends = []
    for i, (x, y) in enumerate(pairs.values()):
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        for c, v in (("x", x), ("y", y)):
            ends += [f(F.when(both, F.col(v).cast("double"))).alias(f"{c}{i}_{n}") for f, n in ((F.min, "lo"), (F.max, "hi"))]
    ranges = df.agg(*ends).select(F.struct("*")).scalar()
    rows = ", ".join(
        f"'{s}', cast(`{x}` as double), cast(`{y}` as double), r.x{i}_lo, r.x{i}_hi, r.y{i}_lo, r.y{i}_hi, "
        f"cast({f'`{colours[s]}`' if s in colours else 'null'} as double)"
        for i, (s, (x, y)) in enumerate(pairs.items())
    )
    points = df.withColumn("r", ranges).selectExpr(f"stack({len(pairs)}, {rows}) AS (series, x, y, x0, x1, y0, y1, c)")
    points = points.filter(F.col("x").isNotNull() & F.col("y").isNotNull())

    def place(v: str, lo: str, hi: str) -> Column:
        at = F.try_divide(F.col(v) - F.col(lo), (F.col(hi) - F.col(lo)) / bins)
        return F.least(F.coalesce(F.floor(at), F.lit(0)).cast("int"), F.lit(bins - 1))

    return points.groupBy("series", place("x", "x0", "x1").alias("x_bin"), place("y", "y0", "y1").alias("y_bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("c").alias("colour")
    )

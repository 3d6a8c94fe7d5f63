"""Evaluation of rating predictions and recommendation lists.

Every metric is one aggregation pass (conditional counts instead of one filter-count job per threshold), and hit
tests are joins on (user, item), not driver-side dictionaries. Precision covers all users by default (D16).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemlens.functions import numeric as NX

# Error thresholds and precision cut-offs of the reference's evaluation.
ERROR_THRESHOLDS = [0.5, 1.0, 1.5, 2.0]
PRECISION_KS = [5, 10, 20]
RELEVANT_RATING = 4.0


def valid_predictions(scored: DataFrame, pred: str = "prediction") -> DataFrame:
    """rows with a usable prediction (not null and not NaN; NaN passes ``isNotNull``)."""
    return scored.filter(F.col(pred).isNotNull() & ~F.isnan(pred))


def regression_metrics(scored: DataFrame, label: str = "rating", pred: str = "prediction") -> DataFrame:
    """M9: rmse, mae, r2 and n over rows with a valid prediction, in one pass.

    ``r2 = 1 - SS_res / (n * var_pop(label))`` which is what ``RegressionEvaluator`` computes.
    """
    v = valid_predictions(scored, pred)
    err = F.col(label) - F.col(pred)
    return v.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(err * err), F.count(F.lit(1)) * F.var_pop(label))).alias("r2"),
        F.count(F.lit(1)).alias("n"),
    )


def cold_start_counts(scored: DataFrame, pred: str = "prediction") -> DataFrame:
    """Total scored rows, rows with a prediction, rows without (cold-start users or items)."""
    ok = F.col(pred).isNotNull() & ~F.isnan(pred)
    return scored.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(ok, 1)).alias("valid"),
        F.count(F.when(~ok | F.col(pred).isNull(), 1)).alias("missing"),
    )


def with_abs_error(scored: DataFrame, label: str = "rating", pred: str = "prediction") -> DataFrame:
    """Absolute error on valid rows."""
    return valid_predictions(scored, pred).withColumn("error", F.abs(F.col(label) - F.col(pred)))


def error_stats(scored: DataFrame, label: str = "rating", pred: str = "prediction") -> DataFrame:
    """A5: mean, sample std, min and max of the absolute error."""
    e = with_abs_error(scored, label, pred)
    return e.agg(
        F.avg("error").alias("mean_error"),
        F.stddev_samp("error").alias("std_error"),
        F.min("error").alias("min_error"),
        F.max("error").alias("max_error"),
    )


def error_shares(scored: DataFrame, thresholds=ERROR_THRESHOLDS, label="rating", pred="prediction") -> DataFrame:
    """Count and percentage of predictions within each error threshold (one pass, then unpivot)."""
    e = with_abs_error(scored, label, pred)
    wide = e.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("error") <= F.lit(t)).alias(f"t{i}") for i, t in enumerate(thresholds)],
    )
    pairs = ", ".join(f"CAST({t} AS DOUBLE), t{i}" for i, t in enumerate(thresholds))
    long = wide.selectExpr("total", f"stack({len(thresholds)}, {pairs}) as (threshold, n_within)")
    return long.select("threshold", "n_within", NX.percentage("n_within", "total").alias("pct_within"))


def prediction_bins(spark: SparkSession, scored: DataFrame, pred: str = "prediction") -> DataFrame:
    """Count and share of valid predictions per [low, high) bin plus a ``>= 5`` overflow bin.

    All bins are listed (a left join from the fixed five-row bin table, broadcast because its size is fixed).
    """
    v = valid_predictions(scored, pred)
    p = F.col(pred)
    label = None
    for lo, hi in NX.PREDICTION_BINS:
        cond = (p >= lo) & (p < hi)
        text = F.lit(f"[{lo:g}, {hi:g})")
        label = F.when(cond, text) if label is None else label.when(cond, text)
    top = NX.PREDICTION_BINS[-1][1]
    label = label.when(p >= top, F.lit(f">= {top:g}"))
    counts = v.withColumn("bin", label).filter(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n")
    )
    names = [f"[{lo:g}, {hi:g})" for lo, hi in NX.PREDICTION_BINS] + [f">= {top:g}"]
    bins = spark.createDataFrame([(i + 1, b) for i, b in enumerate(names)], "bin_order int, bin string")
    total = v.agg(F.count(F.lit(1))).scalar()
    out = F.broadcast(bins).join(counts, "bin", "left").select(
        "bin_order", "bin", F.coalesce("n", F.lit(0)).alias("n")
    )
    return out.withColumn("pct", NX.percentage("n", total))


def bias_report(scored: DataFrame, label: str = "rating", pred: str = "prediction") -> DataFrame:
    """Mean actual over all scored rows, mean prediction over valid rows, and their difference."""
    p = F.when(~F.isnan(pred), F.col(pred))
    return scored.agg(
        F.avg(label).alias("avg_actual"),
        F.avg(p).alias("avg_predicted"),
        (F.avg(p) - F.avg(label)).alias("bias"),
    )


def scored_report(scored: DataFrame, label: str = "rating", pred: str = "prediction", side: str = "side") -> DataFrame:
    """A5-A8, M9, M18, M20, M21 of scored rows in one aggregation, hence one pass over them: one row.

    ``side`` says ``'train'`` or ``'test'``; all figures but ``train_rmse`` and ``gap`` are of the test side. Columns: total,
    valid, missing, rmse, mae, r2, min_error, max_error, std_error, a ``pct_within_*`` per threshold, a ``pct_pred *`` per
    prediction bin, avg_actual, avg_predicted, bias, train_rmse, test_rmse, gap.
    """
    test, p = F.col(side) == "test", F.col(pred)
    usable = p.isNotNull() & ~F.isnan(p)
    ok = test & usable
    err = F.when(ok, F.col(label) - p)
    size, rating = F.abs(err), F.when(ok, F.col(label))
    n_ok = F.nullif(F.count_if(ok), F.lit(0))
    train_err = F.when((F.col(side) == "train") & usable, F.col(label) - p)
    shares = [
        (100 * F.count_if(ok & (size <= t)) / n_ok).alias("pct_within_" + str(t).replace(".", "_")) for t in ERROR_THRESHOLDS
    ]
    bins = [(f"[{lo:g}, {hi:g})", (p >= lo) & (p < hi)) for lo, hi in NX.PREDICTION_BINS]
    top = NX.PREDICTION_BINS[-1][1]
    bins.append((f">= {top:g}", p >= top))
    actual, predicted = F.avg(F.when(test, F.col(label))), F.avg(F.when(ok, p))
    train_rmse, rmse = F.sqrt(F.avg(train_err * train_err)), F.sqrt(F.avg(err * err))
    return scored.agg(
        F.count_if(test).alias("total"),
        F.count_if(ok).alias("valid"),
        F.count_if(test & ~F.coalesce(usable, F.lit(False))).alias("missing"),
        rmse.alias("rmse"),
        F.avg(size).alias("mae"),
        (1 - F.sum(err * err) / F.nullif(F.var_pop(rating) * F.count(rating), F.lit(0.0))).alias("r2"),
        F.min(size).alias("min_error"),
        F.max(size).alias("max_error"),
        F.stddev_samp(size).alias("std_error"),
        *shares,
        *((100 * F.count_if(ok & inside) / n_ok).alias(f"pct_pred {name}") for name, inside in bins),
        actual.alias("avg_actual"),
        predicted.alias("avg_predicted"),
        (predicted - actual).alias("bias"),
        train_rmse.alias("train_rmse"),
        rmse.alias("test_rmse"),
        (rmse - train_rmse).alias("gap"),
    )


def precision_at_k(recs: DataFrame, relevant: DataFrame, ks=PRECISION_KS, *, item_col: str = "item_id") -> DataFrame:
    """Q8: per K, total hits and total list length over all users with recommendations.

    ``recs`` is (user_id, pos, item_id) with 1-based positions; ``relevant`` is (user_id, item_id) of held-out liked
    items. A user without liked items still counts in the denominator with the length of its (cut) list, and a
    list shorter than K counts with its real length. Hits are a left join on (user, item): no driver-side sets.
    """
    rel = relevant.select("user_id", item_col).distinct().withColumn("_hit", F.lit(1))
    tagged = recs.join(rel, ["user_id", item_col], "left")
    aggs = []
    for k in ks:
        aggs += [
            F.count_if((F.col("pos") <= k) & F.col("_hit").isNotNull()).alias(f"h{k}"),
            F.count_if(F.col("pos") <= k).alias(f"n{k}"),
        ]
    wide = tagged.agg(*aggs)
    pairs = ", ".join(f"{k}, h{k}, n{k}" for k in ks)
    long = wide.selectExpr(f"stack({len(ks)}, {pairs}) as (k, hits, n_recs)")
    return long.withColumn("precision", F.coalesce(F.try_divide(F.col("hits"), F.col("n_recs")), F.lit(0.0)))


def coverage(recs: DataFrame, catalogue: DataFrame, *, item_col: str = "item_id") -> DataFrame:
    """Distinct recommended items over distinct catalogue items (scalar subqueries, no join)."""
    n_items = catalogue.agg(F.countDistinct(item_col)).scalar()
    return recs.agg(F.countDistinct(item_col).alias("n_recommended")).select(
        "n_recommended",
        F.lit(n_items).alias("n_items"),
        F.coalesce(F.try_divide(F.col("n_recommended"), F.lit(n_items)), F.lit(0.0)).alias("coverage"),
    )


def recommendation_frequency(recs: DataFrame, k: int | None = 10, *, item_col: str = "item_id") -> DataFrame:
    """How often each item is recommended, most frequent first (ties by id); ``k`` keeps the top rows."""
    freq = recs.groupBy(item_col).agg(F.count(F.lit(1)).alias("recommendation_count"))
    ordered = freq.orderBy(F.desc("recommendation_count"), item_col)
    return ordered.limit(k) if k else ordered


def frequency_stats(freq: DataFrame) -> DataFrame:
    """Mean, sample std, min and max of recommendation counts (over the rows of ``freq``)."""
    c = F.col("recommendation_count")
    return freq.agg(
        F.avg(c).alias("avg_recommendations"),
        F.stddev_samp(c).alias("std_recommendations"),
        F.min(c).alias("min_recommendations"),
        F.max(c).alias("max_recommendations"),
    )

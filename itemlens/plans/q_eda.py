"""Registered queries: exploratory statistics over the analysis frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from itemlens.functions import numeric as NX
from itemlens.operators import eda
from itemlens.operators.topk import truncate_label
from itemlens.plans import views as V
from itemlens.plans.oracle_views import with_views
from itemlens.plans.registry import register

CORR_FEATURES = ["budget", "revenue", "vote_count", "popularity", "runtime"]
HIST_BINS = 20


def r6(c):
    return F.round(c, 6)


def _genres(spark, d):
    a = V.analysis_items(spark, d)
    return eda.explode_list(a, "genres_list", "genre", ["id", "vote_average", "vote_count", "revenue", "budget"])


_GENRES_CTE = {"v_genres": "SELECT id, vote_average, vote_count, revenue, budget, UNNEST(genres_list) AS genre FROM v_analysis"}


@register("vote_by_year", operators="A9 F12", bench=True, sql=with_views(
    """SELECT release_year, round(avg(vote_average), 6) AS avg_rating, count(*) AS movie_count
FROM v_analysis WHERE release_year IS NOT NULL AND release_year > 0 GROUP BY release_year""", "v_analysis"))
def vote_by_year(spark, d):
    a = V.analysis_items(spark, d).filter(F.col("release_year") > 0)
    return a.filter(F.col("release_year").isNotNull()).groupBy("release_year").agg(
        r6(F.avg("vote_average")).alias("avg_rating"), F.count(F.lit(1)).alias("movie_count")
    )


@register("revenue_by_year", operators="A10", sql=with_views(
    """SELECT release_year, avg(revenue) AS avg_revenue
FROM v_analysis WHERE release_year IS NOT NULL GROUP BY release_year""", "v_analysis"))
def revenue_by_year(spark, d):
    m = eda.mean_by_key(V.analysis_items(spark, d), "release_year", "revenue", "avg_revenue")
    return m.select("release_year", F.col("avg_revenue"))


@register("category_top10", operators="A11 X8", sql=with_views(
    """SELECT genre, round(avg(vote_average), 6) AS avg_rating FROM v_genres WHERE genre IS NOT NULL
GROUP BY genre ORDER BY avg(vote_average) DESC, genre LIMIT 10""", "v_analysis", extra=_GENRES_CTE))
def category_top10(spark, d):
    top = eda.top_groups_by_mean(_genres(spark, d), "genre", "vote_average", 10, out="avg_rating")
    return top.select("genre", r6(F.col("avg_rating")).alias("avg_rating"))


@register("category_stats", operators="A12 F11 T7", sql=with_views(
    """SELECT genre, round(avg(vote_average), 6) AS avg_rating, count(*) AS movie_count,
       CAST(sum(vote_count) AS BIGINT) AS total_votes, avg(revenue) AS avg_revenue
FROM v_genres WHERE genre IS NOT NULL GROUP BY genre HAVING count(*) >= 10
ORDER BY avg(vote_average) DESC, genre LIMIT 10""", "v_analysis", extra=_GENRES_CTE))
def category_stats(spark, d):
    g = eda.group_profile(_genres(spark, d), "genre", min_count=10, k=10)
    return g.select("genre", r6(F.col("avg_rating")).alias("avg_rating"), "movie_count", "total_votes",
                    F.col("avg_revenue"))


@register("category_counts", operators="A13", sql=with_views(
    """SELECT genre, count(*) AS n FROM v_genres WHERE genre IS NOT NULL GROUP BY genre
ORDER BY n DESC, genre LIMIT 10""", "v_analysis", extra=_GENRES_CTE))
def category_counts(spark, d):
    return eda.value_counts(_genres(spark, d), "genre", k=10)


@register("category_box", operators="A23 A11 F11 P9", bench=True, sql=with_views(
    """SELECT CASE WHEN length(g.genre) > 15 THEN substr(g.genre, 1, 15) || '...' ELSE g.genre END AS label,
       g.genre, min(vote_average) AS min, round(quantile_cont(vote_average, 0.25), 6) AS q1,
       round(quantile_cont(vote_average, 0.5), 6) AS median, round(quantile_cont(vote_average, 0.75), 6) AS q3,
       max(vote_average) AS max, count(*) AS n
FROM v_genres g JOIN (SELECT genre FROM v_genres WHERE genre IS NOT NULL GROUP BY genre
                      ORDER BY avg(vote_average) DESC, genre LIMIT 5) t ON g.genre = t.genre
GROUP BY g.genre""", "v_analysis", extra=_GENRES_CTE))
def category_box(spark, d):
    g = _genres(spark, d)
    top5 = eda.top_groups_by_mean(g, "genre", "vote_average", 5).select("genre")
    box = eda.box_summary(g.join(top5, "genre", "left_semi"), "genre", "vote_average")
    return box.select(
        truncate_label("genre", 15).alias("label"), "genre", "min", r6(F.col("q1")).alias("q1"),
        r6(F.col("median")).alias("median"), r6(F.col("q3")).alias("q3"), "max", "n",
    )


@register("language_stats", operators="A14", sql=with_views(
    """SELECT original_language AS language, round(avg(vote_average), 6) AS avg_rating, count(*) AS movie_count,
       avg(revenue) AS avg_revenue
FROM v_analysis WHERE original_language IS NOT NULL GROUP BY original_language HAVING count(*) > 10""",
    "v_analysis"))
def language_stats(spark, d):
    a = V.analysis_items(spark, d).withColumnRenamed("original_language", "language")
    g = eda.group_profile(a, "language", votes=None, min_count=10, strict=True, k=None)
    return g.select("language", r6(F.col("avg_rating")).alias("avg_rating"), "movie_count",
                    F.col("avg_revenue"))


@register("doc_language_stats", operators="A14", sql=with_views(
    """SELECT lang, round(avg(quality), 6) AS avg_quality, count(*) AS n_docs, round(avg(n_chars), 6) AS avg_chars,
       round(avg(toxic), 6) AS toxic_share
FROM v_doc_labels WHERE lang IS NOT NULL GROUP BY lang HAVING count(*) > 10""", "v_doc_labels"))
def doc_language_stats(spark, d):
    dl = V.doc_labels(spark, d)
    return dl.filter(F.col("lang").isNotNull()).groupBy("lang").agg(
        r6(F.avg("quality")).alias("avg_quality"), F.count(F.lit(1)).alias("n_docs"),
        r6(F.avg("n_chars")).alias("avg_chars"), r6(F.avg("toxic")).alias("toxic_share"),
    ).filter(F.col("n_docs") > 10)


_WINSOR_CTE = {
    "q": "SELECT quantile_cont(runtime, 0.01) AS lo, quantile_cont(runtime, 0.99) AS hi FROM v_analysis",
    "w": """SELECT a.*, CASE WHEN a.runtime IS NULL THEN NULL ELSE least(greatest(a.runtime, q.lo), q.hi) END
              AS runtime_clean FROM v_analysis a, q""",
}
_BIN_CASE = " ".join(
    f"WHEN runtime_clean > {lo} AND runtime_clean <= {hi} THEN '{lab}'"
    for lo, hi, lab in zip(NX.RUNTIME_EDGES[:-1], NX.RUNTIME_EDGES[1:], NX.RUNTIME_LABELS)
)
_BIN_VALUES = ", ".join(f"({i + 1}, '{lab}')" for i, lab in enumerate(NX.RUNTIME_LABELS))


@register("runtime_bins", operators="A15 X14 X12 A16", sql=with_views(
    f"""SELECT b.bin_order, b.runtime_bin, round(s.avg_rating, 6) AS avg_rating, coalesce(s.movie_count, 0) AS movie_count
FROM (VALUES {_BIN_VALUES}) b(bin_order, runtime_bin)
LEFT JOIN (SELECT CASE {_BIN_CASE} END AS runtime_bin, avg(vote_average) AS avg_rating, count(*) AS movie_count
           FROM w GROUP BY 1) s ON b.runtime_bin = s.runtime_bin""", "v_analysis", extra=_WINSOR_CTE))
def runtime_bins(spark, d):
    out = eda.runtime_bin_means(spark, V.analysis_items(spark, d))
    return out.select("bin_order", "runtime_bin", r6(F.col("avg_rating")).alias("avg_rating"), "movie_count")


@register("runtime_winsor", operators="A16 A17 X12", sql=with_views(
    """SELECT round(max(q.lo), 6) AS q01, round(max(q.hi), 6) AS q99, round(min(runtime_clean), 6) AS min_clean,
       round(max(runtime_clean), 6) AS max_clean FROM w, q""", "v_analysis", extra=_WINSOR_CTE))
def runtime_winsor(spark, d):
    a = V.analysis_items(spark, d)
    q = eda.quantiles(a, "runtime", [0.01, 0.99])
    lo, hi = q.select("q01").scalar(), q.select("q99").scalar()
    w = a.select(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), NX.clip("runtime", lo, hi).alias("runtime_clean"))
    return w.agg(
        r6(F.max("lo")).alias("q01"), r6(F.max("hi")).alias("q99"),
        r6(F.min("runtime_clean")).alias("min_clean"), r6(F.max("runtime_clean")).alias("max_clean"),
    )


@register("rating_summary", operators="A18", sql=with_views(
    """SELECT count(vote_average) AS n, round(avg(vote_average), 6) AS mean, round(median(vote_average), 6) AS median,
       round(stddev_samp(vote_average), 6) AS std FROM v_analysis""", "v_analysis"))
def rating_summary(spark, d):
    s = eda.summary(V.analysis_items(spark, d), "vote_average")
    return s.select("n", r6(F.col("mean")).alias("mean"), r6(F.col("median")).alias("median"),
                    r6(F.col("std")).alias("std"))


@register("rating_correlations", operators="A19", sql=with_views(
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(corr({f}, vote_average), 6) AS corr FROM v_analysis" for f in CORR_FEATURES
    ), "v_analysis"))
def rating_correlations(spark, d):
    c = eda.correlations(V.analysis_items(spark, d), "vote_average", CORR_FEATURES)
    return c.select("feature", r6(F.col("corr")).alias("corr"))


@register("era_compare", operators="A20 F13", sql=with_views(
    """SELECT round(avg(CASE WHEN release_year >= 2010 THEN vote_average END), 6) AS avg_recent,
       round(avg(CASE WHEN release_year < 2010 THEN vote_average END), 6) AS avg_older,
       round(avg(CASE WHEN release_year >= 2010 THEN vote_average END)
             - avg(CASE WHEN release_year < 2010 THEN vote_average END), 6) AS difference FROM v_analysis""",
    "v_analysis"))
def era_compare(spark, d):
    e = eda.era_compare(V.analysis_items(spark, d))
    return e.select(*[r6(F.col(c)).alias(c) for c in e.columns])


@register("budget_cohorts", operators="A21 F13", sql=with_views(
    """SELECT max(m.med) AS median_split,
       round(avg(CASE WHEN budget > m.med THEN vote_average END), 6) AS avg_high,
       round(avg(CASE WHEN budget <= m.med THEN vote_average END), 6) AS avg_low,
       count(CASE WHEN budget > m.med THEN 1 END) AS n_high, count(CASE WHEN budget <= m.med THEN 1 END) AS n_low
FROM v_analysis, (SELECT median(budget) AS med FROM v_analysis) m""", "v_analysis"))
def budget_cohorts(spark, d):
    c = eda.cohort_split_by_median(V.analysis_items(spark, d), "budget", "vote_average")
    return c.select(F.col("median_split"), r6(F.col("avg_high")).alias("avg_high"),
                    r6(F.col("avg_low")).alias("avg_low"), "n_high", "n_low")


def _hist_sql(expr: str) -> str:
    return with_views(
        f"""SELECT bin, round(lo + bin * ((hi - lo) / {HIST_BINS}), 6) AS lower,
       round(lo + (bin + 1) * ((hi - lo) / {HIST_BINS}), 6) AS upper, count(*) AS n
FROM (SELECT CAST(least(coalesce(floor((v - lo) / ((hi - lo) / {HIST_BINS})), 0), {HIST_BINS - 1}) AS INTEGER) AS bin,
             lo, hi
      FROM (SELECT {expr} AS v FROM v_analysis) x,
           (SELECT min({expr}) AS lo, max({expr}) AS hi FROM v_analysis) r
      WHERE v IS NOT NULL) t
GROUP BY bin, lo, hi""",
        "v_analysis",
    )


def _hist(df, col):
    h = eda.histogram(df, col, HIST_BINS)
    return h.select("bin", r6(F.col("lower")).alias("lower"), r6(F.col("upper")).alias("upper"), "n")


@register("hist_log_revenue", operators="A22 X11", sql=_hist_sql("ln(1 + revenue)"))
def hist_log_revenue(spark, d):
    return _hist(V.analysis_items(spark, d), F.log1p("revenue"))


@register("hist_rating", operators="A22", sql=_hist_sql("vote_average"))
def hist_rating(spark, d):
    return _hist(V.analysis_items(spark, d), "vote_average")


@register("scatter_extracts", operators="Q14 X11 P1", sql=with_views(
    """SELECT id, round(ln(1 + budget), 6) AS budget_log, round(ln(1 + revenue), 6) AS revenue_log,
       round(ln(1 + vote_count), 6) AS votes_log, round(ln(1 + popularity), 6) AS popularity_log,
       vote_average FROM v_analysis""", "v_analysis"))
def scatter_extracts(spark, d):
    a = V.analysis_items(spark, d)
    return a.select(
        "id", r6(F.log1p("budget")).alias("budget_log"), r6(F.log1p("revenue")).alias("revenue_log"),
        r6(F.log1p("vote_count")).alias("votes_log"), r6(F.log1p("popularity")).alias("popularity_log"),
        "vote_average",
    )


@register("profit_margin", operators="X13 X12", sql=with_views(
    """SELECT id, round((revenue - budget) / greatest(revenue, 1), 6) AS profit_margin,
       round(least(greatest((revenue - budget) / greatest(revenue, 1), -1), 1), 6) AS margin_clipped,
       vote_average FROM v_analysis""", "v_analysis"))
def profit_margin(spark, d):
    a = V.analysis_items(spark, d)
    m = NX.profit_margin("revenue", "budget")
    return a.select("id", r6(m).alias("profit_margin"), r6(NX.clip(m, -1, 1)).alias("margin_clipped"), "vote_average")


@register("scatter_density", operators="Q14 (2-D bins)", sql=with_views(
    f"""SELECT CAST(least(coalesce(floor((x - x0) / ((x1 - x0) / {HIST_BINS})), 0), {HIST_BINS - 1}) AS INTEGER) AS x_bin,
       CAST(least(coalesce(floor((y - y0) / ((y1 - y0) / {HIST_BINS})), 0), {HIST_BINS - 1}) AS INTEGER) AS y_bin,
       count(*) AS n
FROM (SELECT ln(1 + budget) AS x, vote_average AS y FROM v_analysis WHERE budget IS NOT NULL AND vote_average IS NOT NULL) p,
     (SELECT min(ln(1 + budget)) AS x0, max(ln(1 + budget)) AS x1, min(vote_average) AS y0, max(vote_average) AS y1
      FROM v_analysis WHERE budget IS NOT NULL AND vote_average IS NOT NULL) r
GROUP BY 1, 2""", "v_analysis"))
def scatter_density(spark, d):
    a = V.analysis_items(spark, d).withColumn("budget_log", F.log1p("budget"))
    return eda.density_grid(a, "budget_log", "vote_average", HIST_BINS)

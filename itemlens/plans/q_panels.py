"""Registered queries: the chart-data panels and summaries (Q11-Q13, Q15, S6) as tall frames.

A panel is the union of aggregates that are registered on their own; its oracle SQL is the ``UNION ALL`` of their
oracle SQL. Rows are ``(panel, series, x_label, x_value, y)``: categorical x in ``x_label``, numeric x in ``x_value``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemlens.functions import numeric as NX
from itemlens.operators import eda
from itemlens.operators.topk import truncate_label
from itemlens.plans import q_eda, q_ml, q_recs
from itemlens.plans import views as V
from itemlens.plans.oracle_views import with_views
from itemlens.plans.registry import REGISTRY, register
from itemlens.session import scratch_path
from itemlens.sources import sinks

PREVIEW_ROWS = 5
PREVIEW_WIDTH = 8


def _part(df: DataFrame, panel: str, series: str, *, y: str, x_label: str | None = None, x_value: str | None = None):
    return df.select(
        F.lit(panel).alias("panel"),
        F.lit(series).alias("series"),
        (F.col(x_label).cast("string") if x_label else F.lit(None).cast("string")).alias("x_label"),
        (F.col(x_value).cast("double") if x_value else F.lit(None).cast("double")).alias("x_value"),
        F.col(y).cast("double").alias("y"),
    )


def _sql_part(query: str, panel: str, series: str, *, y: str, x_label: str | None = None, x_value: str | None = None,
              where: str | None = None) -> str:
    xl = f"CAST({x_label} AS VARCHAR)" if x_label else "CAST(NULL AS VARCHAR)"
    xv = f"CAST({x_value} AS DOUBLE)" if x_value else "CAST(NULL AS DOUBLE)"
    w = f" WHERE {where}" if where else ""
    return (
        f"SELECT '{panel}' AS panel, '{series}' AS series, {xl} AS x_label, {xv} AS x_value, "
        f"CAST({y} AS DOUBLE) AS y FROM ({REGISTRY[query].sql}) t{w}"
    )


def _union(parts):
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------------------------------------- Q11 EDA panel

_EDA_PARTS = [
    ("hist_log_revenue", "revenue_log_histogram", dict(y="n", x_value="lower")),
    ("hist_rating", "rating_histogram", dict(y="n", x_value="lower")),
    ("revenue_by_year", "revenue_by_year", dict(y="avg_revenue", x_value="release_year")),
    ("category_top10", "top_genres_by_rating", dict(y="avg_rating", x_label="genre")),
]


_EDA_GRIDS = {"budget_vs_revenue": ("budget", "revenue"), "votes_vs_rating": ("vote_count", "vote_average")}
# A chart's points are coloured by the mean of a third column: a second series over the same cells.
_EDA_COLOURS = {"votes_vs_rating": "revenue"}
_GRID_BINS = 20


def _grid_sql(panel: str, series: str, x: str, y: str, source: str, colour: str | None = None) -> str:
    """One scatter chart as 2-D bins: x bin in ``x_value``, y bin in ``x_label``, points (or the mean ``colour``) in ``y``."""
    shown, more = (f"avg({colour})", f", CAST({colour} AS DOUBLE) AS {colour}") if colour else ("CAST(count(*) AS DOUBLE)", "")
    series = f"{series}_{colour}" if colour else series
    def place(v: str) -> str:
        at = f"floor(({v} - {v}0) / nullif(({v}1 - {v}0) / {_GRID_BINS}, 0))"
        return f"CAST(least(coalesce({at}, 0), {_GRID_BINS - 1}) AS INTEGER)"

    return (
        f"SELECT '{panel}' AS panel, '{series}' AS series, CAST({place('y')} AS VARCHAR) AS x_label, "
        f"CAST({place('x')} AS DOUBLE) AS x_value, {shown} AS y FROM "
        f"(SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y{more} FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL) p, "
        f"(SELECT CAST(min({x}) AS DOUBLE) AS x0, CAST(max({x}) AS DOUBLE) AS x1, CAST(min({y}) AS DOUBLE) AS y0, "
        f"CAST(max({y}) AS DOUBLE) AS y1 FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL) r GROUP BY 1, 2, 3, 4"
    )


def _grids(df: DataFrame, panel: str, pairs: dict, colours: dict | None = None) -> DataFrame:
    g = eda.density_grids(df, pairs, _GRID_BINS, colours)
    shown = F.array(F.struct(F.lit("").alias("end"), F.col("n").cast("double").alias("y")))
    for series, colour in (colours or {}).items():
        more = F.array(F.struct(F.lit(f"_{colour}").alias("end"), F.col("colour").alias("y")))
        shown = F.when(F.col("series") == series, F.concat(shown, more)).otherwise(shown)
    return g.withColumn("shown", F.explode(shown)).select(
        F.lit(panel).alias("panel"), F.concat("series", "shown.end").alias("series"), F.col("y_bin").cast("string").alias("x_label"),
        F.col("x_bin").cast("double").alias("x_value"), F.col("shown.y").alias("y"),
    )


_MARGIN = (
    "(SELECT *, least(greatest((revenue - budget) / greatest(revenue, 1), -1), 1) AS margin_clipped, "
    + ", ".join(f"ln(1 + {c}) AS {c}_log" for c in ("budget", "revenue", "vote_count", "popularity"))
    + " FROM v_analysis)"
)


def _grids_sql(panel: str, pairs: dict, source: str, colours: dict | None = None) -> str:
    parts = [_grid_sql(panel, s, x, y, source) for s, (x, y) in pairs.items()]
    parts += [_grid_sql(panel, s, *pairs[s], source, colour) for s, colour in (colours or {}).items()]
    return with_views(" UNION ALL ".join(parts), "v_analysis")


@register("eda_panel", operators="Q11 Q14 X11 A22 A10 A11", sql=" UNION ALL ".join(
    [_sql_part(q, "eda", s, **kw) for q, s, kw in _EDA_PARTS]
    + [f"SELECT * FROM ({_grids_sql('eda', _EDA_GRIDS, 'v_analysis', _EDA_COLOURS)}) g"]))
def eda_panel(spark, d):
    parts = [_part(REGISTRY[q].build(spark, d), "eda", s, **kw) for q, s, kw in _EDA_PARTS]
    return _union([*parts, _grids(V.analysis_items(spark, d), "eda", _EDA_GRIDS, _EDA_COLOURS)])


# ----------------------------------------------------------------------------------------- Q12 rating factor panel

_BOX_STATS = ["min", "q1", "median", "q3", "max"]
_FACTOR_PARTS = [
    ("runtime_bins", "rating_by_runtime", dict(y="avg_rating", x_label="runtime_bin")),
    ("vote_by_year", "rating_by_year", dict(y="avg_rating", x_value="release_year")),
    ("language_stats", "rating_by_language", dict(y="avg_rating", x_label="language")),
]
# Heavy-tailed columns are shown by their logarithm; the margin is clipped.
_FACTOR_GRIDS = {
    f"{x}_vs_rating": (x, "vote_average") for x in ("budget_log", "revenue_log", "vote_count_log", "margin_clipped", "popularity_log")
}


def _lang_top10_sql() -> str:
    return f"SELECT * FROM ({REGISTRY['language_stats'].sql}) l ORDER BY avg_rating DESC, language LIMIT 10"


@register("rating_factor_panel", operators="Q12 Q14 A23 A15 X13 X14 A9 A14", bench=True, sql=" UNION ALL ".join(
    [_sql_part("category_box", "rating_factors", f"genre_box_{st}", y=st, x_label="genre") for st in _BOX_STATS]
    + [_sql_part(q, "rating_factors", s, **kw) if q != "language_stats" else
       _sql_part(q, "rating_factors", s, **kw).replace(f"FROM ({REGISTRY[q].sql}) t", f"FROM ({_lang_top10_sql()}) t")
       for q, s, kw in _FACTOR_PARTS]
    + [f"SELECT * FROM ({_grids_sql('rating_factors', _FACTOR_GRIDS, _MARGIN)}) g"]))
def rating_factor_panel(spark, d):
    """Nine charts. Every part is built once; the box summary's five statistics are unpivoted from one row per genre, and
    the five scatter charts share two passes."""
    pairs = ", ".join(f"'genre_box_{st}', cast({st} as double)" for st in _BOX_STATS)
    box = REGISTRY["category_box"].build(spark, d).selectExpr(
        "'rating_factors' AS panel", "genre AS x_label", "cast(null as double) AS x_value",
        f"stack({len(_BOX_STATS)}, {pairs}) AS (series, y)",
    ).select("panel", "series", "x_label", "x_value", "y")
    parts = [box]
    for q, s, kw in _FACTOR_PARTS:
        df = REGISTRY[q].build(spark, d)
        if q == "language_stats":
            df = df.orderBy(F.desc("avg_rating"), "language").limit(10)
        parts.append(_part(df, "rating_factors", s, **kw))
    a = V.analysis_items(spark, d)
    a = a.withColumn("margin_clipped", NX.clip(NX.profit_margin("revenue", "budget"), -1, 1))
    a = a.withColumns({f"{c}_log": F.log1p(c) for c in ("budget", "revenue", "vote_count", "popularity")})
    return _union([*parts, _grids(a, "rating_factors", _FACTOR_GRIDS)])


# -------------------------------------------------------------------------------------------- Q13 insight summary

_SUMMARY_METRICS = [
    ("rating_summary", "summary", ["n", "mean", "median", "std"]),
    ("era_compare", "era", ["avg_recent", "avg_older", "difference"]),
    ("budget_cohorts", "budget", ["median_split", "avg_high", "avg_low", "n_high", "n_low"]),
]


_GENRE_COLUMNS = ["avg_rating", "movie_count", "total_votes", "avg_revenue"]


def _insight_sql() -> str:
    parts = []
    for q, section, cols in _SUMMARY_METRICS:
        for c in cols:
            parts.append(
                f"SELECT '{section}' AS section, '{c}' AS metric, CAST({c} AS DOUBLE) AS value "
                f"FROM ({REGISTRY[q].sql}) t"
            )
    parts.append(
        "SELECT 'correlation' AS section, feature AS metric, CAST(corr AS DOUBLE) AS value "
        f"FROM ({REGISTRY['rating_correlations'].sql}) t"
    )
    for c in _GENRE_COLUMNS:
        parts.append(
            f"SELECT 'top_genres {c}' AS section, genre AS metric, CAST({c} AS DOUBLE) AS value "
            f"FROM ({REGISTRY['category_stats'].sql}) t"
        )
    return " UNION ALL ".join(parts)


@register("insight_summary", operators="Q13 A12 A18 A19 A20 A21", sql=_insight_sql())
def insight_summary(spark, d):
    """Every part is built once and unpivoted."""
    parts = []
    for q, section, cols in _SUMMARY_METRICS:
        pairs = ", ".join(f"'{c}', cast({c} as double)" for c in cols)
        parts.append(REGISTRY[q].build(spark, d).selectExpr(f"'{section}' AS section", f"stack({len(cols)}, {pairs}) AS (metric, value)"))
    corr = REGISTRY["rating_correlations"].build(spark, d)
    parts.append(corr.selectExpr("'correlation' AS section", "feature AS metric", "cast(corr as double) AS value"))
    pairs = ", ".join(f"'top_genres {c}', cast({c} as double)" for c in _GENRE_COLUMNS)
    genres = REGISTRY["category_stats"].build(spark, d)
    genres = genres.selectExpr("genre AS metric", f"stack({len(_GENRE_COLUMNS)}, {pairs}) AS (section, value)")
    parts.append(genres.select("section", "metric", "value"))
    return _union(parts)


@register("chart_series", operators="S10 Q11", sql=_sql_part("vote_by_year", "factors", "rating_by_year", y="avg_rating", x_value="release_year"))
def chart_series(spark, d):
    """A chart's data written through the sink and read back."""
    path = scratch_path(spark, "chart-series")
    part = _part(REGISTRY["vote_by_year"].build(spark, d), "factors", "rating_by_year", y="avg_rating", x_value="release_year")
    sinks.write_series(part, path, partition_by=["panel"])
    return spark.read.parquet(path).select("panel", "series", "x_label", "x_value", "y")


# ------------------------------------------------------------------------------------------------- S6 preview


@register("preview_rows", operators="S6 P9 T4 P1", sql=with_views(
    f"""SELECT item_id, CASE WHEN length(title) > {PREVIEW_WIDTH} THEN substr(title, 1, {PREVIEW_WIDTH}) || '...'
       ELSE title END AS title, budget, revenue, vote_average, vote_count
FROM v_items ORDER BY item_id LIMIT {PREVIEW_ROWS}""", "v_items"))
def preview_rows(spark, d):
    """The first rows of the catalogue in id order (a preview: the limit is the feature), labels truncated."""
    it = V.items(spark, d)
    return it.select(
        "item_id", truncate_label("title", PREVIEW_WIDTH).alias("title"), "budget", "revenue", "vote_average",
        "vote_count",
    ).orderBy("item_id").limit(PREVIEW_ROWS)


# ------------------------------------------------------------------------------------------- Q15 run summary


@register("run_summary", operators="Q15 Q9 M9 M11 M21 Q8 A5 A6 A24 A27", bench=True, sql=None)
def run_summary(spark, d):
    """End-of-run summary: both regression comparison tables, and of the ALS model its error metrics and shares, sample
    counts, train/test gap, factor sizes, coverage and precision. Each part is built once and unpivoted."""
    parts = []
    for q in ("regression_compare_revenue", "regression_compare_vote"):
        t = REGISTRY[q].build(spark, d)
        pairs = "concat(model, ' rmse'), cast(rmse as double), concat(model, ' r2'), cast(r2 as double)"
        parts.append(t.selectExpr("concat('regression ', target) AS section", f"stack(2, {pairs}) AS (metric, value)"))
    als = q_ml.als_quality_report(spark, d)
    parts.append(als.select(F.lit("als").alias("section"), "metric", "value"))
    prec = q_ml.als_precision_at_k(spark, d)
    parts.append(prec.select(F.lit("als").alias("section"), F.concat(F.lit("precision@"), F.col("k").cast("string")).alias("metric"),
                             F.col("precision").cast("double").alias("value")))
    return _union(parts)


# q_eda and q_recs are imported so the queries this module unions are registered before its SQL is composed.
_ = (q_eda, q_recs)

"""Registered queries: sources, id mapping, joins and the most-rated report."""

from __future__ import annotations

from pyspark.sql import functions as F

from itemlens.operators import joins, topk
from itemlens.plans import views as V
from itemlens.plans.oracle_views import with_views
from itemlens.plans.registry import register
from itemlens.sources import catalog

# The user the reference's per-user lookups are run for (its smoke calls use user 1).
LOOKUP_USER = 1


@register(
    "most_rated_titles",
    operators="A1 A25 J6 T2 T5",
    bench=True,
    sql=with_views(
        """SELECT r.item_id, i.title, r.n_ratings, r.avg_rating
FROM (SELECT item_id, count(*) AS n_ratings, round(avg(rating), 6) AS avg_rating
      FROM v_ratings GROUP BY item_id ORDER BY n_ratings DESC, item_id LIMIT 10) r
JOIN v_items i ON r.item_id = i.item_id""",
        "v_ratings",
        "v_items",
    ),
)
def most_rated_titles(spark, d):
    """Top-10 most-rated items with their titles (a top-k report: the limit is the feature)."""
    freq = V.ratings(spark, d).groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n_ratings"), F.round(F.avg("rating"), 6).alias("avg_rating")
    )
    top = topk.top_k(freq, 10, [F.desc("n_ratings"), "item_id"])
    # The top-k side is at most 10 rows by construction: a proven-small broadcast.
    return (
        V.items(spark, d)
        .select("item_id", "title")
        .join(F.broadcast(top), "item_id")
        .select("item_id", "title", "n_ratings", "avg_rating")
        .orderBy(F.desc("n_ratings"), "item_id")
    )


@register(
    "load_report",
    operators="S3 S4 A1",
    sql=" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in catalog.TABLES),
)
def load_report(spark, d):
    return catalog.load_report(spark, d)

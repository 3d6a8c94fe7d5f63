"""Joins of the workload (J1-J9) as equi-joins the optimizer can place.

Broadcasts: Spark's adaptive execution already turns a sort-merge join into a broadcast hash join when the runtime
size of a side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; that is a size check made on the real
shuffle output, with the shuffle join as the fallback. An explicit :func:`F.broadcast` is used only for sides whose
size is bounded by construction (one row from a global aggregate, a fixed bin table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemlens.operators.skew import salted_join


def map_ids(ratings: DataFrame, links: DataFrame, titles: DataFrame, *, item_col: str = "item_id") -> DataFrame:
    """Re-key ratings from the ratings id space to the catalogue id space and attach titles.

    ``links`` maps ``movie_id -> tmdb_id``; ``titles`` is deduplicated on ``tmdb_id`` first (lowest title wins) so a
    duplicated catalogue id cannot fan out ratings (D14). Null ``tmdb_id`` rows drop at the inner join.

    The two catalogue-sized tables are joined first, so the ratings are shuffled once; that join is salted where an item
    holds a large share of the ratings (:func:`itemlens.operators.skew.salted_join`).
    """
    dedup_titles = titles.groupBy("tmdb_id").agg(F.min("title").alias("title"))
    named = links.select("movie_id", "tmdb_id").join(dedup_titles, "tmdb_id")
    rated = ratings.withColumnRenamed(item_col, "movie_id")
    return salted_join(rated, named, "movie_id", ["user_id"]).select("user_id", "tmdb_id", "title", "rating")


def unrated_items(items: DataFrame, ratings: DataFrame, user_id, *, item_col: str = "item_id") -> DataFrame:
    """Distinct catalogue items the user has not rated (``left_anti`` on the shared key), tagged with the user.

    ``lit(user_id)`` replaces the ``movieId * 0 + user`` trick (P5): it is never null.
    """
    rated = ratings.filter(F.col("user_id") == F.lit(user_id)).select(item_col)
    return (
        items.select(item_col)
        .distinct()
        .join(rated, item_col, "left_anti")
        .withColumn("user_id", F.lit(user_id).cast("long"))
    )


def unrated_items_cond(items: DataFrame, ratings: DataFrame, user_id, *, item_col: str = "item_id") -> DataFrame:
    """The same anti-join written with an explicit join condition (gives the same rows as J4)."""
    all_items = items.select(item_col).distinct().alias("a")
    rated = ratings.filter(F.col("user_id") == F.lit(user_id)).select(item_col).distinct().alias("r")
    cond: Column = F.col(f"a.{item_col}") == F.col(f"r.{item_col}")
    return all_items.join(rated, cond, "left_anti").select(
        F.col(f"a.{item_col}").alias(item_col), F.lit(user_id).cast("long").alias("user_id")
    )


def with_titles(
    df: DataFrame,
    titles: DataFrame,
    *,
    key: str,
    default_prefix: str | None = None,
    default_id: str | None = None,
) -> DataFrame:
    """Attach a title to every row by key.

    With ``default_prefix`` this is a left join and a missing title becomes ``'<prefix> <id>'`` (X18), the id taken
    from ``default_id`` (the key by default): one join for all rows instead of one lookup per row. Titles are
    deduplicated on the key (lowest title) so rows never fan out.
    """
    dedup = titles.groupBy(key).agg(F.min("title").alias("title"))
    if default_prefix is None:
        return df.join(dedup, key)
    out = df.join(dedup, key, "left")
    label = F.concat(F.lit(default_prefix + " "), F.col(default_id or key).cast("string"))
    return out.withColumn("title", F.coalesce(F.col("title"), label))

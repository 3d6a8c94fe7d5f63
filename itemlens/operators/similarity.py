"""Similar-item search.

The target vector is a scalar subquery (one row by construction: a global ``min_by`` aggregate), so every item is
scored by a projection against an inlined value: no cross join, no broadcast variable and no Python worker. The top
``k`` is a ``TakeOrderedAndProject`` (each task keeps its own best ``k``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemlens.functions.vectors import cosine


def similar_items(
    vectors: DataFrame,
    target_id,
    k: int = 10,
    *,
    id_col: str = "id",
    vec_col: str = "features",
) -> DataFrame:
    """The ``k`` items most cosine-similar to ``target_id`` (itself excluded), best first, ties by id.

    Returns ``(id_col, similarity)`` plus the other columns of ``vectors`` except the vector. An unknown target gives an
    empty result.
    """
    target = vectors.filter(F.col(id_col) == F.lit(target_id)).agg(F.min_by(vec_col, id_col)).scalar()
    keep = [c for c in vectors.columns if c not in (vec_col,)]
    scored = (
        vectors.withColumn("_target", target)
        .filter(F.col("_target").isNotNull() & (F.col(id_col) != F.lit(target_id)))
        .select(*keep, cosine(vec_col, "_target").alias("similarity"))
    )
    return scored.orderBy(F.desc("similarity"), id_col).limit(k)


def similar_items_by_title(
    vectors: DataFrame,
    titles: DataFrame,
    title: str,
    k: int = 10,
    *,
    id_col: str = "id",
    vec_col: str = "features",
    title_col: str = "title",
) -> DataFrame:
    """Q5 by title: the title's lowest id is the target (duplicate titles, D14); results carry their titles and stay
    ordered by similarity after the title join (D3)."""
    target_id = titles.filter(F.col(title_col) == F.lit(title)).agg(F.min(id_col)).scalar()
    target = vectors.withColumn("_tid", target_id).filter(F.col(id_col) == F.col("_tid")).agg(
        F.min_by(vec_col, id_col)
    ).scalar()
    scored = (
        vectors.withColumn("_target", target)
        .withColumn("_tid", target_id)
        .filter(F.col("_target").isNotNull() & (F.col(id_col) != F.col("_tid")))
        .select(id_col, cosine(vec_col, "_target").alias("similarity"))
    )
    top = scored.orderBy(F.desc("similarity"), id_col).limit(k)
    # ``top`` holds at most k rows: a proven-small broadcast. Titles are cut to those ids before deduplication, so
    # only k keys reach the aggregation's shuffle.
    named = (
        titles.join(F.broadcast(top.select(id_col)), id_col, "left_semi")
        .groupBy(id_col)
        .agg(F.min(title_col).alias(title_col))
    )
    return named.join(F.broadcast(top), id_col).select(id_col, title_col, "similarity").orderBy(
        F.desc("similarity"), id_col
    )

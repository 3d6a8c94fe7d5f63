"""Registered queries: id mapping and joins (Q4, J1-J8), similarity (Q5 on vectors), splits (R1-R4), prediction
metrics on an item-mean predictor (M9, A5-A8, M20), and list metrics on a deterministic recommender (Q8-Q10, A24-A26).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from itemlens.operators import evaluate as EV
from itemlens.operators import joins, recommend, similarity, split, topk
from itemlens.plans import views as V
from itemlens.plans.oracle_views import with_views
from itemlens.plans.registry import register

# Fixed parameters of the registered lookups: the user of the per-user queries and the target vector of the
# similarity query (the reference's smoke calls use user 1 and a fixed title).
LOOKUP_USER = 1
TARGET_VEC = 7
TOP_N = 10
LOOKUP_TITLE = "label 3"
NO_TITLE = "no such label"
REPORT_USERS, REPORT_HELD = 3, 5
TRAIN_PCT = 80
SAMPLE_FRACTION = 0.25  # share of the rows that the sampling queries keep


def r6(c):
    return F.round(c, 6)


# --------------------------------------------------------------------------------------------- splits and scoring

_HASH = "CAST(('0x' || substr(md5({key}), 1, 7)) AS BIGINT) % 100"
_PAIR_KEY = "CAST(user_id AS VARCHAR) || '|' || CAST(item_id AS VARCHAR)"
SPLIT_CTES = {
    "v_split": f"SELECT user_id, item_id, rating, {_HASH.format(key=_PAIR_KEY)} AS bucket FROM v_ratings",
    "v_train": f"SELECT user_id, item_id, rating FROM v_split WHERE bucket < {TRAIN_PCT}",
    "v_test": f"SELECT user_id, item_id, rating FROM v_split WHERE bucket >= {TRAIN_PCT}",
    "v_item_mean": "SELECT item_id, round(avg(rating), 6) AS prediction FROM v_train GROUP BY item_id",
    "v_scored": "SELECT t.user_id, t.item_id, t.rating, m.prediction FROM v_test t LEFT JOIN v_item_mean m "
    "ON t.item_id = m.item_id",
    "v_valid": "SELECT *, abs(rating - prediction) AS error FROM v_scored WHERE prediction IS NOT NULL",
}
RECS_CTES = dict(SPLIT_CTES)
RECS_CTES["v_recs"] = f"""SELECT user_id, CAST(pos AS INTEGER) AS pos, item_id, prediction FROM (
    SELECT u.user_id, m.item_id, m.prediction,
           row_number() OVER (PARTITION BY u.user_id ORDER BY m.prediction DESC, m.item_id) AS pos
    FROM (SELECT DISTINCT user_id FROM v_train) u CROSS JOIN v_item_mean m
    WHERE NOT EXISTS (SELECT 1 FROM v_train t WHERE t.user_id = u.user_id AND t.item_id = m.item_id)) x
  WHERE pos <= {recommend.RECS_PER_USER}"""
RECS_CTES["v_relevant"] = f"SELECT DISTINCT user_id, item_id FROM v_test WHERE rating >= {EV.RELEVANT_RATING}"


def _split(spark, d):
    return split.hash_split(V.ratings(spark, d), ["user_id", "item_id"], TRAIN_PCT)


def _scored(spark, d):
    train, test = _split(spark, d)
    return recommend.score_by_item_mean(train, test)


def _recs(spark, d):
    """The deterministic recommender: each training user's top-20 unseen items by item-mean score."""
    train, _ = _split(spark, d)
    scores = recommend.item_mean_scores(train)
    # The ratings view has one row per (user, item): its group-by key.
    return recommend.top_k_unseen(scores, train, train.select("user_id"), recommend.RECS_PER_USER, seen_unique=True)


def _relevant(spark, d):
    _, test = _split(spark, d)
    return test.filter(F.col("rating") >= EV.RELEVANT_RATING).select("user_id", "item_id")


# ----------------------------------------------------------------------------------------------- joins and ids


@register("ratings_with_titles", operators="Q4 J1 J2 J6 P1", bench=True, sql=with_views(
    """SELECT r.user_id, l.tmdb_id, t.title, r.rating
FROM v_ratings r JOIN v_links l ON r.item_id = l.movie_id
JOIN (SELECT tmdb_id, min(title) AS title FROM v_titles GROUP BY tmdb_id) t ON l.tmdb_id = t.tmdb_id""",
    "v_ratings", "v_links", "v_titles"))
def ratings_with_titles(spark, d):
    return joins.map_ids(V.ratings(spark, d), V.links(spark, d), V.titles(spark, d))


@register("ratings_density", operators="A1 A3 A4", sql=with_views(
    """SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT tmdb_id) AS n_items,
       round(count(*) / count(DISTINCT user_id), 6) AS ratings_per_user,
       round(count(*) / count(DISTINCT tmdb_id), 6) AS ratings_per_item
FROM (SELECT r.user_id, l.tmdb_id FROM v_ratings r JOIN v_links l ON r.item_id = l.movie_id
      JOIN (SELECT DISTINCT tmdb_id FROM v_titles) t ON l.tmdb_id = t.tmdb_id) x""",
    "v_ratings", "v_links", "v_titles"))
def ratings_density(spark, d):
    rwt = joins.map_ids(V.ratings(spark, d), V.links(spark, d), V.titles(spark, d))
    agg = rwt.agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("tmdb_id").alias("n_items"),
    )
    return agg.select(
        "n_ratings", "n_users", "n_items",
        r6(F.try_divide(F.col("n_ratings"), F.col("n_users"))).alias("ratings_per_user"),
        r6(F.try_divide(F.col("n_ratings"), F.col("n_items"))).alias("ratings_per_item"),
    )


_UNRATED_SQL = with_views(
    f"""SELECT DISTINCT item_id, CAST({LOOKUP_USER} AS BIGINT) AS user_id FROM v_items
WHERE item_id NOT IN (SELECT item_id FROM v_ratings WHERE user_id = {LOOKUP_USER})""", "v_items", "v_ratings")


@register("unrated_anti_join", operators="J4 F6 P5 A2", sql=_UNRATED_SQL)
def unrated_anti_join(spark, d):
    return joins.unrated_items(V.items(spark, d), V.ratings(spark, d), LOOKUP_USER)


@register("unrated_anti_join_cond", operators="J5", sql=_UNRATED_SQL)
def unrated_anti_join_cond(spark, d):
    return joins.unrated_items_cond(V.items(spark, d), V.ratings(spark, d), LOOKUP_USER)


# ------------------------------------------------------------------------------------------------- similarity

_COS = """coalesce(list_dot_product(e.embedding::DOUBLE[], t.tv::DOUBLE[])
          / nullif(sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[]))
                   * sqrt(list_dot_product(t.tv::DOUBLE[], t.tv::DOUBLE[])), 0), 0.0)"""


@register("similar_vectors_topn", operators="Q5 J9 X16 F7 T2 T3 U1 U2", bench=True, sql=f"""SELECT vec_id, label, round(sim, 6) AS similarity FROM (
  SELECT e.vec_id, e.label, {_COS} AS sim
  FROM embeddings e, (SELECT embedding AS tv FROM embeddings WHERE vec_id = {TARGET_VEC} ORDER BY vec_id LIMIT 1) t
  WHERE e.vec_id <> {TARGET_VEC}) x
ORDER BY sim DESC, vec_id LIMIT {TOP_N}""")
def similar_vectors_topn(spark, d):
    top = similarity.similar_items(V.vectors(spark, d), TARGET_VEC, TOP_N, id_col="vec_id", vec_col="embedding")
    return top.select("vec_id", "label", r6(F.col("similarity")).alias("similarity"))


_LABEL_TITLES = "SELECT vec_id, 'label ' || CAST(label AS VARCHAR) AS title FROM embeddings"


def _by_title_sql(title: str) -> str:
    return f"""SELECT vec_id, title, sim FROM (SELECT e.vec_id, n.title, {_COS} AS sim
  FROM embeddings e JOIN ({_LABEL_TITLES}) n ON e.vec_id = n.vec_id,
    (SELECT vec_id AS target, embedding AS tv FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM ({_LABEL_TITLES}) m WHERE title = '{title}')) t
  WHERE e.vec_id <> t.target) x ORDER BY sim DESC, vec_id LIMIT {TOP_N}"""


def _by_title(spark, d, title):
    v = V.vectors(spark, d)
    titles = v.select("vec_id", F.concat(F.lit("label "), F.col("label").cast("string")).alias("title"))
    return similarity.similar_items_by_title(v, titles, title, TOP_N, id_col="vec_id", vec_col="embedding")


@register("similar_by_title", operators="Q5 J9 J3 F6 F7 T2 T5 (D3 D14)", sql=f"""SELECT vec_id, title, round(sim, 6) AS similarity
FROM ({_by_title_sql(LOOKUP_TITLE)}) y""")
def similar_by_title(spark, d):
    """Similar items of a title that many items bear: the lowest id is the target."""
    top = _by_title(spark, d, LOOKUP_TITLE)
    return top.select("vec_id", "title", r6(F.col("similarity")).alias("similarity"))


@register("title_lookup", operators="F14 Q5", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS title, count(*) AS n_similar, count(*) > 0 AS found FROM ({_by_title_sql(t)}) y" for t in (LOOKUP_TITLE, NO_TITLE)))
def title_lookup(spark, d):
    """Whether a title has similar items: an unknown one gives an empty result, not an error."""
    out = None
    for title in (LOOKUP_TITLE, NO_TITLE):
        part = _by_title(spark, d, title).agg(F.count(F.lit(1)).alias("n_similar"))
        part = part.select(F.lit(title).alias("title"), "n_similar", (F.col("n_similar") > 0).alias("found"))
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------------------------------------------ splits


@register("hash_split", operators="R4", sql=with_views(
    """SELECT CASE WHEN bucket < 80 THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows,
       count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items FROM v_split GROUP BY 1""",
    "v_ratings", extra={"v_split": SPLIT_CTES["v_split"]}))
def hash_split(spark, d):
    tagged = split.tag_hash_split(V.ratings(spark, d), ["user_id", "item_id"], TRAIN_PCT)
    return tagged.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("item_id").alias("n_items"),
    )


@register("bernoulli_sample", operators="R3", sql=None)
def bernoulli_sample(spark, d):
    """A Bernoulli sample of the ratings (a sampling operator: rows-only check)."""
    return split.bernoulli_sample(V.ratings(spark, d), SAMPLE_FRACTION)


@register("sample_fraction", operators="R3 R4", sql=with_views(
    f"""SELECT user_id, item_id, rating FROM v_ratings
WHERE CAST(('0x' || substr(md5({_PAIR_KEY}), 1, 7)) AS BIGINT) < {int(SAMPLE_FRACTION * split.HASH_SPACE)}""", "v_ratings"))
def sample_fraction(spark, d):
    """A fixed fraction of the ratings by key hash (stable, SQL-checkable form of the sample)."""
    return split.sample_fraction(V.ratings(spark, d), ["user_id", "item_id"], SAMPLE_FRACTION)


@register("random_split", operators="R1 R2 X19 P4", sql=None)
def random_split(spark, d):
    """``randomSplit`` and ``rand``-column splits, every row tagged with its side (rows-only check)."""
    r = V.ratings(spark, d)
    a, b = split.random_split(r, (0.8, 0.2), 42)
    c, e = split.rand_split(r, 0.8, 42)
    return (
        a.withColumn("method", F.lit("randomSplit")).withColumn("split", F.lit("train"))
        .unionByName(b.withColumn("method", F.lit("randomSplit")).withColumn("split", F.lit("test")))
        .unionByName(c.withColumn("method", F.lit("rand")).withColumn("split", F.lit("train")))
        .unionByName(e.withColumn("method", F.lit("rand")).withColumn("split", F.lit("test")))
    )


@register("split_invariants", operators="R1 R2 X19 P4", sql=with_views(" UNION ALL ".join(
    f"SELECT '{m}' AS method, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_both, CAST(0 AS BIGINT) AS n_lost, 3::INTEGER AS n_columns FROM v_ratings"
    for m in ("randomSplit", "rand", "hash")), "v_ratings"))
def split_invariants(spark, d):
    """Of every kind of split: its rows, keys on both sides, input keys on neither, and columns (the drawn one is dropped)."""
    r = V.ratings(spark, d)
    sides = {"randomSplit": split.random_split(r), "rand": split.rand_split(r), "hash": _split(spark, d)}
    out = None
    for method, (train, test) in sides.items():
        keys = r.select("user_id", "item_id", F.lit("input").alias("side"))
        for name, part in (("train", train), ("test", test)):
            keys = keys.unionByName(part.select("user_id", "item_id", F.lit(name).alias("side")))
        held = keys.groupBy("user_id", "item_id").agg(
            F.count_if(F.col("side") == "train").alias("a"), F.count_if(F.col("side") == "test").alias("b")
        )
        part = held.agg(
            F.coalesce(F.sum(F.col("a") + F.col("b")), F.lit(0)).alias("n_rows"),
            F.count_if((F.col("a") > 0) & (F.col("b") > 0)).alias("n_both"),
            F.count_if(F.col("a") + F.col("b") == 0).alias("n_lost"),
        ).select(F.lit(method).alias("method"), "*", F.lit(len(train.columns)).alias("n_columns"))
        out = part if out is None else out.unionByName(part)
    return out


# -------------------------------------------------------------------------------- prediction metrics (item mean)


@register("metrics_item_mean", operators="M9 M18 F15", bench=True, sql=with_views(
    """SELECT round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse,
       round(avg(abs(rating - prediction)), 6) AS mae,
       round(1 - sum((rating - prediction) * (rating - prediction)) / (count(*) * var_pop(rating)), 6) AS r2,
       count(*) AS n FROM v_valid""", "v_ratings", extra=SPLIT_CTES))
def metrics_item_mean(spark, d):
    m = EV.regression_metrics(_scored(spark, d))
    return m.select(r6(F.col("rmse")).alias("rmse"), r6(F.col("mae")).alias("mae"), r6(F.col("r2")).alias("r2"), "n")


@register("error_stats", operators="A5 X15", sql=with_views(
    """SELECT round(avg(error), 6) AS mean_error, round(stddev_samp(error), 6) AS std_error,
       round(min(error), 6) AS min_error, round(max(error), 6) AS max_error FROM v_valid""",
    "v_ratings", extra=SPLIT_CTES))
def error_stats(spark, d):
    s = EV.error_stats(_scored(spark, d))
    return s.select(*[r6(F.col(c)).alias(c) for c in s.columns])


@register("error_shares", operators="A6 F9 X17", sql=with_views(
    " UNION ALL ".join(
        f"""SELECT CAST({t} AS DOUBLE) AS threshold, count(CASE WHEN error <= {t} THEN 1 END) AS n_within,
       round(100.0 * count(CASE WHEN error <= {t} THEN 1 END) / count(*), 6) AS pct_within FROM v_valid"""
        for t in EV.ERROR_THRESHOLDS
    ), "v_ratings", extra=SPLIT_CTES))
def error_shares(spark, d):
    s = EV.error_shares(_scored(spark, d))
    return s.select("threshold", "n_within", r6(F.col("pct_within")).alias("pct_within"))


_PBINS = [(f"[{lo:g}, {hi:g})", f"prediction >= {lo} AND prediction < {hi}") for lo, hi in
          [(0.0, 2.0), (2.0, 3.0), (3.0, 4.0), (4.0, 5.0)]] + [(">= 5", "prediction >= 5.0")]


@register("prediction_bins", operators="A7 F10 X17", sql=with_views(
    "SELECT b.bin_order, b.bin, coalesce(c.n, 0) AS n, round(100.0 * coalesce(c.n, 0) / (SELECT count(*) FROM v_valid), 6) AS pct\n"
    "FROM (VALUES " + ", ".join(f"({i + 1}, '{lab}')" for i, (lab, _) in enumerate(_PBINS)) + ") b(bin_order, bin)\n"
    "LEFT JOIN (SELECT CASE " + " ".join(f"WHEN {cond} THEN '{lab}'" for lab, cond in _PBINS)
    + " END AS bin, count(*) AS n FROM v_valid GROUP BY 1) c ON b.bin = c.bin",
    "v_ratings", extra=SPLIT_CTES))
def prediction_bins(spark, d):
    b = EV.prediction_bins(spark, _scored(spark, d))
    return b.select("bin_order", "bin", "n", r6(F.col("pct")).alias("pct"))


@register("bias_report", operators="A8", sql=with_views(
    """SELECT round(avg(rating), 6) AS avg_actual, round(avg(prediction), 6) AS avg_predicted,
       round(avg(prediction) - avg(rating), 6) AS bias FROM v_scored""", "v_ratings", extra=SPLIT_CTES))
def bias_report(spark, d):
    b = EV.bias_report(_scored(spark, d))
    return b.select(*[r6(F.col(c)).alias(c) for c in b.columns])


@register("cold_start_counts", operators="M20 F15", sql=with_views(
    """SELECT count(*) AS total, count(prediction) AS valid, count(*) - count(prediction) AS missing FROM v_scored""",
    "v_ratings", extra=SPLIT_CTES))
def cold_start_counts(spark, d):
    return EV.cold_start_counts(_scored(spark, d))


# ------------------------------------------------------------------------- list metrics (deterministic recommender)


@register("recs_top_unseen", operators="M19 (exclude_seen) T6 T9 §2.12", bench=True, sql=with_views(
    "SELECT user_id, pos, item_id, prediction FROM v_recs", "v_ratings", extra=RECS_CTES))
def recs_top_unseen(spark, d):
    return _recs(spark, d)


@register("precision_at_k", operators="Q8 T6 J8 F8", bench=True, sql=with_views(
    " UNION ALL ".join(
        f"""SELECT {k} AS k, count(CASE WHEN r.pos <= {k} AND v.user_id IS NOT NULL THEN 1 END) AS hits,
       count(CASE WHEN r.pos <= {k} THEN 1 END) AS n_recs,
       round(coalesce(count(CASE WHEN r.pos <= {k} AND v.user_id IS NOT NULL THEN 1 END)
             / nullif(count(CASE WHEN r.pos <= {k} THEN 1 END), 0), 0.0), 6) AS precision
FROM v_recs r LEFT JOIN v_relevant v ON r.user_id = v.user_id AND r.item_id = v.item_id"""
        for k in EV.PRECISION_KS
    ), "v_ratings", extra=RECS_CTES))
def precision_at_k(spark, d):
    p = EV.precision_at_k(_recs(spark, d), _relevant(spark, d))
    return p.select("k", "hits", "n_recs", r6(F.col("precision")).alias("precision"))


@register("coverage", operators="A24 X8 A3", sql=with_views(
    """SELECT count(DISTINCT item_id) AS n_recommended, (SELECT count(DISTINCT item_id) FROM v_ratings) AS n_items,
       round(count(DISTINCT item_id) / (SELECT count(DISTINCT item_id) FROM v_ratings), 6) AS coverage FROM v_recs""",
    "v_ratings", extra=RECS_CTES))
def coverage(spark, d):
    c = EV.coverage(_recs(spark, d), V.ratings(spark, d))
    return c.select("n_recommended", "n_items", r6(F.col("coverage")).alias("coverage"))


_TOP_REC_SQL = """SELECT item_id, count(*) AS recommendation_count FROM v_recs GROUP BY item_id
ORDER BY recommendation_count DESC, item_id LIMIT 10"""


@register("top_recommended", operators="Q10 A25 J6 T2 T5", sql=with_views(
    f"""SELECT f.item_id, i.title, f.recommendation_count FROM ({_TOP_REC_SQL}) f
JOIN v_items i ON f.item_id = i.item_id""", "v_ratings", "v_items", extra=RECS_CTES))
def top_recommended(spark, d):
    top = EV.recommendation_frequency(_recs(spark, d), 10)
    titled = V.items(spark, d).select("item_id", "title").join(F.broadcast(top), "item_id")
    return titled.select("item_id", "title", "recommendation_count").orderBy(
        F.desc("recommendation_count"), "item_id"
    )


@register("rec_count_stats", operators="A26", sql=with_views(
    f"""SELECT round(avg(recommendation_count), 6) AS avg_recommendations,
       round(stddev_samp(recommendation_count), 6) AS std_recommendations,
       min(recommendation_count) AS min_recommendations, max(recommendation_count) AS max_recommendations
FROM ({_TOP_REC_SQL}) f""", "v_ratings", extra=RECS_CTES))
def rec_count_stats(spark, d):
    s = EV.frequency_stats(EV.recommendation_frequency(_recs(spark, d), 10))
    return s.select(
        r6(F.col("avg_recommendations")).alias("avg_recommendations"),
        r6(F.col("std_recommendations")).alias("std_recommendations"),
        "min_recommendations", "max_recommendations",
    )


@register("hits_semi_join", operators="J8 F8", sql=with_views(
    """SELECT r.user_id, r.pos, r.item_id FROM v_recs r
WHERE EXISTS (SELECT 1 FROM v_relevant v WHERE v.user_id = r.user_id AND v.item_id = r.item_id)""",
    "v_ratings", extra=RECS_CTES))
def hits_semi_join(spark, d):
    return _recs(spark, d).join(_relevant(spark, d), ["user_id", "item_id"], "left_semi").select(
        "user_id", "pos", "item_id"
    )


@register("user_report", operators="Q7 T1 T4 F6 J6 J7 X18 T6 T9", sql=with_views(
    f"""SELECT s.user_id, s.section, s.pos, s.item_id, coalesce(t.title, 'Movie ' || CAST(s.item_id AS VARCHAR)) AS title, round(s.value, 6) AS value FROM (
  SELECT user_id, 'held_out' AS section, CAST(row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS INTEGER) AS pos, item_id, rating AS value
  FROM v_test WHERE user_id IN (SELECT user_id FROM u)
  UNION ALL SELECT user_id, 'recommended', pos, item_id, prediction FROM v_recs WHERE user_id IN (SELECT user_id FROM u)) s
LEFT JOIN (SELECT item_id, min(title) AS title FROM v_items WHERE item_id % {V.UNTITLED_MOD} <> 0 GROUP BY item_id) t ON s.item_id = t.item_id
WHERE s.pos <= CASE WHEN s.section = 'held_out' THEN {REPORT_HELD} ELSE {TOP_N} END""",
    "v_ratings", "v_items", extra=RECS_CTES | {"u": f"SELECT DISTINCT user_id FROM v_test ORDER BY user_id LIMIT {REPORT_USERS}"}))
def user_report(spark, d):
    """Q7 on the deterministic recommender: of the first test users the best held-out ratings, fully sorted, and the best
    recommendations, titled ('Movie <id>' by default). A user's held-out rows come from a top-k of their own."""
    _, test = _split(spark, d)
    users = [r[0] for r in test.select("user_id").distinct().orderBy("user_id").limit(REPORT_USERS).collect()]
    rows = None
    for u in users:
        best = topk.top_k(test.filter(F.col("user_id") == u), REPORT_HELD, [F.desc("rating"), "item_id"])
        placed = best.withColumn("pos", F.row_number().over(Window.orderBy(F.desc("rating"), "item_id")))  # at most REPORT_HELD rows
        part = placed.select("user_id", F.lit("held_out").alias("section"), "pos", "item_id", F.col("rating").alias("value"))
        rows = part if rows is None else rows.unionByName(part)
    recs = _recs(spark, d).filter(F.col("user_id").isin(users) & (F.col("pos") <= TOP_N))
    recs = recs.select("user_id", F.lit("recommended").alias("section"), "pos", "item_id", F.col("prediction").alias("value"))
    rows = recs if rows is None else rows.unionByName(recs)
    items = V.items(spark, d).filter(F.col("item_id") % V.UNTITLED_MOD != 0).select("item_id", "title")
    titled = joins.with_titles(rows, items, key="item_id", default_prefix="Movie")
    return titled.select("user_id", "section", "pos", "item_id", "title", r6(F.col("value")).alias("value"))


@register("title_left_default", operators="J7 X18 T9 T6 Q7", sql=with_views(
    f"""SELECT r.user_id, r.pos, r.item_id, l.tmdb_id,
       coalesce(t.title, 'Movie ' || CAST(r.item_id AS VARCHAR)) AS title
FROM v_recs r LEFT JOIN v_links l ON r.item_id = l.movie_id
LEFT JOIN (SELECT tmdb_id, min(title) AS title FROM v_partial_titles GROUP BY tmdb_id) t ON l.tmdb_id = t.tmdb_id
WHERE r.pos <= {TOP_N}""", "v_ratings", "v_links", "v_partial_titles", extra=RECS_CTES))
def title_left_default(spark, d):
    recs = _recs(spark, d).filter(F.col("pos") <= TOP_N)
    linked = recs.join(V.links(spark, d).select(F.col("movie_id").alias("item_id"), "tmdb_id"), "item_id", "left")
    titled = joins.with_titles(linked, V.partial_titles(spark, d), key="tmdb_id", default_prefix="Movie", default_id="item_id")
    return titled.select("user_id", "pos", "item_id", "tmdb_id", "title")

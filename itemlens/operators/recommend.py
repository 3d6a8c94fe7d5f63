"""Recommendation operators (M15-M19, M23, Q6, Q7) and a deterministic baseline recommender.

- :func:`item_mean_scores` / :func:`score_by_item_mean`: a baseline rating predictor (mean train rating per item).
- :func:`top_k_unseen`: every user's ``k`` best-scored items they have not rated, exactly and without a cross join.
  The naive plan (users x items, anti-join the seen pairs, rank per user) emits every pair; cutting candidates to the
  top ``k + max seen`` items still crosses users with items and puts a heavy user in one task. Here items get a
  global rank once, and a user's p-th unseen item is the item at rank ``p + c(p)``, where ``c(p)`` counts the user's
  seen items that have fewer than ``p`` unseen items ranked above them. ``c`` comes from group-bys over the seen
  pairs (partial aggregation, skew-safe) that leave at most ``k`` counts per user, so total work is
  O(ratings + users * k^2) whatever the skew.
- ALS wrappers: training on the whole input with explicit seed (D17) and block counts, scoring with
  ``coldStartStrategy='nan'`` so missing predictions can be counted (D4), and id narrowing to int with an overflow
  error instead of silent truncation.
- :func:`als_top_n` and :func:`als_unseen_top_k`: every user's ALS top-k, with or without seen items, by pruned inner
  products (:mod:`itemlens.operators.inner_product`), and :func:`als_optimality`, an audit of the fitted factors.
- :func:`predict_unrated`: one user's predictions (Q6) as a dot product against a scalar-subquery user vector.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemlens.operators.inner_product import top_items
from itemlens.operators.skew import FINENESS, deal, hot_keys, salted_join, shuffle_partitions
from itemlens.operators.topk import global_rank, ordinal_within_group

# ALS hyper-parameters of the reference.
ALS_RANK = 10
ALS_REG = 0.1
ALS_ITER = 10
ALS_SEED = 42
RECS_PER_USER = 20
#: How the fit is dealt out: fewer item blocks move less, wider ones take less memory; checkpoints free the shuffle files.
USER_BLOCKS_PER_ITEM_BLOCK = 2
CHECKPOINT_INTERVAL = 2


def item_mean_scores(train: DataFrame, *, item_col: str = "item_id", rating_col: str = "rating") -> DataFrame:
    """Mean train rating per item, rounded to 6 decimals (so every engine agrees bit for bit on it)."""
    return train.groupBy(item_col).agg(F.round(F.avg(rating_col), 6).alias("prediction"))


def score_by_item_mean(train: DataFrame, test: DataFrame, *, item_col: str = "item_id") -> DataFrame:
    """Score test rows with the item-mean predictor; items unseen in training get a null prediction (cold start)."""
    return test.join(item_mean_scores(train, item_col=item_col), item_col, "left")


def unseen_slots(seen_ranks: DataFrame, users: DataFrame, k: int) -> DataFrame:
    """(user_id, pos, target_rank): the rank in the user's candidate order of its ``pos``-th unseen candidate.

    ``seen_ranks`` is (user_id, rank) for the seen candidates (ranks unique per user, 1-based). With ``j`` the
    ordinal of a seen candidate among the user's seen ones, ``rank - j`` unseen candidates precede it; the p-th
    unseen candidate is at rank ``p + #{seen: rank - j < p}``. A user with ``s`` seen candidates never needs a rank
    above ``k + s``, so only seen ranks up to that bound are numbered (skew-safe); what remains per user is at most
    ``k`` counts, summed up inside the row.
    """
    per_user = seen_ranks.groupBy("user_id").agg(F.count(F.lit(1)).alias("s"))
    near = seen_ranks.join(per_user, "user_id").filter(F.col("rank") <= F.col("s") + k).select("user_id", "rank")
    ordinals = ordinal_within_group(near, "user_id", "rank", ordinal_col="j")
    gaps = (
        ordinals.withColumn("d", F.col("rank") - F.col("j"))
        .filter(F.col("d") < k)
        .groupBy("user_id", "d")
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy("user_id")
        .agg(F.collect_list(F.struct("d", "c")).alias("gaps"))
    )
    slots = (
        users.select("user_id").distinct().join(gaps, "user_id", "left")
        .select("user_id", "gaps", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("pos"))
    )
    shift = F.aggregate(
        "gaps", F.lit(0).cast("bigint"), lambda a, g: a + F.when(g["d"] < F.col("pos"), g["c"]).otherwise(F.lit(0))
    )
    return slots.select("user_id", "pos", (F.col("pos") + F.coalesce(shift, F.lit(0))).alias("target_rank"))


def top_k_unseen(
    scores: DataFrame,
    seen: DataFrame,
    users: DataFrame,
    k: int = RECS_PER_USER,
    *,
    item_col: str = "item_id",
    score_col: str = "prediction",
    seen_unique: bool = False,
) -> DataFrame:
    """For every user in ``users``, the ``k`` highest-scored items of ``scores`` not in ``seen`` (ties by item id).

    ``scores`` is (item, score) with one row per item; ``seen`` is (user_id, item); ``users`` is (user_id).
    Returns (user_id, pos, item, score) with ``pos`` in 1..k (fewer when a user has fewer unseen items). Exact;
    see the module doc for the plan. An item that a third of the users have seen is salted by its count. A user asks
    for k ranks, each once, so a rank holds at most one k-th of all that is asked for: ranks are dealt to as many parts as
    that share needs. ``seen_unique=True`` skips deduplicating ``seen`` (a shuffle of all seen
    pairs) when the caller guarantees one row per pair, e.g. ratings grouped by (user, item).
    """
    ranked = global_rank(scores.select(item_col, score_col), [F.desc(score_col), F.col(item_col)], rank_col="rank")
    pairs = seen.select("user_id", item_col)
    if not seen_unique:
        pairs = pairs.distinct()
    seen_ranks = salted_join(pairs, ranked.select(item_col, "rank"), item_col, ["user_id"]).select("user_id", "rank")
    salts = -(-FINENESS * int(seen.sparkSession.conf.get("spark.sql.shuffle.partitions")) // k)
    slots = unseen_slots(seen_ranks, users, k).withColumn("_salt", F.pmod(F.xxhash64("user_id"), F.lit(salts)).cast("int"))
    most = pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("s")).agg(F.coalesce(F.max("s"), F.lit(0))).scalar()
    wanted = ranked.filter(F.col("rank") <= most + k).withColumnRenamed("rank", "target_rank")
    wanted = wanted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return slots.join(wanted, ["target_rank", "_salt"]).select(
        "user_id", F.col("pos").cast("int").alias("pos"), item_col, score_col
    )


# ----------------------------------------------------------------------------------------------------------- ALS


def to_int_ids(df: DataFrame, *cols: str) -> DataFrame:
    """Narrow id columns to int for ALS. ANSI ``cast`` raises on overflow instead of wrapping or nulling ids."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.col(c).cast("int"))
    return out


def train_als(
    ratings: DataFrame,
    *,
    user_col: str = "user_id",
    item_col: str = "item_id",
    rating_col: str = "rating",
    rank: int = ALS_RANK,
    reg: float = ALS_REG,
    max_iter: int = ALS_ITER,
    seed: int = ALS_SEED,
    nonnegative: bool = True,
    blocks: int | None = None,
):
    """Fit ALS (explicit feedback) on the whole input. ``blocks`` is the number of user blocks and of item blocks. By
    default users, whose blocks the first factors depend on, have as many as the session's parallelism; a user's factors go
    to every item block that holds one of the user's items in each iteration, so there are fewer of those
    (``USER_BLOCKS_PER_ITEM_BLOCK``). Item factors are checkpointed every ``CHECKPOINT_INTERVAL`` iterations, which removes
    the shuffle files of the iterations before; without a checkpoint dir they stay until the fit ends. Returns the fitted
    ``ALSModel``."""
    from pyspark.ml.recommendation import ALS

    width = max(1, ratings.sparkSession.sparkContext.defaultParallelism)
    data = to_int_ids(ratings.select(user_col, item_col, rating_col), user_col, item_col)
    als = ALS(
        numUserBlocks=blocks or width,
        numItemBlocks=blocks or max(1, width // USER_BLOCKS_PER_ITEM_BLOCK),
        checkpointInterval=CHECKPOINT_INTERVAL,
        userCol=user_col,
        itemCol=item_col,
        ratingCol=rating_col,
        rank=rank,
        regParam=reg,
        maxIter=max_iter,
        nonnegative=nonnegative,
        implicitPrefs=False,
        coldStartStrategy="nan",
        seed=seed,
    )
    return als.fit(data)


def als_scores(model, df: DataFrame, *, user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """Predictions for (user, item) rows; unknown users or items get NaN (counted by the evaluation, D4).
    The prediction is widened to double."""
    scored = model.transform(to_int_ids(df, user_col, item_col))
    return scored.withColumn("prediction", F.col("prediction").cast("double"))


def als_recommend_all(model, k: int = RECS_PER_USER, *, user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """M19 by MLlib, which scores every pair; :func:`als_top_n` gives the same lists with less work. Flattened to (user_id,
    pos, item, rating) with 1-based positions (T9).

    MLlib blocks the user and item factor tables and scores block pairs, keeping a bounded top-k per user.
    """
    recs = model.recommendForAllUsers(k)
    return recs.select(user_col, F.posexplode("recommendations").alias("p", "rec")).select(
        F.col(user_col).cast("long").alias("user_id"),
        (F.col("p") + 1).alias("pos"),
        F.col(f"rec.{item_col}").cast("long").alias(item_col),
        F.col("rec.rating").cast("double").alias("rating"),
    )


def _als_lists(model, k: int, seen: DataFrame | None, user_col: str, item_col: str) -> tuple[DataFrame, DataFrame]:
    if seen is not None:
        seen = seen.select(F.col(user_col).alias("user_id"), F.col(item_col).alias("item_id"))
    lists, work = top_items(model.userFactors, model.itemFactors, k, seen)
    return lists.select(
        "user_id", F.col("pos").cast("int").alias("pos"), F.col("item_id").alias(item_col), F.col("score").alias("rating")
    ), work


def als_top_n(model, k: int = RECS_PER_USER, *, user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """Top-k items for every user as (user_id, pos, item, rating), by score, ties by item id. Exact, without
    scoring the pairs that the factors' norms rule out (:mod:`itemlens.operators.inner_product`)."""
    return _als_lists(model, k, None, user_col, item_col)[0]


def als_unseen_top_k(
    model, seen: DataFrame, k: int = RECS_PER_USER, *, user_col: str = "user_id", item_col: str = "item_id"
) -> DataFrame:
    """M19 with ``exclude_seen``: every user's top-k ALS items that the user has not rated, exactly.

    Seen items are struck out where they are scored, so a user's queue holds k items, however many were seen.
    """
    return _als_lists(model, k, seen, user_col, item_col)[0]


def als_pair_work(
    model, seen: DataFrame | None = None, k: int = RECS_PER_USER, *, user_col: str = "user_id", item_col: str = "item_id"
) -> DataFrame:
    """How many (user, item) pairs the lists score: users, items, pairs (all there are), pairs_scored."""
    return _als_lists(model, k, seen, user_col, item_col)[1]


def als_optimality(
    model,
    train: DataFrame,
    *,
    reg: float = ALS_REG,
    user_col: str = "user_id",
    item_col: str = "item_id",
    rating_col: str = "rating",
    tolerance: float = 1e-2,
) -> DataFrame:
    """Audit of a non-negative ALS fit: per training user the worst violation of its optimality conditions.

    The last half-step of a fit solves, for each user u with item factors V and ratings r of its n rated items, the
    least squares |V x - r|^2 + reg n |x|^2 over x >= 0. At its solution the gradient g = (V'V + reg n I) x - V'r is 0
    where x > 0 and not negative where x = 0. V'V and V'r are sums over a user's ratings, rank (rank + 3) / 2 numbers.
    Ratings are dealt by user with the item's factors before they are summed: partial sums of every task that holds one of
    the user's items would be several times as much. Users with more ratings than an average partition are dealt to parts,
    whose sums are added. Each component is compared with the size of the terms it is the
    difference of; ``violations`` counts those beyond ``tolerance`` (factors are stored in single precision).
    """
    rank = model.rank
    items = model.itemFactors.select(F.col("id").cast("long").alias(item_col), F.col("features").alias("v"))
    rows = salted_join(train.select(user_col, item_col, rating_col), items, item_col, [user_col])
    hot = hot_keys(train, user_col, shuffle_partitions(train))
    split = not hot.isEmpty()
    rows = deal(rows, hot, user_col, [item_col])
    keys = [user_col, "_salt"] if split else [user_col]
    v = [F.get("v", F.lit(i)).cast("double") for i in range(rank)]
    sums = {f"a{i}_{j}": F.sum(v[i] * v[j]) for i in range(rank) for j in range(i, rank)}
    sums |= {f"b{i}": F.sum(v[i] * F.col(rating_col)) for i in range(rank)}
    sums["n"] = F.count(F.lit(1))
    normal = rows.repartition(*keys).groupBy(*keys).agg(*(c.alias(name) for name, c in sums.items()))
    if split:
        normal = normal.groupBy(user_col).agg(*(F.sum(name).alias(name) for name in sums))
    users = model.userFactors.select(F.col("id").cast("long").alias(user_col), F.col("features").cast("array<double>").alias("x"))
    both = normal.join(users, user_col, "left")
    checks = []
    for i in range(rank):
        x = F.get("x", F.lit(i))
        terms = [F.col(f"a{min(i, j)}_{max(i, j)}") * F.get("x", F.lit(j)) for j in range(rank)]
        terms += [F.lit(reg) * F.col("n") * x, -F.col(f"b{i}")]
        gradient, size = sum(terms[1:], terms[0]), sum((F.abs(t) for t in terms[1:]), F.abs(terms[0])) + F.lit(1e-9)
        off = F.when(x > 0, F.abs(gradient)).otherwise(F.greatest(-gradient, F.lit(0.0))) / size
        checks.append(F.coalesce(off, F.lit(float("inf"))))  # a training user without factors violates everything
    off = F.array(*checks)
    return both.select(
        user_col,
        F.array_max(off).alias("worst"),
        F.size(F.filter(off, lambda c: c > tolerance)).alias("violations"),
    )


def predict_unrated(model, unrated: DataFrame, k: int | None = 10, *, item_col: str = "item_id") -> DataFrame:
    """Q6: predicted ratings of one user's unrated items, best first (ties by id); top ``k``, or the full sorted
    list (T1) when ``k`` is None. Items without factors are dropped (no NaN rows).

    ``unrated`` holds one user's rows. Joining them to the factor tables through ``ALSModel.transform`` would fold the
    constant user id into a key-less (nested-loop) join, so the user's factor vector is a scalar subquery instead
    and each item is scored by the same dot product of factors, via an equi-join to the item factors.
    """
    from itemlens.functions.vectors import dot

    user_id = unrated.select(F.min("user_id")).scalar()
    user_vec = model.userFactors.withColumn("_u", user_id).filter(F.col("id") == F.col("_u")).agg(
        F.min_by("features", "id")
    ).scalar()
    items = unrated.select(F.col(item_col).cast("int").alias("id")).distinct()
    scored = (
        model.itemFactors.join(items, "id")
        .withColumn("_uv", user_vec)
        .filter(F.col("_uv").isNotNull())
        .select(F.col("id").cast("long").alias(item_col), dot("features", "_uv").alias("prediction"))
    )
    ordered = scored.orderBy(F.desc("prediction"), item_col)
    return ordered.limit(k) if k else ordered

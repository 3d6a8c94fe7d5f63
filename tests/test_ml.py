
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from itemlens.operators import recommend


@pytest.fixture(scope="module")
def ratings(spark):
    rng = random.Random(11)
    rows = set()
    for u in range(40):
        n = 45 if u == 0 else rng.randint(3, 15)  # user 0 is heavy: it has rated most items
        for i in rng.sample(range(60), n):
            rows.add((u, i, float(rng.randint(1, 5))))
    return spark.createDataFrame(sorted(rows), "user_id long, item_id long, rating double").repartition(3)


@pytest.fixture(scope="module")
def model(ratings):
    return recommend.train_als(ratings, rank=4, max_iter=5)


def _factors(df):
    return {r["id"]: np.array(r["features"], dtype=np.float64) for r in df.collect()}


def test_seeded_refit_is_identical(ratings, model):
    again = recommend.train_als(ratings, rank=4, max_iter=5)
    a, b = _factors(model.itemFactors), _factors(again.itemFactors)
    assert a.keys() == b.keys()
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_nonnegative_predictions(ratings, model):
    scored = recommend.als_scores(model, ratings)
    assert scored.filter(F.col("prediction") < 0).count() == 0


def test_recommend_all_shape(model):
    recs = recommend.als_recommend_all(model, 5).collect()
    by_user = {}
    for r in recs:
        by_user.setdefault(r["user_id"], []).append((r["pos"], r["rating"]))
    for lst in by_user.values():
        lst.sort()
        assert len(lst) <= 5
        assert [p for p, _ in lst] == list(range(1, len(lst) + 1))
        scores = [s for _, s in lst]
        assert scores == sorted(scores, reverse=True)


def test_unseen_top_k_matches_brute_force(ratings, model):
    k = 6
    users = _factors(model.userFactors)
    items = _factors(model.itemFactors)
    seen = {}
    for r in ratings.collect():
        seen.setdefault(r["user_id"], set()).add(r["item_id"])
    got = {}
    for r in recommend.als_unseen_top_k(model, ratings, k).collect():
        got.setdefault(r["user_id"], []).append((r["pos"], r["item_id"], r["rating"]))
    for u, uf in users.items():
        scores = sorted(
            ((float(np.float32(uf.astype(np.float32) @ items[i].astype(np.float32))), i) for i in items if i not in seen[u]),
            key=lambda t: (-t[0], t[1]),
        )
        want_items = [i for _, i in scores[:k]]
        rows = sorted(got.get(u, []))
        assert [p for p, _, _ in rows] == list(range(1, len(rows) + 1))
        assert len(rows) == min(k, len(scores))
        assert not any(i in seen[u] for _, i, _ in rows)
        got_scores = [s for _, _, s in rows]
        want_scores = [s for s, _ in scores[:k]]
        # same items up to ties in float32 scores
        assert np.allclose(got_scores, want_scores, rtol=1e-5, atol=1e-6)
        assert set(i for _, i, _ in rows) == set(want_items) or np.isclose(want_scores[-1], scores[k][0] if len(scores) > k else -1)


def test_predict_unrated_matches_transform(spark, ratings, model):
    from itemlens.operators import joins

    items = ratings.select("item_id").distinct()
    unrated = joins.unrated_items(items, ratings, 3)
    got = {r["item_id"]: r["prediction"] for r in recommend.predict_unrated(model, unrated, None).collect()}
    want = {
        r["item_id"]: r["prediction"]
        for r in recommend.als_scores(model, unrated).filter(~F.isnan("prediction")).collect()
    }
    assert got.keys() == want.keys() and len(got) > 0
    assert all(abs(got[i] - want[i]) < 1e-5 for i in got)
    top = recommend.predict_unrated(model, unrated, 4).collect()
    assert [r["item_id"] for r in top] == [i for i, _ in sorted(got.items(), key=lambda t: (-t[1], t[0]))[:4]]


def test_block_counts_follow_the_parameter_and_the_session(spark, ratings, model):
    assert recommend.train_als(ratings, rank=2, max_iter=1, blocks=3).itemFactors.rdd.getNumPartitions() == 3
    assert model.userFactors.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_unseen_slots_spread_hot_ranks(spark):
    """Nearly every user asks for rank 1: the join deals it to several parts, also as a sort-merge join."""
    scores = spark.range(50).selectExpr("id AS item_id", "CAST(50 - id AS double) AS prediction")
    seen = spark.range(400).selectExpr("id AS user_id", "id % 3 AS item_id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        top = recommend.top_k_unseen(scores, seen, seen.select("user_id"), 4)
        got = {}
        for r in top.collect():
            got.setdefault(r["user_id"], {})[r["pos"]] = r["item_id"]
        assert "hashpartitioning(target_rank" in top._jdf.queryExecution().toString()
        assert "_salt" in top._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for u in range(400):
        want = [i for i in range(50) if i != u % 3][:4]
        assert [got[u][p] for p in (1, 2, 3, 4)] == want

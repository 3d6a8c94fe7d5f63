"""Selection of quantiles, pruned inner products, salted joins, closed-form fits and model audits against brute force."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from itemlens import session
from itemlens.operators import evaluate, gram, inner_product, quantiles, recommend, regress, skew
from itemlens.sources import catalog
from itemlens.sources.hot import HotTables


def plan_of(df):
    return df._jdf.queryExecution().toString()


# Quantiles


def odd_doubles(n=400):
    rng = random.Random(3)
    out = [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, 1.0, 2.0, math.inf]
    for e in range(-1074, 1024, 61):
        x = math.ldexp(1.0, e)
        out += [x, math.nextafter(x, 0), math.nextafter(x, math.inf)]
    out += [struct.unpack(">d", struct.pack(">q", rng.randrange(0, 2047 << 52)))[0] for _ in range(n)]
    return out + [-x for x in out]


def test_order_key_is_the_bit_pattern(spark):
    values = [*odd_doubles(), math.nan]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r.i: r.k for r in df.select("i", quantiles.order_key(F.col("v")).alias("k")).collect()}
    for i, v in enumerate(values):
        bits = struct.unpack(">q", struct.pack(">d", abs(v)))[0]
        assert got[i] == ((1 << 63) - 1 if math.isnan(v) else -bits if v < 0 else bits), v


def test_quantiles_of_extreme_values(spark):
    rng = random.Random(4)
    rows = [(g, rng.choice(odd_doubles(50)[:-1])) for g in ("a", None) for _ in range(301)]
    rows += [("one", 7.0), ("two", -1.0), ("two", 2.0), ("none", None), ("inf", math.inf), ("inf", math.inf)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r.g: tuple(r)[1:] for r in quantiles.exact_quantiles(df, "v", probs, ["g"]).collect()}
    assert set(got) == {"a", None, "one", "two", "inf"}
    for g, mine in got.items():
        v = sorted(x for h, x in rows if h == g and x is not None)
        for p, x in zip(probs, mine):
            h = p * (len(v) - 1)
            lo, hi = v[math.floor(h)], v[math.ceil(h)]
            assert x == (lo if lo == hi else lo + (h - math.floor(h)) * (hi - lo))


def test_quantiles_move_no_values(spark):
    """No sort by value, and what is written between passes are the wanted ordinals only."""
    df = spark.range(3000).selectExpr("id % 3 AS g", "IF(id % 3 = 0, 2.0D, CAST(id AS double)) AS v")
    got = quantiles.exact_quantiles(df, "v", [0.5], ["g"], names=["m"])
    plan = plan_of(got)
    assert "rangepartitioning" not in plan and "/rank-" not in plan and "/ordinals-" in plan
    assert {r.g: r.m for r in got.collect()} == {0: 2.0, 1: 1499.5, 2: 1500.5}
    none = quantiles.exact_quantiles(df.filter("v < 0"), "v", [0.5], names=["m"])
    assert [tuple(r) for r in none.collect()] == [(None,)]


# Inner products


def factor_table(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "id int, features array<float>").repartition(3)


def brute_lists(users, items, k, seen=()):
    out = {}
    for u, x in users:
        scores = [(-float(np.dot(np.float64(x), np.float64(v))), i) for i, v in items if (u, i) not in seen]
        out[u] = [i for _, i in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("signed", [False, True])
def test_pruned_lists_are_exact(spark, monkeypatch, signed):
    monkeypatch.setattr(inner_product, "ITEM_BLOCK", 16)
    monkeypatch.setattr(inner_product, "USER_BLOCK", 7)
    rng = random.Random(5)
    draw = lambda s: [s * rng.choice([-1, 1] if signed else [1]) * rng.choice([0, 1, 1, 2]) for _ in range(3)]
    items = [(i * 3, draw(100 if i % 40 == 0 else 1)) for i in range(200)]  # many ties, a few large norms
    users = [(u, draw(1)) for u in range(40)] + [(99, [0, 0, 0])]
    seen = {(u, i * 3) for u in range(0, 40, 2) for i in rng.sample(range(200), 30)} | {(5, i * 3) for i in range(198)}
    seen |= {(7, 1_000_000), (12345, 3)}  # an item and a user without factors
    pairs = spark.createDataFrame([*seen, *list(seen)[:50]], "user_id long, item_id long")
    lists, work = inner_product.top_items(factor_table(spark, users), factor_table(spark, items), 6, pairs)
    got = {}
    for r in lists.orderBy("user_id", "pos").collect():
        got.setdefault(r.user_id, []).append(r.item_id)
        assert r.pos == len(got[r.user_id])
    assert got == brute_lists(users, items, 6, seen)
    done = work.first()
    assert (done.users, done.items, done.pairs) == (41, 200, 8200) and 41 * 16 <= done.pairs_scored <= 8200


def test_large_norms_rule_blocks_out(spark, monkeypatch):
    monkeypatch.setattr(inner_product, "ITEM_BLOCK", 16)
    rng = random.Random(6)
    items = [(i, [(1000 if i < 16 else 1) * (0.5 + rng.random()) for _ in range(4)]) for i in range(400)]
    users = [(u, [0.5 + rng.random() for _ in range(4)]) for u in range(50)]
    lists, work = inner_product.top_items(factor_table(spark, users), factor_table(spark, items), 5)
    assert work.first().pairs_scored == 50 * 16
    assert {r.item_id for r in lists.collect()} <= set(range(16))


def test_angles_rule_blocks_out_where_norms_are_alike(spark, monkeypatch):
    monkeypatch.setattr(inner_product, "ITEM_BLOCK", 16)
    rng = random.Random(12)
    at = lambda a: [math.cos(a) * 0.6, math.cos(a) * 0.8, math.sin(a) * 0.6, math.sin(a) * 0.8]
    items, users = ([(i, at(rng.random() * math.pi / 2)) for i in range(n)] for n in (1000, 50))
    lists, work = inner_product.top_items(factor_table(spark, users), factor_table(spark, items), 5)
    got = {}
    for r in lists.orderBy("user_id", "pos").collect():
        got.setdefault(r.user_id, []).append(r.item_id)
    assert got.keys() == {u for u, _ in users}
    for (u, x), want in zip(users, brute_lists(users, items, 5).values()):
        score = {i: float(np.dot(np.float32(x).astype(float), np.float32(v).astype(float))) for i, v in items}
        assert np.allclose([score[i] for i in got[u]], [score[i] for i in want], rtol=1e-6)
    assert work.first().pairs_scored < 50 * 1000 / 3


def test_lists_write_no_candidates_per_pair_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(inner_product, "ITEM_BLOCK", 4)
    monkeypatch.setattr(inner_product, "GROUP_USERS", 10)
    rng = random.Random(8)
    draw = lambda: [0.9 + 0.2 * rng.random() for _ in range(4)]  # noqa: E731  norms alike: nearly every block is met
    items, users = [(i, draw()) for i in range(120)], [(u, draw()) for u in range(90)]
    lists, _ = inner_product.top_items(factor_table(spark, users), factor_table(spark, items), 3)
    got = {}
    for r in lists.orderBy("user_id", "pos").collect():
        got.setdefault(r.user_id, []).append(r.item_id)
    assert got == brute_lists(users, items, 3)
    groups = max(9, spark.sparkContext.defaultParallelism)
    assert spark.read.parquet(*lists.inputFiles()).count() <= 90 * 3 + groups


def test_lists_hold_little_beside_them():
    """Meeting a block, candidates and sorts are bounded, however many users meet it at once."""
    import tracemalloc

    rng = np.random.default_rng(4)
    users, items = (rng.random((n, 8)).astype(np.float32) for n in (40_000, 512))
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int32)
    group = inner_product._Group(np.arange(40_000), users, 20)
    tracemalloc.start()
    try:
        group.meet(np.arange(512), items, *nothing)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 45 << 20
    wide, some = items.astype(float), slice(0, 40_000, 997)
    for u, x in zip(group.ids[some], users[some].astype(float)):
        want = sorted((-float(np.dot(x, v)), i) for i, v in enumerate(wide))[:20]
        assert group.item[u].tolist() == [i for _, i in want]


def test_ties_and_long_candidate_rows_are_cut_into_sorts(monkeypatch):
    """Rows of unlike length, ties by item id, and a bound that holds a few rows only."""
    monkeypatch.setattr(inner_product, "CANDIDATES", 40)
    monkeypatch.setattr(inner_product, "CHUNK", 3)
    monkeypatch.setattr(inner_product, "USER_BLOCK", 2)
    rng = np.random.default_rng(9)
    ids = np.arange(0, 34, 2)
    users = rng.integers(0, 3, (17, 3)).astype(np.float32)  # a user without any factor is among them
    users[5] = 0
    items = rng.integers(0, 3, (90, 3)).astype(np.float32)
    items = items[np.argsort(-np.linalg.norm(items, axis=1), kind="stable")]
    item_ids = rng.permutation(90)
    seen = sorted({(int(rng.choice(ids)), int(i)) for i in rng.integers(0, 90, 60)} | {(3, 7), (999, 8)})
    group = inner_product._Group(ids, users, 4)
    for a in range(0, 90, 30):
        struck = [(u, p - a) for u, p in seen if a <= p < a + 30]
        group.meet(item_ids[a : a + 30], items[a : a + 30], np.array([u for u, _ in struck]), np.array([p for _, p in struck]))
    for n, u in enumerate(ids):
        scored = sorted((-float(users[n] @ items[p]), int(item_ids[p])) for p in range(90) if (u, p) not in seen)
        assert group.item[n].tolist() == [i for _, i in scored[:4]]


def test_true_cells_are_numpys():
    rng = np.random.default_rng(3)
    for rows, columns in ((1, 1), (3, 5), (7, 8), (128, 33)):
        for share in (0, 0.05, 1):
            mask = rng.random((rows, columns)) < share
            assert all((a == b).all() for a, b in zip(inner_product._true_cells(mask), np.nonzero(mask)))


def test_lists_without_items_or_users(spark):
    some, none = factor_table(spark, [(1, [1.0, 2.0])]), factor_table(spark, [(1, [1.0])]).limit(0)
    for users, items in ((none, some), (some, none), (none, none)):
        lists, work = inner_product.top_items(users, items, 3)
        assert lists.count() == 0 and work.first().pairs == 0


@pytest.fixture(scope="module")
def rated(spark):
    rng = random.Random(11)
    rows = {(u, i): float(rng.randint(1, 5)) for u in range(60) for i in rng.sample(range(80), 70 if u == 0 else rng.randint(3, 20))}
    return spark.createDataFrame([(u, i, r) for (u, i), r in sorted(rows.items())], "user_id long, item_id long, rating double").repartition(3)


@pytest.fixture(scope="module")
def als(rated):
    return recommend.train_als(rated, rank=4, max_iter=6)


def test_pruned_lists_are_mllibs(als):
    mine, theirs = ({} for _ in range(2))
    for out, df in ((mine, recommend.als_top_n(als, 7)), (theirs, recommend.als_recommend_all(als, 7))):
        for r in df.orderBy("user_id", "pos").collect():
            out.setdefault(r.user_id, []).append((r.item_id, r.rating))
    assert mine.keys() == theirs.keys() and len(mine) == 60
    for u in mine:
        assert np.allclose([s for _, s in mine[u]], [s for _, s in theirs[u]], rtol=1e-5)
        apart = {i for (i, s), (j, t) in zip(mine[u], theirs[u]) if i != j and abs(s - t) > 1e-5 * abs(s)}
        assert not apart


# ALS audit


def test_fitted_factors_are_optimal_and_others_are_not(spark, rated, als):
    good = recommend.als_optimality(als, rated).collect()
    assert len(good) == 60 and not any(r.violations for r in good)

    class Shifted:
        rank = als.rank
        itemFactors = als.itemFactors
        userFactors = als.userFactors.withColumn("features", F.transform("features", lambda x: x + F.lit(0.05).cast("float")))

    bad = recommend.als_optimality(Shifted, rated).collect()
    assert sum(r.violations > 0 for r in bad) > 50
    Shifted.userFactors = als.userFactors.filter("id <> 3")
    assert [r.user_id for r in recommend.als_optimality(Shifted, rated).collect() if r.violations] == [3]


def test_audit_sums_of_a_hot_user(spark, rated, als):
    """A user with most of the rows is dealt to parts; sums are those of all rows, and no partial sums are shuffled otherwise."""
    hot = rated.where("user_id = 0")
    for _ in range(4):
        hot = hot.unionByName(hot)
    many = rated.unionByName(hot)
    assert [r.user_id for r in skew.hot_keys(many, "user_id", 4).collect()] == [0]
    v = {r.id: np.array(r.features, dtype=float) for r in als.itemFactors.collect()}
    x = {r.id: np.array(r.features, dtype=float) for r in als.userFactors.collect()}
    held = {}
    for r in many.collect():
        held.setdefault(r.user_id, []).append((v[r.item_id], r.rating))
    got = {r.user_id: r for r in recommend.als_optimality(als, many).collect()}
    assert got.keys() == held.keys()
    for u, rows in held.items():
        m, y = np.array([a for a, _ in rows]), np.array([b for _, b in rows])
        terms = [*(m.T @ m * x[u]).T, recommend.ALS_REG * len(rows) * x[u], -(m.T @ y)]
        gradient, size = sum(terms), sum(np.abs(t) for t in terms) + 1e-9
        worst = np.where(x[u] > 0, np.abs(gradient), np.maximum(-gradient, 0)) / size
        assert abs(got[u].worst - worst.max()) < 1e-9
    plan = recommend.als_optimality(als, rated)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" not in plan.split("REPARTITION_BY_COL")[1].split("HashAggregate")[0]
    assert "REPARTITION_BY_COL" in plan


def test_fit_frees_its_shuffle_files(spark, rated):
    """The files of 20 half-steps don't stay until the fit ends."""
    import time

    def held():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (found.apply(i).getName() for i in range(found.size()))
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    before = held()
    recommend.train_als(rated, rank=4, max_iter=10, blocks=9)
    for _ in range(20):  # files are removed in the background
        left = len(held() - before)
        if left < 60:
            break
        time.sleep(0.5)
    assert left < 60  # 20 half-steps of 9 files are 180


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    def held():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (found.apply(i).getName() for i in range(found.size()))
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    (tmp_path / "part.parquet").mkdir()
    setting, hot = spark.conf.get(session._FREE_SHUFFLES), HotTables(spark)
    dealt = spark.range(2000).withColumn("k", F.col("id") % 7).repartition(3, "k")
    before = held()
    tables = [
        session.write_scratch_table(spark, dealt, "dealt"),
        session.write_bucketed_scratch_table(spark, dealt, "bucketed", "id", 2),
        hot.table(str(tmp_path), "dealt", ("part",), lambda: dealt),
        hot.table(str(tmp_path), "keyed", ("part",), lambda: dealt, bucket_by="id"),
    ]
    assert not held() - before
    want = sorted(dealt.collect())  # the frame itself can be read again
    assert len(want) == 2000 and all(sorted(t.collect()) == want for t in tables)
    assert spark.conf.get(session._FREE_SHUFFLES) == setting
    hot.close()


def test_ratings_are_grouped_in_tasks_of_bounded_input(spark, sf_small, monkeypatch):
    from itemlens.plans import views

    want = sorted(views.ratings_plan(spark, sf_small).collect())
    monkeypatch.setattr(views, "RATINGS_PART_BYTES", 5000)
    df = views.ratings_plan(spark, sf_small)
    assert sorted(df.collect()) == want and len(want) > 1000
    assert df.rdd.getNumPartitions() > 4  # the session's shuffle partitions


def test_users_go_to_few_item_blocks(spark, als):
    """Users keep the session's width, items have fewer blocks unless the number is named."""
    width = spark.sparkContext.defaultParallelism
    assert als.userFactors.rdd.getNumPartitions() == width
    assert als.itemFactors.rdd.getNumPartitions() == max(1, width // recommend.USER_BLOCKS_PER_ITEM_BLOCK) < width


def test_half_of_the_tasks_fit_items(spark, als):
    """A third of the session's width left most cores idle while item factors were fitted."""
    assert als.itemFactors.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism // 2


def test_sides_are_the_split_in_one_pass(spark, tmp_path):
    from itemlens.operators import split
    from itemlens.plans import q_ml

    made = spark.range(500).selectExpr("IF(id % 50 = 0, NULL, id % 40) AS user_id", "id % 90 AS tmdb_id", "'t' AS title", "id % 5 + 0.5D AS rating")
    made.unionByName(made.limit(30)).write.parquet(str(tmp_path / "mapped"))
    mapped = spark.read.parquet(str(tmp_path / "mapped"))
    both = q_ml._als_sides(mapped)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    for side, want in zip(("train", "test"), split.hash_split(mapped.drop("title"), ["user_id", "tmdb_id"])):
        got = both.filter(F.col("side") == side).drop("side")
        assert got.count() == want.count() > 0 and got.exceptAll(want.select(got.columns)).isEmpty()


def test_scored_report_is_the_single_reports(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["train", "test"]), rng.randint(1, 5) * 1.0, rng.choice([rng.uniform(0, 6), math.nan, None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "side string, rating double, prediction double")
    got = evaluate.scored_report(df).first()
    test, train = df.filter("side = 'test'"), df.filter("side = 'train'")
    m, c, e = evaluate.regression_metrics(test).first(), evaluate.cold_start_counts(test).first(), evaluate.error_stats(test).first()
    assert (got.total, got.valid, got.missing) == (c.total, c.valid, c.missing)
    for mine, want in ((got.rmse, m.rmse), (got.mae, m.mae), (got.r2, m.r2), (got.std_error, e.std_error), (got.max_error, e.max_error)):
        assert abs(mine - want) < 1e-9
    for t, share in ((r.threshold, r.pct_within) for r in evaluate.error_shares(test).collect()):
        assert abs(got["pct_within_" + str(t).replace(".", "_")] - share) < 1e-9
    for r in evaluate.prediction_bins(spark, test).collect():
        assert abs(got[f"pct_pred {r.bin}"] - r.pct) < 1e-9
    assert abs(got.train_rmse - evaluate.regression_metrics(train).first().rmse) < 1e-9
    assert abs(got.bias - evaluate.bias_report(test).first().bias) < 1e-9
    empty = evaluate.scored_report(df.limit(0)).first()
    assert empty.total == 0 and empty.rmse is None


# Salted joins


def test_hot_keys_are_few_and_salted_by_their_count(spark):
    df = spark.range(9000).selectExpr("IF(id % 3 = 0, 7, id) AS k", "id AS u")
    hot = skew.hot_keys(df, "k", 16).collect()
    assert [(r.k, r["_salts"]) for r in hot] == [(7, math.ceil(3001 / 9000 * 16 * skew.FINENESS))]
    assert skew.hot_keys(df.limit(0), "k", 16).collect() == []


def test_a_hot_key_spreads_over_the_partitions(spark):
    """A third of all rows on one key, sort-merge join: the largest task holds at most three times the median."""
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    big = spark.range(60_000).selectExpr("IF(id % 3 = 0, 7, id % 5000) AS k", "id AS u")
    small = spark.range(5000).selectExpr("id AS k", "id * 2 AS w")
    try:
        for c, v in zip(old, ("-1", "false", "16")):
            spark.conf.set(c, v)
        joined = skew.salted_join(big, small, "k", ["u"])
        assert "SortMergeJoin" in plan_of(joined)
        per_task = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert len(per_task) == 16 and per_task[-1] <= 3 * per_task[8]
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    want = big.join(small, "k").agg(F.count("*"), F.sum("u"), F.sum("w"), F.sum("k")).first()
    assert joined.agg(F.count("*"), F.sum("u"), F.sum("w"), F.sum("k")).first() == want


def test_salted_join_drops_null_and_unmatched_keys(spark):
    big = spark.createDataFrame([(None, 1), (1, 2), (1, 3), (2, 4), (9, 5)], "k int, u int")
    small = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    got = sorted(tuple(r) for r in skew.salted_join(big, small, "k", ["u"], 2).collect())
    assert got == [(1, 2, "a"), (1, 2, "b"), (1, 3, "a"), (1, 3, "b"), (2, 4, "c")]


# Regression


def test_closed_form_is_least_squares(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3)) * [1e8, 1, 1e-3] + [1e9, 2000, 0]
    y = x @ [2e-8, -3, 40] + 5 + rng.normal(size=500)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))] + [(501, None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(4)
    line = gram.fit(df, ["a", "b", "c"], "y")
    want, *_ = np.linalg.lstsq(np.c_[x - x.mean(axis=0)] / x.std(axis=0), y - y.mean(), rcond=None)
    assert line.n == 500 and np.allclose(line.coefficients, want / x.std(axis=0), rtol=1e-6)
    scored = df.dropna().withColumn("p", line.predict()).orderBy("id").collect()
    assert np.allclose([r.p for r in scored], y.mean() + (x - x.mean(axis=0)) @ (want / x.std(axis=0)), rtol=1e-9)
    flat = gram.fit(df.withColumn("z", F.lit(3.0)).withColumn("a2", F.col("a") * 2), ["a", "a2", "z"], "y")
    assert flat.coefficients[2] == 0.0 and np.isfinite(flat.coefficients).all()
    assert gram.fit(df.limit(0), ["a"], "y").n == 0


def test_tree_models_as_expressions(spark):
    rng = random.Random(8)
    rows = [(i, rng.random(), float(rng.randrange(5)), rng.gauss(0, 1)) for i in range(400)]
    df = spark.createDataFrame([(*r, r[1] * 3 + (r[2] > 2) * r[3]) for r in rows], "id long, a double, b double, c double, y double")
    table, fitted = regress.compare_models(spark, df, "y", ["a", "b", "c"], ["id"])
    assert {r.model for r in table.collect()} == set(fitted)
    for name in ("Random Forest", "Gradient Boosting"):
        own = fitted[name].transform(df).withColumn("own", regress.tree_expression(fitted[name].stages[-1], ["a", "b", "c"]))
        rows = own.select("own", "prediction").collect()
        assert len({r.own for r in rows}) > 10 and all(abs(r.own - r.prediction) < 1e-9 for r in rows)


def test_compared_figures_are_the_single_ones(spark):
    df = spark.range(300).selectExpr("id", "CAST(id % 17 AS double) AS a", "CAST(id % 17 * 2 + id % 3 AS double) AS y")
    table, fitted = regress.compare_models(spark, df, "y", ["a"], ["id"])
    from itemlens.operators.split import hash_split

    _, test = hash_split(df, ["id"])
    for r in table.collect():
        want = evaluate.regression_metrics(fitted[r.model].transform(test), label="y").first()
        assert abs(r.rmse - want.rmse) < 1e-9 and abs(r.mae - want.mae) < 1e-9 and abs(r.r2 - want.r2) < 1e-9 and r.n == want.n


def test_category_index_orders_by_count_then_name(spark):
    df = spark.createDataFrame([(c,) for c in ["b", "a", "b", "c", "c", None, "d"]], "c string")
    got = [tuple(r) for r in regress.category_index(df, "c").orderBy("idx").collect()]
    assert got == [("b", 0, 2), ("c", 1, 2), ("a", 2, 1), ("d", 3, 1)]
    assert regress.category_index(df.limit(0), "c").count() == 0


def test_rejected_lines_are_kept_and_counted(spark, tmp_path):
    (tmp_path / "part.csv").write_text("p_partkey,p_name,p_brand,p_type,p_size,p_retailprice\n1,x,b,t,2,3.5\nbad,x,b,t,2,3.5\n3,y\n")
    read = catalog.read_csv(spark, str(tmp_path / "part.csv"), catalog.SCHEMAS["part"], rejects="_why")
    kept = {r.p_partkey: r["_why"] for r in read.cache().collect()}
    assert kept[1] is None and "bad,x,b,t,2,3.5" in kept.values()
    assert [tuple(r) for r in catalog.reject_report({"part": read}, "_why").collect()] == [("part", 3, 2)]


# Hot tables


def test_hot_tables_follow_their_sources_and_leave_nothing(spark, tmp_path):
    import os

    from itemlens.sources.hot import HotTables

    folder, built = str(tmp_path), []

    def write(n):
        spark.range(n).write.mode("overwrite").parquet(f"{folder}/part.parquet")

    def build():
        built.append(1)
        return spark.read.parquet(f"{folder}/part.parquet").selectExpr("id * 2 AS id")

    write(10)
    with HotTables(spark) as hot:
        for bucket in (None, "id"):
            name = f"doubled_{bucket}".lower()
            assert hot.table(folder, name, ("part",), build, bucket).count() == 10
            assert hot.table(folder, name, ("part",), build, bucket).count() == 10
        assert len(built) == 2 and hot.value(folder, "n", ("part",), lambda: 1) == 1 == hot.value(folder, "n", ("part",), lambda: 2)
        old = hot.paths()
        write(25)
        for bucket in (None, "id"):
            assert hot.table(folder, f"doubled_{bucket}".lower(), ("part",), build, bucket).count() == 25
        assert len(built) == 4 and hot.value(folder, "n", ("part",), lambda: 3) == 3
        assert not any(map(os.path.exists, old)) and all(map(os.path.exists, hot.paths()))
        paths = hot.paths()
    assert not any(map(os.path.exists, paths)) and not spark.catalog.listTables(pattern="itemlens_doubled*")

"""Registered queries: MLlib regression (M1-M14) and ALS recommendation (M15-M23, Q5-Q10 on ALS).

Model training is not SQL-expressible, so these are rows-only checks except ``regression_lr1`` whose single-feature
least squares has an exact SQL twin (``regr_slope`` / ``regr_intercept``).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from itemlens.operators import evaluate as EV
from itemlens.operators import gram, joins, recommend, regress, similarity, split
from itemlens.operators.topk import truncate_label
from itemlens.plans import views as V
from itemlens.plans.oracle_views import with_views
from itemlens.plans.q_clean import _Q2_SQL, _YEAR
from itemlens.plans.registry import register
from itemlens.sources.catalog import load
from itemlens.sources.hot import hot_tables

# Feature lists of the reference's models.
REVENUE_FEATURES = ["budget", "vote_count", "popularity", "runtime"]
VOTE_FEATURES = ["budget", "popularity", "runtime", "vote_count", "revenue"]
SCRIPT_FEATURES = ["budget", "vote_count", "release_year"]
SCRIPT_TARGETS = ("revenue", "vote_average")
LOOKUP_USER = 1
LOOKUP_TITLE = "red widget"
REPORT_USERS = 3


def r4(c):
    return F.round(c, 4)


# ------------------------------------------------------------------------------------------------- regression

_LR1_KEY = "CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)"
_LR1_BUCKET = f"CAST(('0x' || substr(md5({_LR1_KEY}), 1, 7)) AS BIGINT) % 100"


@register("regression_lr1", operators="M1 M5 M6 M9", bench=True, sql=f"""WITH s AS (
  SELECT l_quantity AS x, l_extendedprice AS y, {_LR1_BUCKET} AS bucket FROM lineitem),
fit AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, count(*) AS n_train
        FROM s WHERE bucket < 80)
SELECT round(max(fit.slope), 4) AS slope, round(max(fit.intercept), 4) AS intercept,
       round(sqrt(avg((s.y - (fit.intercept + fit.slope * s.x)) * (s.y - (fit.intercept + fit.slope * s.x)))), 4) AS rmse,
       max(fit.n_train) AS n_train, count(*) AS n_test
FROM s, fit WHERE s.bucket >= 80""")
def regression_lr1(spark, d):
    """Price on quantity: one-feature least squares fitted by MLlib, checked against SQL's closed form."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    train, test = split.hash_split(li, ["l_orderkey", "l_linenumber"])
    pipe = regress.fit_pipeline(
        train, [regress.assembler(["l_quantity"]), _lr("l_extendedprice")]
    )
    lr = pipe.stages[-1]
    scored = pipe.transform(test)
    m = EV.regression_metrics(scored, label="l_extendedprice")
    n_train = int(lr.summary.numInstances)  # counted during the fit: no extra pass over the training side
    return m.select(
        r4(F.lit(float(lr.coefficients[0]))).alias("slope"),
        r4(F.lit(float(lr.intercept))).alias("intercept"),
        r4(F.col("rmse")).alias("rmse"),
        F.lit(n_train).cast("bigint").alias("n_train"),
        F.col("n").alias("n_test"),
    )


def _lr(label):
    from pyspark.ml.regression import LinearRegression

    return LinearRegression(featuresCol="features", labelCol=label, solver="normal")


def _compare(spark, d, label, features):
    """The three models of a target, fitted once per state of the folder; later queries reuse the fitted pipelines."""
    return hot_tables(spark).value(
        d, f"compare {label}", ("part", "lineitem"),
        lambda: regress.compare_models(spark, V.analysis_items(spark, d), label, features, ["id"]),
    )


@register("regression_compare_revenue", operators="M1 M5 M6 M7 M8 M9 M10 M11 P8 F1", sql=None)
def regression_compare_revenue(spark, d):
    table, _ = _compare(spark, d, "revenue", REVENUE_FEATURES)
    return table


@register("regression_compare_vote", operators="M1 M5 M6 M7 M8 M9 M10 M11", sql=None)
def regression_compare_vote(spark, d):
    table, _ = _compare(spark, d, "vote_average", VOTE_FEATURES)
    return table


@register("feature_importance", operators="M13 T8", sql=None)
def feature_importance(spark, d):
    _, fitted = _compare(spark, d, "vote_average", VOTE_FEATURES)
    return regress.feature_importances(spark, fitted["Random Forest"], VOTE_FEATURES)


@register("sample_predictions", operators="M12 P9 T4", sql=None)
def sample_predictions(spark, d):
    data = V.analysis_items(spark, d).dropna(subset=["revenue", *REVENUE_FEATURES])
    train, test = split.hash_split(data, ["id"])
    pipe = regress.fit_pipeline(train, [regress.assembler(REVENUE_FEATURES), _lr("revenue")])
    return (
        pipe.transform(test)
        .select("id", truncate_label("title", 30).alias("title"), "revenue", "prediction")
        .orderBy("id")
        .limit(5)
    )


@register("regression_categorical", operators="M2 M3 M4 M5", sql=None)
def regression_categorical(spark, d):
    m, _ = regress.categorical_pipeline(
        V.analysis_items(spark, d), "revenue", REVENUE_FEATURES, ["original_language"], ["id"]
    )
    return m


def sig7(c):
    """A figure to seven significant digits, so that the last bits of sums don't matter."""
    return F.format_string("%.6e", c).cast("double")


def _script_sql(label: str) -> str:
    """Least squares on the three script features from covariances, solved by determinants, and its held-out metrics."""
    x = SCRIPT_FEATURES
    cov = [f"covar_pop({u}, {v}) AS c{i}{j}" for i, u in enumerate([*x, label]) for j, v in enumerate([*x, label]) if j >= i]
    c = lambda i, j: f"c{min(i, j)}{max(i, j)}"

    def det(columns: list) -> str:
        m = [[columns[j](i) for j in range(3)] for i in range(3)]
        return " + ".join(
            f"{m[0][i]} * ({m[1][(i + 1) % 3]} * {m[2][(i + 2) % 3]} - {m[1][(i + 2) % 3]} * {m[2][(i + 1) % 3]})" for i in range(3)
        )

    side = [lambda i, j=j: c(i, j) for j in range(3)]
    solved = ", ".join(
        f"({det([side[j] if j != k else (lambda i: c(i, 3)) for j in range(3)])}) / ({det(side)}) AS w{k}" for k in range(3)
    )
    line = "m3 + " + " + ".join(f"w{k} * ({f} - m{k})" for k, f in enumerate(x))
    figure = lambda e: f"CAST(printf('%.6e', {e}) AS DOUBLE)"
    return f"""SELECT '{label}' AS target, {figure('sqrt(avg(err * err))')} AS rmse, {figure('avg(abs(err))')} AS mae,
  {figure(f'1 - sum(err * err) / (count(*) * var_pop({label}))')} AS r2, count(*) AS n
FROM (SELECT {label}, {label} - ({line}) AS err FROM v_script,
  (SELECT *, {solved} FROM (SELECT {', '.join(f'avg({f}) AS m{i}' for i, f in enumerate([*x, label]))}, {', '.join(cov)}
    FROM v_script WHERE bucket < 80) f) w WHERE bucket >= 80) e"""


_SCRIPT_CTES = {
    "v_script_rows": _Q2_SQL.format(year=f"coalesce({_YEAR}, 0)"),
    "v_script": "SELECT *, CAST(('0x' || substr(md5(CAST(item_id AS VARCHAR)), 1, 7)) AS BIGINT) % 100 AS bucket FROM v_script_rows",
}
_SCRIPT_SQL = with_views(" UNION ALL ".join(_script_sql(t) for t in SCRIPT_TARGETS), "v_raw_items", extra=_SCRIPT_CTES)


def _script_metrics(spark, d, train):
    from itemlens.operators.clean import clean_items_for_regression

    data = clean_items_for_regression(V.raw_items(spark, d), fill_year=0)
    out = None
    for label in SCRIPT_TARGETS:
        _, m = train(data, SCRIPT_FEATURES, label, ["item_id"])
        m = m.select(F.lit(label).alias("target"), *(sig7(F.col(c)).alias(c) for c in ("rmse", "mae", "r2")), "n")
        out = m if out is None else out.unionByName(m)
    return out


@register("regression_script", operators="M14 M1 M6 M9 Q2 (D9)", sql=_SCRIPT_SQL)
def regression_script(spark, d):
    """The script's two regressions on three features, fitted by MLlib."""
    return _script_metrics(spark, d, regress.train_regression)


@register("regression_gram", operators="M14 M6 M9", sql=_SCRIPT_SQL)
def regression_gram(spark, d):
    """The same regressions in closed form from one aggregation each."""
    return _script_metrics(spark, d, gram.train)


@register("feature_table", operators="P8 F1 P1", sql=with_views(
    f"SELECT id, revenue, {', '.join(REVENUE_FEATURES)} FROM v_analysis WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in ["revenue", *REVENUE_FEATURES]), "v_analysis"))
def feature_table(spark, d):
    """The rows and columns that the revenue models are fitted on."""
    return V.analysis_items(spark, d).dropna(subset=["revenue", *REVENUE_FEATURES]).select("id", "revenue", *REVENUE_FEATURES)


_ID_BUCKET = "CAST(('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 7)) AS BIGINT) % 100"


def _complete(columns) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


@register("tree_expressions", operators="M7 M8 M13 P8", sql=with_views(" UNION ALL ".join(
    f"""SELECT '{m}' AS model, count(*) AS n_rows, CAST(0 AS BIGINT) AS mismatches, 1.0::DOUBLE AS importances
FROM v_analysis WHERE {_complete(["vote_average", *VOTE_FEATURES])} AND {_ID_BUCKET} >= 80""" for m in ("Random Forest", "Gradient Boosting")),
    "v_analysis"))
def tree_expressions(spark, d):
    """Both tree models as expressions: held-out rows on which they differ from the fitted pipeline, and the importances' sum."""
    _, fitted = _compare(spark, d, "vote_average", VOTE_FEATURES)
    data = V.analysis_items(spark, d).dropna(subset=["vote_average", *VOTE_FEATURES])
    _, test = split.hash_split(data, ["id"])
    out = None
    for name in ("Random Forest", "Gradient Boosting"):
        model = fitted[name].stages[-1]
        own = fitted[name].transform(test).withColumn("own", regress.tree_expression(model, VOTE_FEATURES))
        off = F.abs(F.col("own") - F.col("prediction")) > 1e-9 * (1 + F.abs(F.col("prediction")))
        part = own.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(off).alias("mismatches")).select(
            F.lit(name).alias("model"), "n_rows", "mismatches",
            F.lit(round(float(model.featureImportances.toArray().sum()), 9)).alias("importances"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@register("category_slots", operators="M2 M3 M4 T7", sql=with_views(
    """SELECT a.original_language AS category, CAST(coalesce(x.idx, k.n) AS BIGINT) AS idx,
  CAST(x.idx AS BIGINT) AS slot, count(*) AS n_rows
FROM v_analysis a LEFT JOIN x ON a.original_language = x.category, (SELECT count(*) AS n FROM x) k
GROUP BY ALL""", "v_analysis", extra={"x": f"""SELECT category, row_number() OVER (ORDER BY n DESC, category) - 1 AS idx FROM (
  SELECT original_language AS category, count(*) AS n FROM v_analysis WHERE original_language IS NOT NULL AND {_ID_BUCKET} < 80
  GROUP BY 1) c"""}))
def category_slots(spark, d):
    """Each language's index and one-hot slot as the fitted encoder gives them, with its rows; unseen and null ones share the
    index after the last and have no slot."""
    from pyspark.ml.functions import vector_to_array

    data = V.analysis_items(spark, d)
    train, _ = split.hash_split(data, ["id"])
    pipe = regress.fit_pipeline(train, regress.encoder_stages(["original_language"]))
    coded = pipe.transform(data.select("original_language"))
    place = F.array_position(vector_to_array("original_language_enc"), 1.0)
    return coded.groupBy(
        F.col("original_language").alias("category"),
        F.col("original_language_idx").cast("bigint").alias("idx"),
        F.when(place > 0, place - 1).alias("slot"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@register("category_index", operators="M2 T7", sql=with_views(
    """SELECT category, row_number() OVER (ORDER BY n DESC, category) - 1 AS idx, n FROM (
  SELECT original_language AS category, count(*) AS n FROM v_analysis WHERE original_language IS NOT NULL GROUP BY 1) c""", "v_analysis"))
def category_index(spark, d):
    return regress.category_index(V.analysis_items(spark, d), "original_language")


# -------------------------------------------------------------------------------------------------------- ALS

_ALS_SOURCES = ("lineitem", "orders", "part")


def _als(spark, d):
    """(model, train, test, ratings): ALS on the id-mapped ratings (user_id, tmdb_id, rating), hash split, trained once per
    state of the folder. The mapped ratings are a hot table: the fit, the lists and every report read them."""
    rwt = hot_tables(spark).table(
        d, "mapped_ratings", _ALS_SOURCES, lambda: joins.map_ids(V.ratings(spark, d), V.links(spark, d), V.titles(spark, d))
    )
    train, test = split.hash_split(rwt.select("user_id", "tmdb_id", "rating"), ["user_id", "tmdb_id"])
    model = hot_tables(spark).value(d, "als", _ALS_SOURCES, lambda: recommend.train_als(train, item_col="tmdb_id"))
    return model, train, test, rwt


def _als_recs(spark, d):
    """Top-20 ALS recommendations for every user, written once per application and shared by the list metrics."""
    model, _, _, _ = _als(spark, d)
    return hot_tables(spark).table(
        d, "als_recs", _ALS_SOURCES, lambda: recommend.als_top_n(model, recommend.RECS_PER_USER, item_col="tmdb_id")
    )


def _titles(spark, d):
    return V.titles(spark, d).groupBy("tmdb_id").agg(F.min("title").alias("title"))


# The mapped ratings and their split, as SQL.
_ALS_CTES = {
    "v_mapped": "SELECT r.user_id, l.tmdb_id, r.rating FROM v_ratings r JOIN v_links l ON r.item_id = l.movie_id "
    "JOIN (SELECT DISTINCT tmdb_id FROM v_titles) t ON l.tmdb_id = t.tmdb_id",
    "v_als_split": "SELECT *, CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|' || CAST(tmdb_id AS VARCHAR)), 1, 7)) "
    "AS BIGINT) % 100 AS bucket FROM v_mapped",
    "v_als_train": "SELECT user_id, tmdb_id, rating FROM v_als_split WHERE bucket < 80",
    "v_als_test": "SELECT user_id, tmdb_id, rating FROM v_als_split WHERE bucket >= 80",
}


def _als_sides(rwt):
    """The rows of both sides of the split with the column ``side``, in one pass over the mapped ratings."""
    return split.tag_hash_split(rwt.select("user_id", "tmdb_id", "rating"), ["user_id", "tmdb_id"], col="side")


def _als_scored(spark, d):
    """Both sides of the split with their predictions and the column ``side``, scored and written once per application."""
    model, _, _, rwt = _als(spark, d)
    both = _als_sides(rwt)
    return hot_tables(spark).table(d, "als_scored", _ALS_SOURCES, lambda: recommend.als_scores(model, both, item_col="tmdb_id"))


def _als_report(spark, d):
    """All figures of the scored sides: one row from one pass (:func:`itemlens.operators.evaluate.scored_report`)."""
    return EV.scored_report(_als_scored(spark, d))


_ERROR_COLUMNS = ["total", "valid", "missing", "rmse", "mae", "r2", "min_error", "max_error", "std_error"]


@register("als_train_eval", operators="M15 M16 M17 M18 M20 M9 A5 A6", bench=True, sql=None)
def als_train_eval(spark, d):
    """Cold-start accounting, error metrics, error statistics and shares of ALS on the held-out side, in one pass."""
    report = _als_report(spark, d)
    return report.select(*_ERROR_COLUMNS, *(c for c in report.columns if c.startswith("pct_within")))


@register("als_test_counts", operators="M20 F15 M17", sql=with_views(
    """SELECT count(*) AS total,
       count(CASE WHEN u.user_id IS NOT NULL AND i.tmdb_id IS NOT NULL THEN 1 END) AS valid,
       count(CASE WHEN u.user_id IS NULL OR i.tmdb_id IS NULL THEN 1 END) AS missing,
       count(DISTINCT t.user_id) AS users, count(DISTINCT t.tmdb_id) AS items
FROM v_als_test t LEFT JOIN (SELECT DISTINCT user_id FROM v_als_train) u ON t.user_id = u.user_id
LEFT JOIN (SELECT DISTINCT tmdb_id FROM v_als_train) i ON t.tmdb_id = i.tmdb_id""",
    "v_ratings", "v_links", "v_titles", extra=_ALS_CTES))
def als_test_counts(spark, d):
    """How many held-out ratings the model can score: a user or item without training rows has no factors."""
    held = _als_scored(spark, d).filter("side = 'test'")
    distinct = [held.agg(F.countDistinct(c)).scalar().alias(n) for c, n in (("user_id", "users"), ("tmdb_id", "items"))]
    return EV.cold_start_counts(held).select("total", "valid", "missing", *distinct)


@register("als_ranked_slots", operators="M19 T9 (positions)", sql=with_views(
    f"""SELECT u.user_id, CAST(p.pos AS INTEGER) AS pos FROM (SELECT DISTINCT user_id FROM v_als_train) u,
  (SELECT unnest(range(1, 1 + least({recommend.RECS_PER_USER}, (SELECT count(DISTINCT tmdb_id) FROM v_als_train)))) AS pos) p""",
    "v_ratings", "v_links", "v_titles", extra=_ALS_CTES))
def als_ranked_slots(spark, d):
    """Every training user gets the full list: (user, position) of the ALS recommendations."""
    return _als_recs(spark, d).select("user_id", F.col("pos").cast("int").alias("pos"))


@register("als_unrated_items", operators="Q6 J4 P5 M17 (items)", sql=with_views(
    f"""SELECT DISTINCT tmdb_id FROM v_titles WHERE tmdb_id IN (SELECT tmdb_id FROM v_als_train)
AND tmdb_id NOT IN (SELECT tmdb_id FROM v_mapped WHERE user_id = {LOOKUP_USER})
AND {LOOKUP_USER} IN (SELECT user_id FROM v_als_train)""", "v_ratings", "v_links", "v_titles", extra=_ALS_CTES))
def als_unrated_items(spark, d):
    """The items that the unrated predictions of a user cover."""
    model, _, _, rwt = _als(spark, d)
    unrated = joins.unrated_items(_titles(spark, d), rwt, LOOKUP_USER, item_col="tmdb_id")
    return recommend.predict_unrated(model, unrated, None, item_col="tmdb_id").select("tmdb_id")


@register("train_test_gap", operators="M21 (D2)", sql=None)
def train_test_gap(spark, d):
    """RMSE on the training side and on the held-out side (both RMSE, unlike the reference's mixed metric)."""
    return _als_report(spark, d).select("train_rmse", "test_rmse", "gap")


@register("factor_sizes", operators="A27 M23", sql=with_views(
    f"""SELECT 'user' AS "table", count(DISTINCT user_id) AS rows, {recommend.ALS_RANK} AS rank FROM v_als_train
UNION ALL SELECT 'item', count(DISTINCT tmdb_id), {recommend.ALS_RANK} FROM v_als_train""", "v_ratings", "v_links", "v_titles", extra=_ALS_CTES))
def factor_sizes(spark, d):
    model, _, _, _ = _als(spark, d)
    u = model.userFactors.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("user").alias("table"), "rows")
    i = model.itemFactors.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("item").alias("table"), "rows")
    return u.unionByName(i).withColumn("rank", F.lit(model.rank))


@register("als_similar_items", operators="Q5 M23 J9 X16 F7 T2 J3 F14 F6", sql=None)
def als_similar_items(spark, d):
    model, _, _, _ = _als(spark, d)
    factors = model.itemFactors.select(F.col("id").cast("long").alias("tmdb_id"), "features")
    return similarity.similar_items_by_title(
        factors, _titles(spark, d), LOOKUP_TITLE, 10, id_col="tmdb_id", vec_col="features"
    )


@register("als_predict_unrated", operators="Q6 J4 J5 P5 M17 J6 T2", sql=None)
def als_predict_unrated(spark, d):
    model, _, _, rwt = _als(spark, d)
    titles = _titles(spark, d)
    unrated = joins.unrated_items(titles, rwt, LOOKUP_USER, item_col="tmdb_id")
    top = recommend.predict_unrated(model, unrated, 10, item_col="tmdb_id")
    return joins.with_titles(top, titles, key="tmdb_id").orderBy(F.desc("prediction"), "tmdb_id")


@register("als_predict_unrated_all", operators="Q6 T1 J4 P5 M17 F14", sql=None)
def als_predict_unrated_all(spark, d):
    """The script variant of Q6: every unrated item of the user with its prediction, fully sorted (no limit)."""
    model, _, _, rwt = _als(spark, d)
    unrated = joins.unrated_items(_titles(spark, d), rwt, LOOKUP_USER, item_col="tmdb_id")
    return recommend.predict_unrated(model, unrated, None, item_col="tmdb_id")


@register("als_recommend_all", operators="M19 X8 X9 T9", sql=None)
def als_recommend_all(spark, d):
    """Every user's top 20 with their scores."""
    return _als_recs(spark, d)


@register("als_optimality", operators="M15 M16", sql=with_views(
    "SELECT user_id, CAST(0 AS INTEGER) AS violations FROM (SELECT DISTINCT user_id FROM v_als_train) u",
    "v_ratings", "v_links", "v_titles", extra=_ALS_CTES))
def als_optimality(spark, d):
    """Every training user's factors solve the user's non-negative least squares: components that violate it, none expected."""
    model, train, _, _ = _als(spark, d)
    return recommend.als_optimality(model, train, item_col="tmdb_id").select("user_id", "violations")


@register("als_pair_work", operators="M19 A1 A2", sql=with_views(
    """SELECT u.n AS users, i.n AS items, u.n * i.n AS pairs, TRUE AS within
FROM (SELECT count(DISTINCT user_id) AS n FROM v_als_train) u, (SELECT count(DISTINCT tmdb_id) AS n FROM v_als_train) i""",
    "v_ratings", "v_links", "v_titles", extra=_ALS_CTES))
def als_pair_work(spark, d):
    """How many pairs there are to score for the lists without seen items, and whether the pruned scoring stays within them
    and covers every user at least once."""
    model, train, _, _ = _als(spark, d)
    work = recommend.als_pair_work(model, train, recommend.RECS_PER_USER, item_col="tmdb_id")
    inside = (F.col("pairs_scored") <= F.col("pairs")) & (F.col("pairs_scored") >= F.col("users"))
    return work.select("users", "items", "pairs", inside.alias("within"))


@register("als_unseen_recs", operators="M19 (exclude_seen) §2.12", bench=True, sql=None)
def als_unseen_recs(spark, d):
    model, train, _, _ = _als(spark, d)
    return recommend.als_unseen_top_k(model, train, recommend.RECS_PER_USER, item_col="tmdb_id")


@register("als_user_report", operators="Q7 T4 F6 J6 J7 X18 T6 T9", sql=None)
def als_user_report(spark, d):
    """Held-out top-5 ratings and top-10 recommendations (titled, 'Movie <id>' default) for the first test users.

    The user ids are a bounded collect (``REPORT_USERS`` rows). Each user's held-out top 5 is its own
    ``TakeOrderedAndProject`` (every task keeps 5 rows, so a user with a huge history is never gathered into one
    window partition), and recommendations are computed for those users only.
    """
    model, _, test, _ = _als(spark, d)
    titles = _titles(spark, d)
    ids = [r[0] for r in test.select("user_id").distinct().orderBy("user_id").limit(REPORT_USERS).collect()]
    held = test.select("user_id", "tmdb_id", "rating", F.lit(0).alias("pos")).limit(0)
    for u in ids:
        top5 = test.filter(F.col("user_id") == u).orderBy(F.desc("rating"), "tmdb_id").limit(5)
        top5 = top5.withColumn("pos", F.row_number().over(Window.orderBy(F.desc("rating"), "tmdb_id")))
        held = held.unionByName(top5.select("user_id", "tmdb_id", "rating", "pos"))
    held = joins.with_titles(held, titles, key="tmdb_id", default_prefix="Movie").select(
        "user_id", F.lit("held_out").alias("section"), "pos", "tmdb_id", "title", F.col("rating").alias("value")
    )
    users = spark.createDataFrame([(int(u),) for u in ids], "user_id int")
    recs = model.recommendForUserSubset(users, 10)
    recs = recs.select("user_id", F.posexplode("recommendations").alias("p", "rec")).select(
        F.col("user_id").cast("long").alias("user_id"),
        (F.col("p") + 1).alias("pos"),
        F.col("rec.tmdb_id").cast("long").alias("tmdb_id"),
        F.col("rec.rating").cast("double").alias("value"),
    )
    recs = joins.with_titles(recs, titles, key="tmdb_id", default_prefix="Movie").select(
        "user_id", F.lit("recommended").alias("section"), "pos", "tmdb_id", "title", "value"
    )
    return held.unionByName(recs)


def _als_relevant(test):
    return test.filter(F.col("rating") >= EV.RELEVANT_RATING).select("user_id", "tmdb_id")


@register("als_precision_at_k", operators="Q8 J8 F8 T6", sql=None)
def als_precision_at_k(spark, d):
    model, _, test, _ = _als(spark, d)
    recs = _als_recs(spark, d)
    return EV.precision_at_k(recs, _als_relevant(test), item_col="tmdb_id")


@register("als_quality_report", operators="Q9 A24 A8 A7 A5 A6 M9 M21 A27", sql=None)
def als_quality_report(spark, d):
    """Coverage, bias, prediction distribution, errors, train/test gap and factor sizes of the ALS model as one tall
    (metric, value) frame. Everything about predictions comes from one pass over the scored sides."""
    _, _, _, rwt = _als(spark, d)
    sizes = factor_sizes(spark, d)
    return (
        _tall(EV.coverage(_als_recs(spark, d), rwt, item_col="tmdb_id").select("coverage"))
        .unionByName(_tall(_als_report(spark, d)))
        .unionByName(
            sizes.select(F.concat(F.col("table"), F.lit("_factors")).alias("metric"), F.col("rows").cast("double").alias("value"))
        )
    )


def _tall(wide):
    """One row of figures as (metric, value) rows, in one pass."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in wide.columns)
    return wide.selectExpr(f"stack({len(wide.columns)}, {pairs}) AS (metric, value)")


@register("als_top_recommended", operators="Q10 A25 J6 T5", sql=None)
def als_top_recommended(spark, d):
    model, _, _, _ = _als(spark, d)
    recs = _als_recs(spark, d)
    top = EV.recommendation_frequency(recs, 10, item_col="tmdb_id")
    return joins.with_titles(top, _titles(spark, d), key="tmdb_id", default_prefix="Movie").orderBy(
        F.desc("recommendation_count"), "tmdb_id"
    )

"""Adapters from the driver's TPC-H-like tables to the logical tables of a ratings/catalogue workload.

Each logical table is derived from the source tables, so every query's work grows with them. The two hot
aggregates (``ratings`` and the per-item sales behind ``items``) and the analysis frame are hot tables, written once to the
shared checkpoint folder (see :mod:`itemlens.sources.hot`); everything else is a lazy plan:

- ``ratings``  (user_id, item_id, rating): customers rate the parts they ordered, rating = avg quantity / 10.
- ``items``    (item_id, title, budget, revenue, vote_count, vote_average, runtime, language, category,
  release_date, popularity): the item catalogue, one row per part with sales.
- ``raw_items``: ``items`` as dirty text (ids, numbers, dates, JSON and delimited genres) to exercise cleaning.
- ``links``    (movie_id, tmdb_id, imdb_id): second id space, with extra rows whose id is null.
- ``titles``   (tmdb_id, title): the catalogue keyed by the second id space.
- ``vectors``  (vec_id, embedding, label), ``doc_labels`` (documents with labels), ``events``.

The SQL twins of these adapters (for the DuckDB oracle) live in :mod:`itemlens.plans.oracle_views`; the two must stay in
step. Aggregated money and ratio columns are rounded here, at the adapter, so both engines see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemlens.sources.catalog import load
from itemlens.sources.hot import fingerprint, hot_tables

# Fixed adapter parameters: which derived rows carry dirty or missing values.
BAD_ID_MOD = 7
BAD_BUDGET_MOD = 11
BAD_DATE_MOD = 13
BAD_GENRES_MOD = 19
EMPTY_GENRES_MOD = 23
NULL_TITLE_MOD = 29
NULL_LANGUAGE_MOD = 31
NULL_RUNTIME_MOD = 37
NULL_TMDB_MOD = 17
UNTITLED_MOD = 5
BAD_RATING_MOD = 97
# Popularity threshold of the analysis frame here: vote counts are lines per part (about 30 on average), so the cut sits
# at 30 instead of the operator's default to keep about half of the catalogue.
EDA_MIN_VOTES = 30
# Bytes of stored line items per task that groups them into ratings, about half a million rows.
RATINGS_PART_BYTES = 8 << 20


def ratings(spark: SparkSession, d: str) -> DataFrame:
    """(user_id, item_id, rating), a hot table (:mod:`itemlens.sources.hot`)."""
    # Not bucketed: one item may hold a third of all ratings, and a bucket per item would put that third in one
    # write task and one scan task. Plain parquet splits evenly; item-keyed aggregations combine partially first and
    # skewed item joins are split by adaptive execution.
    return hot_tables(spark).table(d, "ratings", ("lineitem", "orders"), lambda: ratings_plan(spark, d))


def ratings_plan(spark: SparkSession, d: str) -> DataFrame:
    """(user_id, item_id, rating): one rating per (customer, part) pair.

    Plan: lineitem and orders are both large, so this is a shuffle (sort-merge) join on the order key (AQE turns it
    into a broadcast join only when the orders side is small at runtime). Nearly every pair is rated once, so partial
    aggregation before the shuffle on (user, item) would only fill a table per task; rows are dealt by pair instead, to as
    many tasks as the input's size asks for, which bounds what a task holds.
    """
    li = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    (_, size, _, _), = fingerprint(spark, d, ("lineitem",))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RATINGS_PART_BYTES))
    rows = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"), "l_quantity"
    )
    return rows.repartition(parts, "user_id", "item_id").groupBy("user_id", "item_id").agg((F.avg("l_quantity") / 10).alias("rating"))


def _cents(c: str):
    """A two-decimal amount as an exact integer number of hundredths."""
    return F.round(F.col(c) * 100).cast("bigint")


def item_sales(spark: SparkSession, d: str) -> DataFrame:
    """Per-part sales aggregates, a hot table (:mod:`itemlens.sources.hot`).

    One row per item, so buckets on ``item_id`` are even by construction and item-keyed joins skip this side's
    shuffle.
    """
    return hot_tables(spark).table(d, "item_sales", ("lineitem",), lambda: item_sales_plan(spark, d), bucket_by="item_id")


def item_sales_plan(spark: SparkSession, d: str) -> DataFrame:
    """Per-part sales aggregates (partial aggregation before the shuffle on the part key).

    Money is summed as exact integers (price in cents times the kept percentage, i.e. units of 1/10000) so the sum
    does not depend on the order the rows are added in; averages of integers are exact too.
    """
    li = load(spark, d, "lineitem")
    return li.groupBy(F.col("l_partkey").alias("item_id")).agg(
        F.sum(_cents("l_extendedprice") * (100 - _cents("l_discount"))).cast("double").alias("revenue"),
        F.count(F.lit(1)).alias("vote_count"),
        (F.avg("l_quantity") / 5).alias("vote_average"),
        F.sum(_cents("l_tax")).cast("double").alias("popularity"),
    )


def items(spark: SparkSession, d: str) -> DataFrame:
    """The item catalogue. ``part`` is one row per item, sales one row per item: an equi-join on the item key."""
    p = load(spark, d, "part")
    key = F.col("p_partkey")
    return p.join(item_sales(spark, d), p.p_partkey == F.col("item_id")).select(
        F.col("item_id"),
        F.col("p_name").alias("title"),
        (_cents("p_retailprice") * F.col("p_size") / 2).alias("budget"),
        F.col("revenue"),
        F.col("vote_count"),
        F.col("vote_average"),
        (F.col("p_size") * 4).cast("double").alias("runtime"),
        F.col("p_brand").alias("language"),
        F.col("p_type").alias("category"),
        F.make_date(
            (F.lit(1980) + key % 40).cast("int"), (F.lit(1) + key % 12).cast("int"), (F.lit(1) + key % 28).cast("int")
        ).alias("release_date"),
        F.col("popularity"),
    )


def raw_items(spark: SparkSession, d: str, dirty: bool = True) -> DataFrame:
    """``items`` as text columns, like a movie-metadata CSV export; with dirt for the cleaning queries."""
    it = items(spark, d)

    def _when_mod(key, mod: int, value, otherwise):
        return F.when(key % mod == 0, value).otherwise(otherwise) if dirty else otherwise

    k = F.col("item_id")
    word = F.split_part(F.col("title"), F.lit(" "), F.lit(1))
    cat = F.col("category")
    genres_json = F.concat(
        F.lit('[{"id": '), (k % 6).cast("string"), F.lit(', "name": "'), cat,
        F.lit('"}, {"id": 100, "name": "'), word, F.lit('"}]'),
    )
    genre_tags = (
        F.when(k % 4 == 0, F.concat(cat, F.lit("|"), word))
        .when(k % 4 == 1, F.concat(cat, F.lit(", "), word))
        .when(k % 4 == 2, F.concat(F.lit("['"), cat, F.lit("', '"), word, F.lit("']")))
        .otherwise(cat)
    )
    return it.select(
        _when_mod(k, BAD_ID_MOD, F.concat(F.lit("x"), k.cast("string")), k.cast("string")).alias("id"),
        _when_mod(k, NULL_TITLE_MOD, F.lit(None).cast("string"), F.col("title")).alias("title"),
        _when_mod(k, BAD_BUDGET_MOD, F.lit("bad"), F.col("budget").cast("string")).alias("budget"),
        F.col("revenue").cast("string").alias("revenue"),
        F.col("vote_average").cast("string").alias("vote_average"),
        F.col("vote_count").cast("string").alias("vote_count"),
        F.col("popularity").cast("string").alias("popularity"),
        _when_mod(k, NULL_RUNTIME_MOD, F.lit(None).cast("string"), F.col("runtime").cast("string")).alias("runtime"),
        _when_mod(k, BAD_DATE_MOD, F.lit("n/a"), F.col("release_date").cast("string")).alias("release_date"),
        _when_mod(
            k, BAD_GENRES_MOD, F.lit("garbage"), _when_mod(k, EMPTY_GENRES_MOD, F.lit("[]"), genres_json)
        ).alias("genres"),
        genre_tags.alias("genre_tags"),
        _when_mod(k, NULL_LANGUAGE_MOD, F.lit(None).cast("string"), F.col("language")).alias("original_language"),
    )


def raw_ratings(spark: SparkSession, d: str) -> DataFrame:
    """``ratings`` as text, with an unparsable rating on some rows, like a ratings CSV export."""
    r = ratings(spark, d)
    bad = (F.col("user_id") * 31 + F.col("item_id")) % BAD_RATING_MOD == 0
    return r.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("item_id").cast("string").alias("item_id"),
        F.when(bad, F.lit("n/a")).otherwise(F.col("rating").cast("string")).alias("rating"),
    )


def clean_items(spark: SparkSession, d: str) -> DataFrame:
    """The cleaned catalogue (Q1 applied to ``raw_items``)."""
    from itemlens.operators.clean import clean_items as _clean

    return _clean(raw_items(spark, d))


def analysis_items(spark: SparkSession, d: str) -> DataFrame:
    """The analysis frame of the exploratory queries: all items (none dirtied), cleaned, above the popularity cut.

    A hot table: every chart and summary reads it, some several times, and none should parse and clean again.
    """
    return hot_tables(spark).table(d, "analysis_items", ("part", "lineitem"), lambda: analysis_plan(spark, d))


def analysis_plan(spark: SparkSession, d: str) -> DataFrame:
    from itemlens.operators.clean import clean_items as _clean
    from itemlens.operators.clean import popular_items

    return popular_items(_clean(raw_items(spark, d, dirty=False)), EDA_MIN_VOTES)


def links(spark: SparkSession, d: str) -> DataFrame:
    """(movie_id, tmdb_id, imdb_id): id map from the ratings id space to the catalogue id space.

    Every rated item is mapped; extra rows (negative ids, which nobody rates) have a null catalogue id.
    """
    k = F.col("p_partkey")
    imdb = F.concat(F.lit("tt"), F.lpad(k.cast("string"), 7, "0"))
    part = load(spark, d, "part").select("p_partkey")
    mapped = part.select(k.alias("movie_id"), (k * 7 + 3).alias("tmdb_id"), imdb.alias("imdb_id"))
    extra = part.filter(k % NULL_TMDB_MOD == 0)
    return mapped.unionByName(
        extra.select((-k).alias("movie_id"), F.lit(None).cast("long").alias("tmdb_id"), imdb.alias("imdb_id"))
    )


def titles(spark: SparkSession, d: str) -> DataFrame:
    """(tmdb_id, title): the catalogue re-keyed by the second id space."""
    return items(spark, d).select((F.col("item_id") * 7 + 3).alias("tmdb_id"), F.col("title"))


def partial_titles(spark: SparkSession, d: str) -> DataFrame:
    """``titles`` with every fifth item missing, for the query whose feature is the default title."""
    it = items(spark, d)
    return it.filter(F.col("item_id") % UNTITLED_MOD != 0).select(
        (F.col("item_id") * 7 + 3).alias("tmdb_id"), F.col("title")
    )


def vectors(spark: SparkSession, d: str) -> DataFrame:
    """(vec_id, embedding, label): stands in for an item factor table."""
    return load(spark, d, "embeddings")


def doc_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents: documents joined to labels on doc_id (both keyed by doc id)."""
    docs = load(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return docs.join(load(spark, d, "labels"), "doc_id")


def events(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events")

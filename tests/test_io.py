"""Sources and sinks: CSV quoting, load report, chart-data sink, streaming ingest."""

import tempfile

from pyspark.sql import functions as F

from itemlens.operators.clean import clean_ratings
from itemlens.plans import views as V
from itemlens.sources import catalog, sinks
from itemlens.streaming.ingest import clean_ratings_stream


def test_csv_quotes_commas_and_newlines(spark):
    d = tempfile.mkdtemp(prefix="itemlens-csv-")
    with open(f"{d}/x.csv", "w") as f:
        f.write('id,title\n1,"He said ""hi, there"""\n2,"two\nlines"\n')
    df = catalog.read_csv(spark, d, "id int, title string", multi_line=True)
    got = {r["id"]: r["title"] for r in df.collect()}
    assert got == {1: 'He said "hi, there"', 2: "two\nlines"}


def test_csv_missing_path_raises(spark):
    import pytest
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        catalog.read_csv(spark, "/nonexistent/itemlens/path.csv", "id int").collect()


def test_load_report_counts(spark, sf_small):
    got = {r["table_name"]: r["row_count"] for r in catalog.load_report(spark, sf_small).collect()}
    assert got["region"] == 5 and got["nation"] == 25 and set(got) == set(catalog.TABLES)


def test_schema_report(spark, sf_small):
    cols = catalog.schema_report(catalog.load(spark, sf_small, "part"))
    assert cols[0] == ("p_partkey", "bigint") and ("p_size", "int") in cols


def test_write_series_partitioned(spark):
    d = tempfile.mkdtemp(prefix="itemlens-series-")
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "panel string, y double")
    sinks.write_series(df, d + "/out", partition_by=["panel"])
    back = spark.read.parquet(d + "/out").filter(F.col("panel") == "b")
    assert [r["y"] for r in back.collect()] == [2.0]


def test_streaming_clean_matches_batch(spark, sf_small):
    d = tempfile.mkdtemp(prefix="itemlens-stream-")
    raw = V.raw_ratings(spark, sf_small)
    raw.repartition(3).write.option("header", True).csv(d + "/src")
    q = clean_ratings_stream(spark, d + "/src", d + "/sink", checkpoint_dir=d + "/ckpt")
    q.awaitTermination(300)
    got = spark.read.parquet(d + "/sink")
    want = clean_ratings(raw)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_movie_exports_pipeline(spark):
    import os

    from itemlens.plans.movies import MovieData

    d = tempfile.mkdtemp(prefix="itemlens-movies-")
    with open(os.path.join(d, "movies_metadata.csv"), "w") as f:
        f.write("adult,budget,genres,id,original_language,popularity,release_date,revenue,runtime,title,"
                "vote_average,vote_count\n")
        f.write('False,30000000,"[{\'id\': 16, \'name\': \'Animation\'}]",862,en,21.9,1995-10-30,373554033,81,'
                '"Toy Story",7.7,5415\n')
        f.write('False,65000000,"[{\'id\': 12, \'name\': \'Adventure\'}]",8844,en,17.0,bad,262797249,104,'
                '"Jumanji, ""the game""",6.9,2413\n')
        f.write("False,/x.jpg,[],12a,en,1.0,1995-01-01,1000,90,Broken,5.0,100\n")
        f.write('False,2000,garbage,949,en,3.0,1995-12-15,5000,170,"Two\nlines",7.0,11\n')
    with open(os.path.join(d, "ratings.csv"), "w") as f:
        f.write("userId,movieId,rating,timestamp\n1,1,4.0,964982703\n1,2,n/a,964981247\n2,1,5.0,1\n2,3,3.0,1\n")
    with open(os.path.join(d, "links.csv"), "w") as f:
        f.write("movieId,imdbId,tmdbId\n1,0114709,862\n2,0113497,8844\n3,0113228,\n")
    for name in ("keywords.csv", "credits.csv"):
        with open(os.path.join(d, name), "w") as f:
            f.write("id,x\n862,a\n")
    m = MovieData(spark, d)
    movies = {r["id"]: r for r in m.movies.collect()}
    assert set(movies) == {"862", "8844", "949"}
    assert movies["862"]["genres_list"] == ["Animation"] and movies["862"]["release_year"] == 1995
    assert movies["8844"]["title"] == 'Jumanji, "the game"' and movies["8844"]["release_year"] is None
    assert movies["949"]["title"] == "Two\nlines"
    got = sorted(tuple(r) for r in m.ratings_with_titles.collect())
    assert got == [(1, 862, "Toy Story", 4.0), (2, 862, "Toy Story", 5.0)]


def test_hot_tables_written_once(spark, sf_small):
    from itemlens.plans import views as V
    from itemlens.sources.hot import hot_tables

    a = V.ratings(spark, sf_small)
    n = len(hot_tables(spark).paths())
    b = V.ratings(spark, sf_small)
    assert len(hot_tables(spark).paths()) == n and a.count() == b.count()
    sales = V.item_sales(spark, sf_small)
    plan = sales.groupBy("item_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the item table is bucketed on its key
    assert a.groupBy("item_id").count()._jdf.queryExecution().executedPlan().toString().count("Exchange") >= 1


def test_streaming_restart_is_exactly_once(spark, sf_small):
    d = tempfile.mkdtemp(prefix="itemlens-restart-")
    raw = V.raw_ratings(spark, sf_small)
    first = raw.filter(F.col("user_id").cast("long") % 2 == 0)
    second = raw.filter(F.col("user_id").cast("long") % 2 == 1)
    first.write.option("header", True).csv(d + "/src/a")
    q = clean_ratings_stream(spark, d + "/src/*", d + "/sink", checkpoint_dir=d + "/ckpt")
    q.awaitTermination(300)
    n1 = spark.read.parquet(d + "/sink").count()
    second.write.option("header", True).csv(d + "/src/b")
    q = clean_ratings_stream(spark, d + "/src/*", d + "/sink", checkpoint_dir=d + "/ckpt")  # restart, same checkpoint
    q.awaitTermination(300)
    got = spark.read.parquet(d + "/sink")
    assert n1 == clean_ratings(first).count()
    assert got.count() == clean_ratings(raw).count()
    assert got.exceptAll(clean_ratings(raw)).count() == 0


def test_csv_to_parquet_and_csv_catalog(spark, sf_small):
    d = tempfile.mkdtemp(prefix="itemlens-csvcat-")
    part = catalog.load(spark, sf_small, "part")
    catalog.write_csv(part, d + "/part.csv")
    back = catalog.load(spark, d, "part", fmt="csv")
    assert back.schema == catalog.SCHEMAS["part"]
    assert back.exceptAll(part).count() == 0 and back.count() == part.count()
    pq = catalog.csv_to_parquet(spark, d + "/part.csv", d + "/part.parquet", catalog.SCHEMAS["part"])
    assert pq.count() == part.count()


def test_csv_splits_and_infers_types(spark):
    d = tempfile.mkdtemp(prefix="itemlens-csvsplit-")
    spark.range(200_000).selectExpr("id", "id / 2 AS half", "concat('t', id) AS name").coalesce(1).write.option("header", True).csv(d + "/x")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        df = catalog.read_csv(spark, d + "/x", infer_types=True)
        assert df.dtypes == [("id", "int"), ("half", "double"), ("name", "string")]
        assert df.rdd.getNumPartitions() > 1 and df.count() == 200_000
        assert [t for _, t in catalog.read_csv(spark, d + "/x").dtypes] == ["string"] * 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)

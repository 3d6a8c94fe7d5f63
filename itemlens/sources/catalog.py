"""Named source catalog (S1-S5): parquet and CSV tables with explicit schemas, and the load report.

Parquet is the default format: column pruning and filter pushdown reach the scan. CSV is supported for raw movie
style exports; it is read with an explicit schema (no inference job) and ``"``-escaping so quoted fields with commas
survive. ``multiLine`` handles embedded newlines but makes a file unsplittable, so large CSV sources should be read
once and written to parquet (see :func:`csv_to_parquet`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Explicit schemas of the driver-generated parquet tables. Reading with a schema skips footer-based inference
# differences and documents the contract.
SCHEMAS: dict[str, T.StructType] = {
    "region": T.StructType([T.StructField("r_regionkey", T.IntegerType()), T.StructField("r_name", T.StringType())]),
    "nation": T.StructType(
        [
            T.StructField("n_nationkey", T.IntegerType()),
            T.StructField("n_name", T.StringType()),
            T.StructField("n_regionkey", T.IntegerType()),
        ]
    ),
    "customer": T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_nationkey", T.IntegerType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_mktsegment", T.StringType()),
        ]
    ),
    "supplier": T.StructType(
        [
            T.StructField("s_suppkey", T.LongType()),
            T.StructField("s_name", T.StringType()),
            T.StructField("s_nationkey", T.IntegerType()),
            T.StructField("s_acctbal", T.DoubleType()),
        ]
    ),
    "part": T.StructType(
        [
            T.StructField("p_partkey", T.LongType()),
            T.StructField("p_name", T.StringType()),
            T.StructField("p_brand", T.StringType()),
            T.StructField("p_type", T.StringType()),
            T.StructField("p_size", T.IntegerType()),
            T.StructField("p_retailprice", T.DoubleType()),
        ]
    ),
    "orders": T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderdate", T.TimestampNTZType()),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    ),
    "lineitem": T.StructType(
        [
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("l_partkey", T.LongType()),
            T.StructField("l_suppkey", T.LongType()),
            T.StructField("l_linenumber", T.IntegerType()),
            T.StructField("l_quantity", T.DoubleType()),
            T.StructField("l_extendedprice", T.DoubleType()),
            T.StructField("l_discount", T.DoubleType()),
            T.StructField("l_tax", T.DoubleType()),
            T.StructField("l_returnflag", T.StringType()),
            T.StructField("l_linestatus", T.StringType()),
            T.StructField("l_shipdate", T.TimestampNTZType()),
        ]
    ),
    "events": T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    ),
    "documents": T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    ),
    "embeddings": T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("embedding", T.ArrayType(T.FloatType())),
            T.StructField("label", T.IntegerType()),
        ]
    ),
    "pages": T.StructType(
        [
            T.StructField("page_id", T.LongType()),
            T.StructField("url", T.StringType()),
            T.StructField("html", T.StringType()),
        ]
    ),
    "benchmark": T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]),
    "labels": T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("quality", T.IntegerType()),
            T.StructField("toxic", T.IntegerType()),
        ]
    ),
    "conversations": T.StructType(
        [
            T.StructField("conv_id", T.LongType()),
            T.StructField("turn", T.LongType()),
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    ),
}


def table_path(base_dir: str, name: str, fmt: str = "parquet") -> str:
    return f"{base_dir.rstrip('/')}/{name}.{fmt}"


def load(spark: SparkSession, base_dir: str, name: str, fmt: str = "parquet") -> DataFrame:
    """S3: load a named table from a catalog folder (parquet by default, CSV with header otherwise)."""
    if name not in SCHEMAS:
        raise KeyError(f"unknown table {name!r}; known: {', '.join(TABLES)}")
    if fmt == "parquet":
        return spark.read.schema(SCHEMAS[name]).parquet(table_path(base_dir, name))
    if fmt == "csv":
        return read_csv(spark, table_path(base_dir, name, "csv"), SCHEMAS[name])
    raise ValueError(f"unsupported format {fmt!r}")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    escape_quotes: bool = True,
    multi_line: bool = False,
    infer_types: bool = False,
    rejects: str | None = None,
) -> DataFrame:
    """CSV scan with header.

    With a schema its types are applied by position; without one every column is text, or with ``infer_types`` of the
    type that an extra pass over the file finds.
    ``escape_quotes`` reads ``""`` inside a quoted field as one quote, so a quoted
    field holding commas and quotes stays one field; ``multi_line`` keeps embedded newlines inside one field, at
    the price of one task per file; without it Spark splits large files. With ``rejects`` and a schema, a line that does
    not fit is kept as text in the column of that name, which is null for good lines. A missing path raises ``AnalysisException`` (PATH_NOT_FOUND) instead of returning None.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("inferSchema", infer_types and schema is None)
    if escape_quotes:
        reader = reader.option("quote", '"').option("escape", '"')
    if multi_line:
        reader = reader.option("multiLine", True)
    if schema is not None:
        if rejects:
            schema = T.StructType([*schema.fields, T.StructField(rejects, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", rejects)
        reader = reader.schema(schema)
    return reader.csv(path)


def reject_report(sources: dict[str, DataFrame], rejects: str) -> DataFrame:
    """S4 for text sources read with ``rejects``: (table_name, row_count, rejected) per source, one pass over each."""
    parts = [
        # Every column is asked for: a parser that is asked for fewer looks at fewer.
        df.select(F.col(rejects), F.struct(*df.columns).alias("row")).groupBy().agg(
            F.count("row").alias("row_count"), F.count(F.when(F.col(rejects).isNotNull(), F.col("row"))).alias("rejected")
        ).select(F.lit(name).alias("table_name"), "row_count", "rejected")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def write_csv(df: DataFrame, path: str) -> None:
    """Write a table as CSV with header and ``"``-escaping (the inverse of :func:`read_csv`)."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", False)
        .csv(path)
    )


def csv_to_parquet(
    spark: SparkSession, csv_path: str, parquet_path: str, schema: T.StructType, *, multi_line: bool = False
) -> DataFrame:
    """Read a CSV once and persist it as splittable parquet."""
    read_csv(spark, csv_path, schema, multi_line=multi_line).write.mode("overwrite").parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def load_report(spark: SparkSession, base_dir: str, names=TABLES) -> DataFrame:
    """Row count per source as one relation ``(table_name, row_count)``.

    No column is read for a count (the scan's schema is empty); the per-table one-row results are unioned.
    """
    parts = [
        load(spark, base_dir, n).groupBy().agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("table_name"), "row_count"
        )
        for n in names
    ]
    return reduce(DataFrame.unionByName, parts)


def schema_report(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and Spark SQL types of a relation (metadata only, no job)."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


# The five CSV exports of the movie workload (ids are renamed to snake_case on load).
MOVIE_SOURCES = {
    "movies": "movies_metadata.csv",
    "keywords": "keywords.csv",
    "credits": "credits.csv",
    "links": "links.csv",
    "ratings": "ratings.csv",
}
# Exports whose free-text fields may hold line ends; the others split.
_MULTI_LINE = {"movies", "keywords", "credits"}
_RENAMES = {
    "ratings": {"userId": "user_id", "movieId": "movie_id"},
    "links": {"movieId": "movie_id", "tmdbId": "tmdb_id", "imdbId": "imdb_id"},
}


def read_csv_text(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """A CSV export read with its header, every column as text (no inference job), ``"``-escaped.

    Wide exports carry more columns than a pipeline uses; an explicit schema is applied by position and would
    mislabel them, so columns are taken by header name and typed later with ``try_cast`` by the cleaning operators.
    """
    return read_csv(spark, path, None, multi_line=multi_line)


def load_movie_sources(spark: SparkSession, base_dir: str, names=tuple(MOVIE_SOURCES)) -> dict[str, DataFrame]:
    """S3 for the movie exports: name -> text DataFrame, ids renamed (``userId`` -> ``user_id`` ...)."""
    out = {}
    for n in names:
        df = read_csv_text(spark, f"{base_dir.rstrip('/')}/{MOVIE_SOURCES[n]}", multi_line=n in _MULTI_LINE)
        for old, new in _RENAMES.get(n, {}).items():
            if old in df.columns:
                df = df.withColumnRenamed(old, new)
        out[n] = df
    return out

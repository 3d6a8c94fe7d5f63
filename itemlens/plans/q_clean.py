"""Registered queries: cleaning (Q1-Q3), genre text normalisation (X10), JSON property parsing (X5, X9), CSV I/O."""

from __future__ import annotations

from pyspark.sql import functions as F

from itemlens.functions import text as TX
from itemlens.operators import clean
from itemlens.plans import views as V
from itemlens.plans.oracle_views import with_views
from itemlens.plans.registry import register
from itemlens.session import scratch_path
from itemlens.sources import catalog

# The part keys whose line is broken in the query about rejected lines.
BAD_LINE_MOD = 13

_CLEAN_COLS = (
    "id, title, budget, revenue, vote_average, vote_count, popularity, runtime, release_year, "
    "array_to_string(genres_list, '|') AS genres, len(genres_list) AS n_genres, original_language"
)


@register("clean_items", operators="Q1 P2 P3 P6 P7 F1 F3 X3 X4 X5 X6 X7", bench=True, sql=with_views(
    f"SELECT {_CLEAN_COLS} FROM v_clean_items", "v_clean_items"))
def clean_items(spark, d):
    c = V.clean_items(spark, d)
    return c.select(
        "id", "title", "budget", "revenue", "vote_average", "vote_count", "popularity", "runtime", "release_year",
        F.array_join("genres_list", "|").alias("genres"),
        F.size("genres_list").cast("bigint").alias("n_genres"),
        "original_language",
    )


_Q2_SQL = """SELECT * FROM (
  SELECT TRY_CAST(id AS BIGINT) AS item_id,
         TRY_CAST(budget AS DOUBLE) AS budget, TRY_CAST(vote_count AS DOUBLE) AS vote_count,
         {year} AS release_year,
         TRY_CAST(revenue AS DOUBLE) AS revenue, TRY_CAST(vote_average AS DOUBLE) AS vote_average
  FROM v_raw_items WHERE regexp_matches(id, '^\\d+$')) t
WHERE item_id IS NOT NULL AND budget IS NOT NULL AND vote_count IS NOT NULL AND release_year IS NOT NULL
  AND revenue IS NOT NULL AND vote_average IS NOT NULL"""
_YEAR = "CAST(year(try_strptime(release_date, '%Y-%m-%d')) AS INTEGER)"


@register("clean_items_fill_year", operators="Q2 F5 X1 X2 X3 F2 P6 P7 (D9 fill_year=0)", sql=with_views(
    _Q2_SQL.format(year=f"coalesce({_YEAR}, 0)"), "v_raw_items"))
def clean_items_fill_year(spark, d):
    return clean.clean_items_for_regression(V.raw_items(spark, d), fill_year=0)


@register("clean_items_drop_year", operators="Q2 F5 X1 X3 F2 (missing year drops)", sql=with_views(
    _Q2_SQL.format(year=_YEAR), "v_raw_items"))
def clean_items_drop_year(spark, d):
    return clean.clean_items_for_regression(V.raw_items(spark, d))


@register("clean_ratings", operators="Q3 P6 P7 F2", sql=with_views(
    """SELECT * FROM (SELECT TRY_CAST(user_id AS BIGINT) AS user_id, TRY_CAST(item_id AS BIGINT) AS item_id,
                  TRY_CAST(rating AS DOUBLE) AS rating FROM v_raw_ratings) t
WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL""", "v_raw_ratings"))
def clean_ratings(spark, d):
    return clean.clean_ratings(V.raw_ratings(spark, d))


def _tags_sql(source: str) -> str:
    """(id, genre_pos, genre) rows of the delimited genre text of ``source`` (the SQL twin of genres_from_tags)."""
    return f"""SELECT id, genre_pos, genre FROM (
  SELECT id, UNNEST(g) AS genre, UNNEST(range(1, len(g) + 1)) AS genre_pos FROM (
    SELECT id, list_filter(list_transform(pieces, lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS g FROM (
      SELECT id, CASE
          WHEN starts_with(s, '[') AND ends_with(s, ']')
            THEN string_split(translate(regexp_replace(s, '^[\\[\\]]+|[\\[\\]]+$', '', 'g'), '''"', ''), ',')
          WHEN contains(s, '|') THEN string_split(s, '|')
          WHEN contains(s, ',') THEN string_split(s, ',')
          ELSE [s] END AS pieces
      FROM (SELECT id, genre_tags AS s FROM {source} WHERE genre_tags IS NOT NULL) a) b) c) e"""


def _tags(df):
    return df.select("id", F.posexplode(TX.genres_from_tags("genre_tags")).alias("pos", "genre")).select(
        "id", (F.col("pos") + 1).cast("bigint").alias("genre_pos"), "genre"
    )


@register("genre_text_normalise", operators="X10 X8", sql=with_views(_tags_sql("v_raw_items"), "v_raw_items"))
def genre_text_normalise(spark, d):
    return _tags(V.raw_items(spark, d))


@register("tag_counts", operators="X10 X8 A13 T7", sql=with_views(
    f"""SELECT genre, count(*) AS n FROM ({_tags_sql("v_analysis")}) t GROUP BY genre
ORDER BY n DESC, genre LIMIT 10""", "v_analysis"))
def tag_counts(spark, d):
    """Genre frequencies from delimited genre text over the analysis frame (the rating-factor panel's genre path)."""
    from itemlens.operators.eda import value_counts

    return value_counts(_tags(V.analysis_items(spark, d)), "genre", k=10)


@register("json_props_parse", operators="X5 X9", sql="""SELECT event_id, event_type,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_props_parse(spark, d):
    ev = V.events(spark, d)
    return ev.select("event_id", "event_type", F.from_json("props", "k INT")["k"].alias("k"))


@register("csv_scan_roundtrip", operators="S1 S2", sql="SELECT * FROM part")
def csv_scan_roundtrip(spark, d):
    """Write ``part`` as quoted CSV into the shared scratch folder and read it back with the explicit schema."""
    path = scratch_path(spark, "part-csv")
    catalog.write_csv(catalog.load(spark, d, "part"), path)
    return catalog.read_csv(spark, path, catalog.SCHEMAS["part"])


@register("csv_inferred_types", operators="S1", sql="""SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size,
  p_retailprice FROM part""")
def csv_inferred_types(spark, d):
    """``part`` as quoted CSV, read back with a header and the types that Spark infers (32-bit numbers where they fit)."""
    path = scratch_path(spark, "part-inferred")
    catalog.write_csv(catalog.load(spark, d, "part"), path)
    return catalog.read_csv(spark, path, infer_types=True)


@register("csv_rejects", operators="S1 S2 S4", sql=f"""SELECT 'part' AS table_name, count(*) AS row_count,
  count(CASE WHEN p_partkey % {BAD_LINE_MOD} = 0 THEN 1 END) AS rejected FROM part""")
def csv_rejects(spark, d):
    """Lines of a CSV that don't fit the schema are kept aside as text and counted, not dropped unseen."""
    path = scratch_path(spark, "part-rejects")
    part = catalog.load(spark, d, "part")
    bad = F.when(F.col("p_partkey") % BAD_LINE_MOD == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    catalog.write_csv(part.withColumn("p_size", bad), path)
    read = catalog.read_csv(spark, path, catalog.SCHEMAS["part"], rejects="_rejected")
    return catalog.reject_report({"part": read}, "_rejected")

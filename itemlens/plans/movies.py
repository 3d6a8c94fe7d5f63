"""The movie workload on its own CSV exports (movies_metadata, ratings, links, keywords, credits).

The same operators as the registered queries, wired to the export's column names. The driver's test data has no
movie exports, so these plans are exercised by tests on hand-made CSV fixtures rather than registered as queries.
For large exports, read once and keep the cleaned tables as parquet (multi-line CSV cannot be split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemlens.functions import text as TX
from itemlens.operators import clean, joins
from itemlens.sources.catalog import load_movie_sources


class MovieData:
    """Cleaned tables of one export folder. Every attribute is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.raw = load_movie_sources(spark, base_dir)

    @property
    def movies(self) -> DataFrame:
        """Q1: cleaned catalogue (typed numbers, plausibility filters, release year, genre list)."""
        return clean.clean_items(self.raw["movies"])

    @property
    def ratings(self) -> DataFrame:
        """Q3: (user_id, movie_id, rating) typed, incomplete rows dropped."""
        r = clean.clean_ratings(self.raw["ratings"], user_col="user_id", item_col="movie_id")
        return r.withColumnRenamed("item_id", "movie_id")

    @property
    def links(self) -> DataFrame:
        """(movie_id, tmdb_id, imdb_id) typed; unparsable ids become null and drop at the joins."""
        lk = self.raw["links"]
        return lk.select(
            TX.safe_cast("movie_id", "bigint").alias("movie_id"),
            TX.safe_cast("tmdb_id", "bigint").alias("tmdb_id"),
            F.col("imdb_id"),
        )

    @property
    def titles(self) -> DataFrame:
        """(tmdb_id, title) of the cleaned catalogue (the metadata ``id`` is the TMDB id)."""
        return self.movies.select(TX.safe_cast("id", "bigint").alias("tmdb_id"), "title").filter(
            F.col("tmdb_id").isNotNull()
        )

    @property
    def ratings_with_titles(self) -> DataFrame:
        """Q4: ratings re-keyed to the catalogue id space through ``links``, with titles."""
        return joins.map_ids(self.ratings, self.links, self.titles, item_col="movie_id")

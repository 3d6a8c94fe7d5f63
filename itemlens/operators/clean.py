"""Cleaning of raw catalogue and ratings tables (Q1-Q3). Narrow transformations only: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemlens.functions import text as TX

# Plausibility thresholds of the reference's catalogue cleaning (strict '>').
MIN_REVENUE = 1000
MIN_BUDGET = 1000
MIN_VOTES = 10

MIN_POPULAR_VOTES = 50

# Column types of the reference's catalogue cleaning.
NUMERIC_TYPES = {
    "budget": "double",
    "revenue": "double",
    "vote_average": "double",
    "vote_count": "int",
    "popularity": "double",
    "runtime": "double",
}


def clean_items(
    raw: DataFrame,
    *,
    min_revenue: float = MIN_REVENUE,
    min_budget: float = MIN_BUDGET,
    min_votes: int = MIN_VOTES,
) -> DataFrame:
    """Q1: typed, plausible catalogue rows.

    Numbers are parsed with ``try_cast`` (null on dirt), rows missing budget, revenue, vote_average or title are
    dropped, then revenue, budget and vote_count must exceed the thresholds (a null vote_count drops too).
    ``release_year`` uses ``try_to_date`` (bad text gives null instead of an error, D8) and ``genres_list`` is never
    null (D15). Release year, genres and language are carried for the analysis steps (D6).
    """
    typed = raw.select(
        "id",
        "title",
        *[TX.safe_cast(c, t).alias(c) for c, t in NUMERIC_TYPES.items()],
        TX.release_year("release_date").alias("release_year"),
        TX.genres_from_json("genres").alias("genres_list"),
        *[c for c in ("genre_tags", "original_language") if c in raw.columns],
    )
    return typed.filter(
        F.col("budget").isNotNull()
        & F.col("revenue").isNotNull()
        & F.col("vote_average").isNotNull()
        & F.col("title").isNotNull()
        & (F.col("revenue") > min_revenue)
        & (F.col("budget") > min_budget)
        & (F.col("vote_count") > min_votes)
    )


def popular_items(items: DataFrame, min_votes: int = MIN_POPULAR_VOTES) -> DataFrame:
    """catalogue rows with more than ``min_votes`` votes (strict; a null count drops)."""
    return items.filter(F.col("vote_count") > min_votes)


def clean_items_for_regression(raw: DataFrame, *, fill_year: int | None = None) -> DataFrame:
    """Q2: the script variant: numeric ids only (an id of digits beyond 64 bits becomes null and drops with its row), typed numbers, release year, then rows with any null dropped.

    ``fill_year=0`` reproduces the reference script, which turns a missing year into 0 and keeps the row (D9); by
    default the year stays null and the row drops with the other incomplete rows.
    """
    out = (
        raw.filter(TX.is_digits("id"))
        .select(
            TX.safe_cast("id", "bigint").alias("item_id"),
            *[TX.safe_cast(c, "double").alias(c) for c in ("budget", "revenue", "vote_average", "vote_count")],
            TX.release_year("release_date", fill=fill_year).alias("release_year"),
        )
        .select("item_id", "budget", "vote_count", "release_year", "revenue", "vote_average")
    )
    return out.na.drop()


def clean_ratings(raw: DataFrame, *, user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """Q3: typed (user_id, item_id, rating) with unparsable or missing values dropped.

    Ids stay 64-bit here; the ALS step narrows them to int with an overflow check.
    """
    return raw.select(
        TX.safe_cast(user_col, "bigint").alias("user_id"),
        TX.safe_cast(item_col, "bigint").alias("item_id"),
        TX.safe_cast("rating", "double").alias("rating"),
    ).na.drop()

"""Text cleaning expressions (P6, P7, F5, X1-X7, X10). All are built-in Column expressions (whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GENRES_SCHEMA = "array<struct<name:string>>"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: Column | str, to: str) -> Column:
    """Cast that yields null on malformed text instead of failing the query (ANSI mode raises on ``cast``)."""
    return _c(c).try_cast(to)


def is_digits(c: Column | str) -> Column:
    """the value is a non-empty run of ASCII digits (null stays null and is dropped by a filter)."""
    return F.regexp_extract(_c(c), r"^\d+$", 0) != F.lit("")


def release_year(c: Column | str, fmt: str = "yyyy-MM-dd", fill: int | None = None) -> Column:
    """Year of a date string, null when the text does not parse; ``fill`` reproduces the 0-for-missing variant."""
    y = F.year(F.try_to_date(_c(c), fmt)).cast("int")
    return F.coalesce(y, F.lit(fill).cast("int")) if fill is not None else y


def genres_from_json(c: Column | str) -> Column:
    """Names from a JSON array of objects with a ``name``; malformed or missing text gives an empty list.

    ``from_json`` accepts single-quoted JSON and returns null on garbage, so the list is coalesced to ``[]`` (D15).
    """
    parsed = F.from_json(_c(c), GENRES_SCHEMA)
    return F.coalesce(F.transform(parsed, lambda x: x["name"]), F.array().cast("array<string>"))


def genres_from_tags(c: Column | str) -> Column:
    """Delimited genre text to a list.

    ``[a, b]`` (brackets stripped, quotes removed, split on commas), else split on ``|`` when present, else on commas,
    else the whole text; every piece is stripped of white space and empty pieces are dropped. Null text gives ``[]``.
    """
    s = _c(c)
    is_list = s.startswith("[") & s.endswith("]")
    list_body = F.translate(F.regexp_replace(s, r"^[\[\]]+|[\[\]]+$", ""), "'\"", "")
    pieces = (
        F.when(is_list, F.split(list_body, ","))
        .when(s.contains("|"), F.split(s, r"\|"))
        .when(s.contains(","), F.split(s, ","))
        .otherwise(F.array(s))
    )
    cleaned = F.filter(F.transform(pieces, lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != F.lit(""))
    return F.coalesce(cleaned, F.array().cast("array<string>"))

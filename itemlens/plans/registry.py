"""Query registry: name -> (Spark builder over a table folder, DuckDB oracle SQL or None).

Queries are registered by the ``q_*`` modules of this package; ``__spark_entry__.py`` exposes them to the driver.
A query without oracle SQL gets the driver's weaker rows-only check (model training, random sampling).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class QuerySpec:
    name: str
    build: Builder
    sql: str | None
    operators: str
    bench: bool = False


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, *, sql: str | None, operators: str, bench: bool = False):
    """Decorator registering a query builder ``(spark, table_dir) -> DataFrame`` under ``name``."""

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name!r}")
        REGISTRY[name] = QuerySpec(name, fn, sql, operators, bench)
        return fn

    return deco


def all_queries() -> dict[str, QuerySpec]:
    # Import for the registration side effect.
    from itemlens.plans import q_catalog, q_clean, q_eda, q_ml, q_panels, q_recs  # noqa: F401

    return dict(REGISTRY)

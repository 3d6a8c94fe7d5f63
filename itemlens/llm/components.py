"""Connected components of a table of links, as Spark jobs.

Up to ``LOCAL_LINKS`` links, a bounded number, are solved in one task by joining sets. More links are first brought into
stars around the least node of each component by alternating large-star and small-star steps: every node links its
neighbours to the least node it sees. A step is one partial aggregation (a hot node collapses before the shuffle) and one
equi-join, on which Spark splits a hot node's rows; the links never grow in number. Each round is written to the shared
scratch folder, so lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemlens.session import write_scratch_table

#: Links that one task joins in memory (about 100 bytes each).
LOCAL_LINKS = 500_000


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    near = _both(links)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _stars(links: DataFrame) -> DataFrame:
    spark = links.sparkSession
    state, seen = links.select("a", "b").distinct(), None
    while True:
        state = write_scratch_table(spark, _large_star(state), "components")
        state = write_scratch_table(spark, _small_star(state).where("a <> b").distinct(), "components")
        total = state.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.expr("b % 1000003"))).first()
        if tuple(total) == seen:
            return state
        seen = tuple(total)


class Joined:
    """Disjoint sets of numbers; each set is named by its least."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether ``x`` and ``y`` were in different sets."""
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets = Joined()
    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.join(x, y)
    nodes = [x for x in sets.up if sets.find(x) != x]
    roots = [sets.find(x) for x in nodes]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], ["node", "component"])


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b; bigint) that isn't the least of its component.

    ``links`` is read more than once; give a written table.
    """
    links = links.where("a <> b").select("a", "b")
    if links.count() <= LOCAL_LINKS:
        found = links.coalesce(1).mapInArrow(_local, "node bigint, component bigint")
    else:
        found = _stars(links).select(F.col("a").alias("node"), F.col("b").alias("component"))
    return write_scratch_table(links.sparkSession, found, "components")

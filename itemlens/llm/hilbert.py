"""Sharding by Hilbert-curve order, for files that prune by several metadata columns at once.

Every dimension is quantised to ``BITS`` bits: numbers by the logarithm of their size, text columns by a hash of their
value (equal values share a cell). The cell's place on the Hilbert curve through the grid is the sort key, with ties
broken by the text's checksum, size and the key. Runs of equal numbers of rows along the curve become the shards
(law ``rows``): neighbours on the curve are neighbours in every dimension, so a shard covers few values of each, and the
minima and maxima of its files prune.

The curve index is computed level by level (Gray code, entry point and direction of each sub-cell) in one aggregate over
the levels. Ranks come from a range-partitioned sort, written once, and one count per partition, so a cell or source that
holds a third of the rows is cut by the tie-breakers. Texts are reduced to size and checksum before the shuffle.

Null texts have size 1 and the checksum of no bytes; null values of a dimension are a value; null keys come first; repeated
rows take neighbouring slots; an empty table gives no rows; columns that aren't dimensions are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemlens.operators.topk import global_rank

SHARDS = 8
#: Bits of a dimension.
BITS = 5


def level_of(value: Column, bits: int = BITS) -> Column:
    """A number of 0 or more as a cell: twice the logarithm, as far as the grid goes."""
    top = (1 << bits) - 1
    return F.least(F.floor(2 * F.log2(F.greatest(value, F.lit(0)) + F.lit(1))), F.lit(top)).cast("int")


def cell_of(value: Column, bits: int = BITS) -> Column:
    """A text's cell, by hash."""
    return F.pmod(F.xxhash64(value), F.lit(1 << bits)).cast("int")


def _tables(n: int) -> tuple[list[int], list[int]]:
    """Entry corner and direction of each of the 2**n sub-cells in the order of the curve."""

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    def trailing_ones(i: int) -> int:
        return ((i + 1) & -(i + 1)).bit_length() - 1

    entry = [0 if i == 0 else gray(2 * ((i - 1) // 2)) for i in range(1 << n)]
    turn = [0 if i == 0 else trailing_ones(i - 1 if i % 2 == 0 else i) % n for i in range(1 << n)]
    return entry, turn


def hilbert_index(cells: Sequence[Column], bits: int = BITS) -> Column:
    """Place of a cell on the curve, from 0 to 2**(bits * len(cells)) - 1."""
    n = len(cells)
    full = (1 << n) - 1
    entry, turn = (F.array(*map(F.lit, t)) for t in _tables(n))

    def rotated(x: Column, by: Column) -> Column:
        """n-bit ``x`` turned left by ``by`` (0 to n)."""
        up = F.call_function("shiftleft", x, by).bitwiseAND(F.lit(full))
        return up.bitwiseOR(F.call_function("shiftright", x, F.lit(n) - by))

    def step(a: Column, level: Column) -> Column:
        corner = None
        for k, c in enumerate(cells):
            bit = F.shiftleft(F.call_function("shiftright", c, level).bitwiseAND(F.lit(1)), k)
            corner = bit if corner is None else corner.bitwiseOR(bit)
        local = rotated(corner.bitwiseXOR(a["entry"]), F.lit(n) - F.pmod(a["turn"] + 1, F.lit(n)))
        place, shift = local, 1
        while shift < n:  # the inverse of the Gray code
            place = place.bitwiseXOR(F.shiftright(place, shift))
            shift *= 2
        return F.struct(
            a["entry"].bitwiseXOR(rotated(F.get(entry, place), F.pmod(a["turn"] + 1, F.lit(n)))).alias("entry"),
            F.pmod(a["turn"] + F.get(turn, place) + 1, F.lit(n)).alias("turn"),
            F.shiftleft(a["index"], n).bitwiseOR(place.cast("bigint")).alias("index"),
        )

    start = F.struct(F.lit(0).alias("entry"), F.lit(0).alias("turn"), F.lit(0).cast("bigint").alias("index"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0)), start, step, lambda a: a["index"])


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: Sequence[str] = ("source", "lang"), shards: int = SHARDS) -> DataFrame:
    """One row per document: its key as ``doc_id``, ``size``, ``text_crc32``, ``place`` on the curve, ``shard`` and ``slot``.

    Dimensions are the text columns ``by`` and the size. Shard ``s`` of ``n`` rows holds ranks from ``ceil(s * n / shards)``
    on, so row counts differ by one at most.
    """
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        *(cell_of(F.col(c).cast("string")).alias(f"cell_{i}") for i, c in enumerate(by)),
    )
    cells = [*(F.col(f"cell_{i}") for i in range(len(by))), F.col("level")]
    rows = rows.withColumn("level", level_of(F.col("size")))
    rows = rows.select("doc_id", "size", "text_crc32", hilbert_index(cells).alias("place"))
    ranked = global_rank(rows, ["place", "text_crc32", "size", "doc_id"])
    total = ranked.count()
    at = F.expr(f"(rank - 1) * {shards} div {max(total, 1)}")
    out = ranked.withColumn("shard", at.cast("int"))
    first = F.expr(f"(shard * cast({total} as bigint) + {shards - 1}) div {shards}")
    return out.select("doc_id", "size", "text_crc32", "place", "shard", (F.col("rank") - 1 - first).cast("bigint").alias("slot"))


def op4(docs: DataFrame) -> DataFrame:
    """The contract of op4, by the law ``rows``."""
    return shard(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )

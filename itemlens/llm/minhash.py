"""Near-duplicate groups by banded MinHash, odd sketches and exact confirmation.

A text's set is its distinct runs of ``SHINGLE`` lower-cased words (fewer words: the whole sequence). Texts with equal
word sequences are one node. A link joins two nodes whose sets have a Jaccard similarity of at least ``percent`` / 100.

1. One pass computes ``BANDS * ROWS`` MinHash values per text, a key per band, and the odd sketch: every (function, value)
   pair flips one of ``BITS`` bits. In the XOR of two sketches the pairs that both share cancel, so its population
   count estimates how many of the functions disagree, and so the similarity. At similarity 0.75 a pair shares no band
   once in four million times; the estimate's cut-off lies nearly five standard deviations below.
2. Nodes that share a band key meet in a bucket. Instead of all pairs, each round links a bucket's nodes to one centre
   of another component, takes every node's best centre by the sketches, and confirms it on the full sets. Nodes of
   one component need no further link, so a group of thousands of copies costs a pair per node.
3. What is left in ``ROUNDS`` rounds is settled completely: in buckets that still hold several components, all nodes
   outside the bucket's main component are compared by sketch with the nodes of other components. Nodes that the sketches
   can't tell apart form families, and in a family every node outside its main component is compared with all others by
   counting shared shingles in an index of the full sets. So no link between components is skipped. Larger buckets and
   families are cut into blocks, each pair of blocks a task, but for pairs of blocks of the main component.

Null and empty texts have no words, an empty set and no link. Null keys are keys; repeated rows are equal texts; an empty
table gives no rows; other columns aren't read by ``near_duplicates`` and stay in ``deduplicate``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemlens.llm import words as W
from itemlens.llm.components import Joined, components
from itemlens.session import write_scratch_table

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 40, 4
#: Bits of an odd sketch.
BITS = 512
#: Rounds of links to one centre per bucket before the rest is compared completely.
ROUNDS = 1
#: Nodes of a bucket, and bytes of a family's sets, that one block of a task holds at most, and from which on a group
#: is cut: the number of blocks is the square root of the load in these units, until blocks reach the most.
BLOCK_NODES, CUT_NODES = 4096, 256
BLOCK_SET_BYTES, CUT_SET_BYTES = 16 << 20, 8 << 10
#: A pair whose estimated similarity is this far below the limit is ruled out.
MARGIN = 0.2
#: Bytes of text hashed at once (or one longer text).
GROUP_BYTES = 1 << 20


def shingles(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every row's shingles, sorted in the row without repeats, and the rows' bounds."""
    count = np.diff(first)
    n = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(int(bounds[-1]), dtype=np.uint64)
    long = np.flatnonzero(count >= size)
    if len(long):
        grams = W.window_hashes(words, size, seed=41)
        out[W.ragged(bounds[long], n[long])] = grams[W.ragged(first[long], n[long])]
    short = np.flatnonzero((count > 0) & (count < size))
    out[bounds[short]] = W.run_hash(words, first[short], first[short + 1], seed=41)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        out[a:b].sort()
    new = np.ones(len(out), dtype=bool)
    new[1:] = out[1:] != out[:-1]
    new[bounds[:-1][n > 0]] = True
    return out[new], np.concatenate([[0], np.cumsum(new)])[bounds]


def minhash(values: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
    """``k`` MinHash values of every non-empty row, one line per row; they are of 32 bits, as the least of a row's are."""
    salt = W.mix(np.arange(1, k + 1, dtype=np.uint64) * W.U64(0x9E3779B97F4A7C15))
    factor = (W.mix(salt + W.U64(5)) | W.U64(1)).astype(np.uint32)
    salt, values = salt.astype(np.uint32), values.astype(np.uint32)
    rows = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, k), dtype=np.uint64)
    for i, j in W.slices(bounds[np.append(rows, len(bounds) - 1)], 1 << 15) if len(rows) else ():
        lo, hi = int(bounds[rows[i]]), int(bounds[rows[j - 1] + 1])
        part, at = values[lo:hi], bounds[rows[i:j]] - lo
        for f in range(k):
            out[rows[i:j], f] = np.minimum.reduceat((part ^ salt[f]) * factor[f], at)
    return out


def odd_sketch(samples: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps of the (function, value) pairs of every line, as signed 64-bit words."""
    n, k = samples.shape
    spot = W.mix(samples + np.arange(1, k + 1, dtype=np.uint64) * W.U64(0xD1342543DE82EF95)) % W.U64(bits)
    flat = spot.astype(np.int64) + np.arange(n)[:, None] * bits
    parity = (np.bincount(flat.reshape(-1), minlength=n * bits) & 1).astype(np.uint8).reshape(n, bits)
    return np.packbits(parity, axis=1, bitorder="little").view("<i8")


def most_bits(similarity: float, k: int, bits: int) -> int:
    """The population count that stands for ``similarity``."""
    return math.ceil(bits / 2 * (1 - math.exp(-4 * k * (1 - similarity) / bits)))


def _texts(column: pa.Array, shingle: int):
    raw, offsets = W.utf8(column)
    for i, j in W.slices(offsets, GROUP_BYTES):
        part, at = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = W.spans(part, at, W.SPACE_WORDS)
        words = W.word_hashes(part, starts, ends, fold=True)
        low = W.run_hash(words, first[:-1], first[1:], seed=42)
        high = W.run_hash(words, first[:-1], first[1:], seed=43)
        yield i, j, low.view(np.int64), high.view(np.int64), *shingles(words, first, shingle)


def _signatures(shingle: int, bands: int, rows: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, low, high, values, bounds in _texts(batch.column(1), shingle):
                samples = minhash(values, bounds, bands * rows)
                n = len(low)
                keys = np.empty((n, bands), dtype=np.int64)
                for b in range(bands):
                    band = np.ascontiguousarray(samples[:, b * rows : (b + 1) * rows]).reshape(-1)
                    keys[:, b] = W.run_hash(band, np.arange(n) * rows, np.arange(1, n + 1) * rows, seed=100 + b).view(np.int64)
                sketch = odd_sketch(samples, bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        batch.column(2).slice(i, j - i),
                        pa.array(low),
                        pa.array(high),
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(keys.reshape(-1))),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(n + 1) * sketch.shape[1], pa.int32()), pa.array(sketch.reshape(-1))
                        ),
                    ],
                    ["doc_id", "text_hash", "low", "high", "n_shingles", "bands", "sketch"],
                )

    return run


def _sets(shingle: int):
    """Full sets of the texts whose word hashes are the ones asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, asked_low, asked_high = (batch.column(k) for k in (0, 2, 3))
            for i, j, low, high, values, bounds in _texts(batch.column(1), shingle):
                same = (asked_low.slice(i, j - i).to_numpy() == low) & (asked_high.slice(i, j - i).to_numpy() == high)
                yield pa.RecordBatch.from_arrays(
                    [node.slice(i, j - i), W.binary_column(values, bounds)], ["node", "shingles"]
                ).filter(pa.array(same))

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            last, ours = None, None
            for r, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                a = batch.column(0)[r].as_py()
                if a != last:  # pairs come sorted by the first node
                    last, ours = a, np.frombuffer(x.as_buffer(), "<u8")
                theirs = np.frombuffer(y.as_buffer(), "<u8")
                at = np.minimum(np.searchsorted(ours, theirs), len(ours) - 1)
                both = int((ours[at] == theirs).sum())
                keep[r] = 100 * both >= percent * (len(ours) + len(theirs) - both)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return run


class _Search:
    def __init__(self, docs: DataFrame, signatures: DataFrame, percent: int, shingle: int, bands: int, rows: int, bits: int):
        self.spark, self.docs, self.signatures = docs.sparkSession, docs, signatures
        self.percent, self.shingle, self.k, self.bits = percent, shingle, bands * rows, bits

    def apart(self) -> Column:
        """Bits in which the sketches of a pair differ."""
        words = range(self.bits // 64)
        return sum(
            (F.bit_count(F.get("x.sketch", F.lit(i)).bitwiseXOR(F.get("y.sketch", F.lit(i)))) for i in words), F.lit(0)
        )

    def close_enough(self) -> Column:
        """A pair whose sizes and sketches allow the similarity; sizes rule out exactly, sketches by the margin."""
        sizes = (F.least("x.n", "y.n") * 100) >= (F.greatest("x.n", "y.n") * self.percent)
        return sizes & (self.apart() <= most_bits(self.percent / 100 - MARGIN, self.k, self.bits))

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets are similar enough."""
        x = self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("sx"))
        y = self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("sy"))
        full = pairs.join(y, "b").join(x, "a").select("a", "b", "sx", "sy")
        return full.mapInArrow(_confirm(self.percent), "a bigint, b bigint")

    def run(self) -> DataFrame:
        """(node, component) of the nodes that have a link and aren't the least of their component."""
        classes = self.signatures.where("n_shingles > 0").groupBy("low", "high").agg(F.min("row").alias("row"))
        nodes = self.signatures.join(classes.select("row"), "row", "left_semi").select(
            F.col("row").alias("node"), "doc_id", "text_hash", "low", "high", F.col("n_shingles").alias("n"), "bands", "sketch"
        )
        keyed = nodes.select("node", F.explode("bands").alias("key"))
        shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")
        members = write_scratch_table(self.spark, keyed.join(shared, "key"), "buckets")
        met = members.select("node").distinct()
        self.nodes = write_scratch_table(self.spark, nodes.drop("bands").join(met, "node", "left_semi"), "nodes")
        # Rows are found again by key and text, so those that share a key (null or repeated) don't meet each other.
        asked = self.nodes.select("node", "low", "high", F.xxhash64("doc_id", "text_hash").alias("own"))
        texts = self.docs.select("text", F.xxhash64("doc_id", F.xxhash64("text")).alias("own"))
        sets = (
            texts.join(asked, "own")
            .select("node", "text", "low", "high")
            .mapInArrow(_sets(self.shingle), "node bigint, shingles binary")
            .dropDuplicates(["node"])  # repeated rows of one key and text
        )
        self.sets = write_scratch_table(self.spark, sets, "sets")

        links, found = [], None
        for number in range(ROUNDS + 1):
            state = members
            if found is not None:
                state = members.join(found, "node", "left")
                state = state.select("key", "node", F.coalesce("component", "node").alias("component"))
            else:
                state = members.select("key", "node", F.col("node").alias("component"))
            made = self.confirm(self.centres(state, number)) if number < ROUNDS else self.rest(state)
            new = write_scratch_table(self.spark, made, "links")
            if new.isEmpty():
                continue
            links.append(new)
            graph = new if found is None else new.unionByName(found.toDF("a", "b"))
            found = components(graph)
        if found is None:
            found = self.spark.createDataFrame([], "node bigint, component bigint")
        return found

    def sketches(self, side: str) -> DataFrame:
        return self.nodes.select("node", F.struct("n", "sketch").alias(side))

    def centres(self, state: DataFrame, number: int) -> DataFrame:
        """Every node's most similar centre among those of its buckets that lie in another component."""
        order = F.xxhash64(F.lit(number), "node")
        centre = state.groupBy("key").agg(F.min(F.struct(order.alias("o"), F.col("node").alias("c"), F.col("component").alias("cc"))).alias("m"))
        pairs = (
            state.join(centre.select("key", "m.c", "m.cc"), "key").where("component <> cc").select("node", "c").distinct()
        )
        y = self.sketches("y").withColumnRenamed("node", "c")
        pairs = pairs.join(self.sketches("x"), "node").join(y, "c").where(self.close_enough())
        best = pairs.groupBy("node").agg(F.min(F.struct(self.apart().alias("d"), "c")).alias("m"))
        return best.select(F.col("m.c").alias("a"), F.col("node").alias("b"))

    def rest(self, state: DataFrame) -> DataFrame:
        """All links between different components among nodes that share a bucket, but for those that others imply."""
        similar = components(write_scratch_table(self.spark, self.similar(state), "similar"))
        pieces = state.select("node", "component").distinct()
        family = similar.unionByName(similar.select(F.col("component").alias("node"), "component").distinct())
        family = family.select("node", F.col("component").alias("family"))
        rows = family.join(pieces, "node").join(self.sets, "node")
        rows = write_scratch_table(self.spark, rows.withColumn("load", F.octet_length("shingles")), "families")
        dealt = _in_blocks(rows, "family", BLOCK_SET_BYTES, CUT_SET_BYTES)
        return dealt.select("task", "side", "node", "component", "main", "shingles").mapInArrow(
            _grouped(_links(self.percent)), "a bigint, b bigint"
        )

    def similar(self, state: DataFrame) -> DataFrame:
        """Links (a, b) that join all nodes of a bucket whose sketches don't rule out a link between components."""
        rows = state.join(self.nodes.select("node", "n", "sketch"), "node").withColumn("load", F.lit(1))
        dealt = _in_blocks(rows, "key", BLOCK_NODES, CUT_NODES)
        limit = most_bits(self.percent / 100 - MARGIN, self.k, self.bits)
        return dealt.select("task", "side", "node", "component", "main", "n", "sketch").mapInArrow(
            _grouped(_similar(self.percent, limit)), "a bigint, b bigint"
        )


def _in_blocks(rows: DataFrame, group: str, most: int, unit: int) -> DataFrame:
    """Rows of groups with several components, dealt to sorted tasks that each hold two blocks of a group.

    ``main`` is the group's component with the most nodes. A group of more than ``unit`` (the sum of ``load``) is cut by the
    hash of the node into blocks of its main component and blocks of the others. A task holds two blocks of others, or one
    of others and one of the main component, so any two nodes meet in one unless both belong to the main component, where
    no link is sought. Blocks number as the square root of the units, and hold ``most`` at most.
    """

    def blocks(load: Column) -> Column:
        return F.greatest(F.ceil(F.sqrt(load / F.lit(unit))), F.ceil(load / F.lit(most))).cast("int")

    parts = rows.groupBy(group, "component").agg(F.count(F.lit(1)).alias("size"), F.sum("load").alias("load"))
    whole = parts.groupBy(group).agg(
        F.max(F.struct("size", "component", "load")).alias("m"), F.count(F.lit(1)).alias("n"), F.sum("load").alias("load")
    )
    one = blocks(F.col("load")) <= 1
    whole = whole.where("n > 1").select(
        group,
        F.col("m.component").alias("main"),
        F.when(one, 1).otherwise(blocks(F.col("load") - F.col("m.load"))).alias("outside"),
        F.when(one, 0).otherwise(blocks(F.col("m.load"))).alias("inside"),
    )
    cut = rows.join(whole, group)
    inner = (F.col("component") == F.col("main")) & (F.col("inside") > 0)
    block = F.when(inner, F.col("outside") + F.pmod(F.xxhash64("node"), F.greatest("inside", F.lit(1))))
    cut = cut.withColumn("block", block.otherwise(F.pmod(F.xxhash64("node"), "outside")).cast("int"))
    facing = F.when(inner, F.col("outside")).otherwise(F.col("outside") + F.col("inside"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), facing - 1)))
    i, j = F.least("block", "other"), F.greatest("block", "other")
    task = F.xxhash64(F.col(group), i, j)
    side = F.when(F.col("block") == i, 0).otherwise(1)
    return cut.withColumn("task", task).withColumn("side", side).repartition("task").sortWithinPartitions("task")


def _grouped(work):
    """Streams sorted rows and hands each task's rows to ``work``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            pairs = work(pa.Table.from_batches(held)) if held else []
            if pairs:
                a, b = zip(*pairs)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            task = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(task)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:]):
                if held and (hi > lo) and held[-1].column(0)[0].as_py() != int(task[lo]):
                    yield from flush()
                    held = []
                if hi > lo:
                    held.append(batch.slice(lo, hi - lo))
        yield from flush()

    return run


def _columns(t: pa.Table) -> tuple[np.ndarray, ...]:
    return tuple(t.column(c).to_numpy() for c in ("side", "node", "component")) + (int(t.column("main")[0].as_py()),)


def _facing(side: np.ndarray, minor: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each row outside the main component, with the rows it is compared with: those of the other block, or of its own
    where the task has one block. Rows of two blocks that are both outside meet twice, which does no harm."""
    one = not side.any()
    facing = {0: np.flatnonzero(side == (0 if one else 1)), 1: np.flatnonzero(side == 0)}
    for x in np.flatnonzero(minor).tolist():
        yield x, facing[int(side[x])]


def _similar(percent: int, limit: int):
    def work(t: pa.Table) -> list[tuple[int, int]]:
        side, node, component, main = _columns(t)
        n = t.column("n").to_numpy()
        words = t.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
        union, out = Joined(), []
        for x, rows in _facing(side, component != main):
            fits = (component[rows] != component[x]) & (
                np.minimum(n[rows], n[x]) * 100 >= np.maximum(n[rows], n[x]) * percent
            )
            rows = rows[fits]
            apart = np.bitwise_count(words[rows] ^ words[x]).sum(axis=1)
            for y in rows[apart <= limit].tolist():
                if union.join(x, y):
                    out.append((int(node[x]), int(node[y])))
        return out

    return work


def _links(percent: int):
    def work(t: pa.Table) -> list[tuple[int, int]]:
        side, node, component, main = _columns(t)
        sets = [np.frombuffer(x.as_buffer(), "<u8") for x in t.column("shingles").combine_chunks()]
        size = np.array([len(x) for x in sets])
        index = {}
        for s in (0, 1):  # per block all shingles in order, with their rows
            rows = np.flatnonzero(side == s)
            if len(rows):
                flat, owner = np.concatenate([sets[r] for r in rows]), np.repeat(rows, size[rows])
                order = np.argsort(flat, kind="stable")
                index[s] = flat[order], owner[order]
        one, union, out = len(index) == 1, Joined(), []
        for x, rows in _facing(side, component != main):
            flat, owner = index[int(side[x]) if one else 1 - int(side[x])]
            lo = np.searchsorted(flat, sets[x])
            hi = np.searchsorted(flat, sets[x], side="right")
            both = np.bincount(owner[W.ragged(lo, hi - lo)], minlength=len(node))[rows]
            near = rows[(100 * both >= percent * (size[rows] + size[x] - both)) & (component[rows] != component[x])]
            for y in near.tolist():
                if union.join(int(component[x]), int(component[y])):
                    out.append((int(node[x]), int(node[y])))
        return out

    return work


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    bits: int = BITS,
) -> DataFrame:
    """One row per document: its key as ``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` (the least key of its
    group) and ``class_id`` (equal for equal word sequences)."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, text_hash bigint, low bigint, high bigint, n_shingles bigint, bands array<bigint>, sketch array<bigint>"
    made = own.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_signatures(shingle, bands, rows, bits), fields)
    signatures = write_scratch_table(spark, made.withColumn("row", F.monotonically_increasing_id()), "signatures")
    found = _Search(own, signatures, percent, shingle, bands, rows, bits).run()

    light = signatures.select("row", "doc_id", "text_hash", "low", "high", "n_shingles")
    classes = light.groupBy("low", "high").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"))
    classes = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = write_scratch_table(spark, classes, "classes")
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "component").select("low", "high", "node", "component_id")
    empty = F.col("n_shingles") == 0
    return light.join(named, ["low", "high"]).select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, F.col("row")).otherwise(F.col("node")).alias("class_id"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are the least of their group, with all their columns; of repeated equal rows one stays."""
    groups = near_duplicates(docs, id_col, text_col, **options)
    gone = groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_text")).distinct()
    names = [f"c{i}" for i in range(len(docs.columns))]
    key, text = (F.col(names[docs.columns.index(c)]) for c in (id_col, text_col))
    same = key.eqNullSafe(F.col("gone_id")) & (F.xxhash64(text.cast("string")) == F.col("gone_text"))
    return docs.toDF(*names).join(gone, same, "left_anti").dropDuplicates().toDF(*docs.columns)


def op9(docs: DataFrame) -> DataFrame:
    """The contract of op9."""
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))

"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the item windows: every run of ``window`` words of an item, or all words of a shorter item. Patterns of one
length form a ``Matcher``:

- the shift table maps the hash of every block of two adjacent pattern words to how far its last place lies from the
  pattern's end; a block that isn't in the table can't be part of any occurrence;
- an occurrence of m words holds m-1 blocks, so exactly one of the text's blocks number 0, m-1, 2(m-1), ... lies in it.
  Only those are looked up, and where the table doesn't know one, the m-1 positions around it are skipped;
- for the positions left, the suffix table selects the patterns that end in the block found there by the hash of the
  whole window, and a comparison of the words themselves confirms the occurrence.

The tables hold the benchmark, not the documents. They are sent to the executors in blocks of items of at most
``BLOCK_BYTES`` bytes of text (one longer item is a block alone); documents stream through one block after the other
without a shuffle. Between two blocks the documents are written to the shared scratch folder and the block's tables are
destroyed, so a benchmark of any size needs the memory of one block.

Null or empty texts have no words and no hits; items without words are no patterns; an item without an id has windows, which
hit, and no id to list; repeated items and documents count as
they are (an item id counts once per document); an empty benchmark leaves every document clean; other columns aren't read
by ``find_passages`` and pass unchanged through ``decontaminate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemlens.llm import words as W
from itemlens.session import write_scratch_table

#: Words of a window.
WINDOW = 10
#: Bytes of item text whose tables are held at once.
BLOCK_BYTES = 16 << 20
#: Bytes of documents searched at once (or one longer document).
GROUP_BYTES = 4 << 20


def _text(raw: np.ndarray, start: int, end: int) -> bytes:
    return W.LOWER[raw[start:end]].tobytes()


class Matcher:
    """All patterns of ``m`` words: bytes of their folded words joined by spaces, with the items that hold them."""

    def __init__(self, m: int, patterns: dict[bytes, list[str]]):
        self.m, self.block = m, min(2, m)
        self.texts = list(patterns)
        self.items = [sorted(set(x) - {None}) for x in patterns.values()]
        words = np.concatenate([_hashes(t) for t in self.texts]).reshape(-1, m)
        places = m - self.block + 1
        blocks = [self._blocks(words[:, i : i + self.block]) for i in range(places)]
        # Blocks in ascending order with the least distance of any of their places to a pattern's end.
        hashes, shift = np.concatenate(blocks), np.repeat(np.arange(places)[::-1], len(words))
        order = np.lexsort((shift, hashes))
        self.known, first = np.unique(hashes[order], return_index=True)
        self.shift = shift[order][first]
        # Suffix buckets: by the block that ends a pattern and the hash of the whole pattern.
        whole = W.run_hash(words.reshape(-1), np.arange(len(words)) * m, np.arange(1, len(words) + 1) * m, 3)
        self.order = np.argsort(whole, kind="stable")
        self.whole = whole[self.order]

    def _blocks(self, pairs: np.ndarray) -> np.ndarray:
        out = pairs[..., 0]
        for k in range(1, self.block):
            out = W.mix(out * W.U64(0x9E3779B97F4A7C15) + pairs[..., k])
        return out

    def _distance(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The shift table's entry for the blocks that start at ``at``; the pattern's length for unknown blocks."""
        blocks = self._blocks(np.stack([words[at + k] for k in range(self.block)], axis=-1))
        where = np.minimum(np.searchsorted(self.known, blocks), len(self.known) - 1)
        return np.where(self.known[where] == blocks, self.shift[where], self.m)

    def find(self, words: np.ndarray, row: np.ndarray, text) -> Iterator[tuple[int, int]]:
        """(first word, pattern) of every occurrence; ``text(i, j)`` gives words i to j as the patterns have them."""
        m, places = self.m, self.m - self.block + 1
        n = len(words) - m + 1
        if n <= 0:
            return
        probes = np.arange(0, len(words) - self.block + 1, places)
        probes = probes[self._distance(words, probes) < m]
        starts = (probes[:, None] + np.arange(1 - places, 1)).reshape(-1)
        starts = starts[(starts >= 0) & (starts < n)]
        starts = starts[row[starts] == row[starts + m - 1]]
        starts = starts[self._distance(words, starts + places - 1) == 0]
        if not len(starts):
            return
        size = starts[:, None] + np.arange(m)
        whole = W.run_hash(words[size].reshape(-1), np.arange(len(starts)) * m, np.arange(1, len(starts) + 1) * m, 3)
        lo, hi = np.searchsorted(self.whole, whole), np.searchsorted(self.whole, whole, side="right")
        for i in np.flatnonzero(hi > lo).tolist():
            got = text(int(starts[i]), int(starts[i]) + m)
            for k in self.order[lo[i] : hi[i]].tolist():
                if self.texts[k] == got:
                    yield int(starts[i]), k


def _hashes(text: bytes) -> np.ndarray:
    raw = np.frombuffer(text, dtype=np.uint8)
    starts, ends, _ = W.spans(raw, np.array([0, len(raw)]), W.ALNUM_WORDS)
    return W.word_hashes(raw, starts, ends, fold=True)


def matchers(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> list[Matcher]:
    """One matcher per pattern length over the windows of ``items`` (id, text)."""
    found: dict[int, dict[bytes, list[str | None]]] = {}
    for item, text in items:
        raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
        starts, ends, _ = W.spans(raw, np.array([0, len(raw)]), W.ALNUM_WORDS)
        parts = [_text(raw, s, e) for s, e in zip(starts.tolist(), ends.tolist())]
        m = min(window, len(parts))
        for i in range(len(parts) - m + 1 if m else 0):
            found.setdefault(m, {}).setdefault(b" ".join(parts[i : i + m]), []).append(item)
    return [Matcher(m, patterns) for m, patterns in sorted(found.items())]


def _search(tables: list[Matcher], raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list, list]:
    """Per row: number of words, spans (first word, last word + 1) of occurrences, ids of the items found."""
    starts, ends, first = W.spans(raw, offsets, W.ALNUM_WORDS)
    count = np.diff(first)
    hits: list[list[tuple[int, int]]] = [[] for _ in count]
    items: list[set] = [set() for _ in count]
    if tables and len(starts):
        words = W.word_hashes(raw, starts, ends, fold=True)
        row = np.repeat(np.arange(len(count)), count)

        def text(i: int, j: int) -> bytes:
            return b" ".join(_text(raw, s, e) for s, e in zip(starts[i:j].tolist(), ends[i:j].tolist()))

        for table in tables:
            for at, pattern in table.find(words, row, text):
                r = int(row[at])
                hits[r].append((at - int(first[r]), at - int(first[r]) + table.m))
                items[r].update(table.items[pattern])
    return count, hits, items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


_SPAN = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _find(tables):
    """Adds the occurrences of one block of items to those that a row carries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = W.utf8(batch.column(1))
            for i, j in W.slices(offsets, GROUP_BYTES):
                part = batch.slice(i, j - i)
                count, hits, items = _search(tables.value, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                for r, (old, ids) in enumerate(zip(part.column(3).to_pylist(), part.column(4).to_pylist())):
                    hits[r] = _merged([*hits[r], *((x["first"], x["last"]) for x in old)])
                    items[r] = sorted(items[r].union(ids))
                spans = [[{"first": s, "last": e} for s, e in x] for x in hits]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(count, pa.int64()), pa.array(spans, _SPAN), pa.array(items, pa.list_(pa.string()))],
                    ["doc_id", "text", "n_words", "hits", "items"],
                )

    return run


def _clean(tables):
    """Keeps the rows without any occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = W.utf8(batch.column(batch.num_columns - 1))
            for i, j in W.slices(offsets, GROUP_BYTES):
                _, hits, _ = _search(tables.value, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield batch.slice(i, j - i).filter(pa.array([not x for x in hits], pa.bool_()))

    return run


def _blocks(bench: DataFrame, item_col: str, item_text_col: str, window: int, block_bytes: int) -> Iterator:
    """(broadcast tables, whether they are the last) of the items, block by block; each block's size is checked before it is
    fetched."""
    items = bench.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    items = items.where("text is not null")
    total = items.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("id"), F.lit(0)))).first()[0] or 0
    n, spark = -(-2 * total // block_bytes) if total > block_bytes else 1, bench.sparkSession
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) if n > 1 else items
        tables = matchers([(r[0], r[1]) for r in part.toLocalIterator()], window)
        yield spark.sparkContext.broadcast(tables), k == n - 1


def find_passages(
    docs: DataFrame,
    bench: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: its key as ``doc_id``, ``n_words``, ``hits`` (disjoint runs of hit words, ``last``
    exclusive) and ``items`` (sorted ids of the items that occur in it)."""
    state = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr("cast(array() as array<struct<first:bigint,last:bigint>>)").alias("hits"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    for tables, last in _blocks(bench, item_col, item_text_col, window, block_bytes):
        state = state.mapInArrow(_find(tables), state.schema)
        if not last:
            state = write_scratch_table(docs.sparkSession, state, "passages")
            tables.destroy()
    return state.drop("text")


def decontaminate(
    docs: DataFrame,
    bench: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents in which no item window occurs, with all their columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]  # any names, clashing ones too, pass
    text = F.col(names[docs.columns.index(text_col)]).cast("string").alias("searched")
    kept, columns = docs.toDF(*names), docs.columns
    for tables, last in _blocks(bench, item_col, item_text_col, window, block_bytes):
        state = kept.select(*names, text)
        kept = state.mapInArrow(_clean(tables), state.schema).drop("searched")
        if not last:
            kept = write_scratch_table(docs.sparkSession, kept, "clean")
            tables.destroy()
    return kept.toDF(*columns)


def op5(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The contract of op5."""
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda a, x: a + x["last"] - x["first"])
    return find_passages(docs, bench).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )

"""Substring dedup by relative Lempel-Ziv parsing: documents are factored against an index of the whole corpus.

A factor is a run of at least ``window`` words that also stands somewhere else, its reference: a row and a position in the
same or another document. Parsing goes from left to right: where the ``window`` words at a position are in the index, a
factor begins at the reference that the index names, and grows word by word while the next ``window`` words have the
reference's next position; elsewhere one word is a literal. Where a reference ends, another may continue a longer repeat, so
the ``window`` words that cross a factor's end are looked up as well and begin factors of their own, and factors that touch
become one span. All words of the spans are duplicates.

The index names one reference per ``window`` words, not all: the first occurrence in the block, or else the first of the
other blocks, and for a first occurrence the next one. A factor is the longest run along these, not the longest of all
possible matches; the spans are the same.

The reference is the corpus, cut into blocks: a scan batch is a block with an index of its own, and the blocks' entries
meet in a partitioned index. What repeats in a block is known there, so a block sends every distinct entry once, however
often it occurs, and no key is hot. Two levels keep the index small:

1. Seeds. ``window`` words contain ``window - SEED + 1`` runs of ``SEED`` words; the one with the least hash is their
   seed. Equal windows have equal seeds, and seeds are one in about nine positions. A shuffle by seed shows which occur
   twice; the other windows can't repeat.
2. Windows. Documents are joined with their repeated seeds; the windows with such a seed send 96-bit hashes, and a second
   shuffle shows which occur twice.

A third join brings the repeated positions and their references back to the documents. Partitions are read as sorted streams:
equal keys are neighbours, and no group is held. Texts are shuffled once, by a hash of key and text; the table of documents between
the levels is kept bucketed by it, so this join moves positions to texts. The table holds positions, not hashes, which are
computed again for the lookup.

Null texts have no words; a null key is a key; repeated rows repeat each other; texts of fewer than ``window`` words keep
all of them; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemlens.llm import words as W
from itemlens.session import write_bucketed_scratch_table

#: Words of a window and of a seed.
WINDOW = 35
SEED = 20
#: Bytes of text in one reference block (or one longer document). A worker's arrays take about 25 times as much and stay with it.
BLOCK_BYTES = 2 << 20


def _least(x: np.ndarray, size: int, least=np.minimum) -> np.ndarray:
    """Smallest of ``x[i:i + size]`` for every i."""
    out, have = x, 1
    while have < size:
        step = min(have, size - have)
        out = least(out[:-step], out[step:])
        have += step
    return out


class _Text:
    """Words of a group of rows and the hashes that both levels need."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, window: int, seed: int):
        self.starts, self.ends, self.first = W.spans(raw, offsets, W.SPACE_WORDS)
        self.count = np.diff(self.first)
        self.words = W.word_hashes(raw, self.starts, self.ends)
        row = np.repeat(np.arange(len(self.count)), self.count)
        n = max(0, len(row) - window + 1)
        #: First words of all windows, and their rows.
        self.at = np.flatnonzero(row[:n] == row[window - 1 :][:n]) if n else np.zeros(0, np.int64)
        self.row = row[self.at] if n else np.zeros(0, np.int64)
        grams = W.window_hashes(self.words, seed, seed=21)
        #: Per window its seed, and which words start one.
        self.seeds = _least(grams, window - seed + 1)[self.at] if n else np.zeros(0, np.uint64)
        self.chosen, self.chosen_row = self.seeds[:0], self.row[:0]
        if len(self.at):
            # A run of seeds is chosen where some window has its hash as the least: a maximum over the windows around.
            width = window - seed + 1
            over = np.zeros(len(grams) + 2 * width, dtype=np.uint64)
            over[width + self.at] = self.seeds
            top = _least(over, width, np.maximum)[1 : len(grams) + 1]
            picked = np.flatnonzero(grams == top)
            picked = picked[(picked + seed <= len(row)) & (row[np.minimum(picked + seed - 1, len(row) - 1)] == row[picked])]
            self.chosen, self.chosen_row = grams[picked], row[picked]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more, and which are the first of their kind."""
    _, first, inverse, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    lead = np.zeros(len(keys), dtype=bool)
    lead[first] = True
    return (count > 1)[inverse], lead


def _references(keys: np.ndarray) -> np.ndarray:
    """Per key the index of another one of its kind: the first, or for the first the second; itself if it is alone."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    head = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    other = order[head]
    followed = np.flatnonzero(new[:-1] & ~new[1:])
    other[followed] = order[followed + 1]
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = other
    return out


def _runs(row: np.ndarray, at: np.ndarray, ref: np.ndarray, ref_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in order with their references, as runs (first, length, reference row from here, first there), and their rows."""
    same = (np.diff(row) == 0) & (np.diff(at) == 1) & (np.diff(ref) == 0) & (np.diff(ref_at) == 1)
    first = np.flatnonzero(np.concatenate([[True], ~same])) if len(at) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(at)))
    return np.stack([at[first], size, ref[first], ref_at[first]], axis=1).astype("<i4"), row[first]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _seed_rows(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = W.utf8(batch.column(1))
            for i, j in W.slices(offsets, BLOCK_BYTES):
                t = _Text(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], window, seed)
                again, lead = _repeated(t.chosen)
                # A seed that repeats here is known; one row tells the others, and each document hears of it once.
                pair = W.mix(t.chosen + t.chosen_row.astype(np.uint64))
                _, once = np.unique(pair, return_index=True)
                keep = np.union1d(once, np.flatnonzero(lead))
                shuffled = np.where(lead, t.chosen, W.mix(pair + W.U64(i)))[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(shuffled),
                        _signed(t.chosen[keep]),
                        batch.column(0).slice(i, j - i).take(pa.array(t.chosen_row[keep])),
                        pa.array(again[keep]),
                        pa.array(lead[keep]),
                    ],
                    ["dealt", "seed", "own", "again", "lead"],
                )

    return run


def _neighbours(keys: list[str], out: list[str]):
    """Rows of a sorted stream that are known repeats or have the same keys as a neighbour; only leading rows count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def marked(t: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table | None]:
            k = [t.column(c).to_numpy() for c in keys]
            lead, again = t.column("lead").to_numpy(), t.column("again").to_numpy().copy()
            same = np.logical_and.reduce([x[1:] == x[:-1] for x in k]) & lead[1:] & lead[:-1]
            again[1:] |= same
            again[:-1] |= same
            n = t.num_rows if last else t.num_rows - 1
            k = t.schema.get_field_index("again")
            rest = None if last else t.slice(n).set_column(k, t.schema.field(k), pa.array(again[n:]))
            return t.slice(0, n).filter(pa.array(again[:n])).select(out), rest

        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not t.num_rows:
                continue
            done, held = marked(t if held is None else pa.concat_tables([held, t]), False)
            yield from done.combine_chunks().to_batches()
        if held is not None:
            yield from marked(held, True)[0].combine_chunks().to_batches()

    return run


def _referred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that another block has too, from a stream sorted by their hashes: each with the first of its kind, and the first
    with the next. Windows that repeat in their own block have a reference already."""
    head, alone = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        carried = head is not None
        if carried:
            cols = [np.concatenate([h, c]) for h, c in zip(head, cols)]
        low, high, row, at, again = cols
        n = len(low)
        new = np.ones(n, dtype=bool)
        new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        other = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        last = int(other[-1])
        followed = np.flatnonzero(new[:-1] & ~new[1:])
        other[followed] = followed + 1
        told = (other != np.arange(n)) & ~again
        if carried and not alone:
            told[0] = False  # it has its reference from an earlier batch
        alone = last == n - 1 and (alone or not (carried and last == 0))
        head = [c[last : last + 1] for c in cols]
        told = np.flatnonzero(told)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (row[told], at[told], row[other[told]], at[other[told]])], ["row", "at", "ref", "ref_at"]
        )


def _window_rows(window: int, seed: int):
    """Documents with the windows that may repeat: those that repeat in the block, and hashes of the ones to look up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = W.utf8(batch.column(1))
            for i, j in W.slices(offsets, BLOCK_BYTES):
                yield block(batch.slice(i, j - i), raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])

    def block(batch: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        t = _Text(raw, offsets, window, seed)
        seeds = batch.column(2)
        known = seeds.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        owner = seeds.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        # A window may repeat if its document has its seed among the repeated ones.
        has = np.unique(W.mix(known + W.U64(31) * np.repeat(np.arange(len(owner)), owner).astype(np.uint64)))
        mine = W.mix(t.seeds + W.U64(31) * t.row.astype(np.uint64))
        at = np.minimum(np.searchsorted(has, mine), max(0, len(has) - 1))
        may = np.flatnonzero(has[at] == mine) if len(has) else np.zeros(0, np.int64)
        starts, row = t.at[may], t.row[may]
        low = W.window_hashes(t.words, window, seed=22)[starts]
        again, lead = _repeated(low)
        pos = starts - t.first[row]
        ask = lead  # one of each kind asks or tells; the others of its kind are known repeats
        ref = _references(low)[again]
        bounds = np.searchsorted(row[ask], np.arange(len(t.count) + 1))
        runs, runs_row = _runs(row[again], pos[again], row[ref] - row[again], pos[ref])
        known_bounds = 4 * np.searchsorted(runs_row, np.arange(len(t.count) + 1))
        needed = np.bincount(row, minlength=len(t.count)) > 0
        full = _sha(raw, t, np.flatnonzero(~needed))
        text = batch.column(1).take(pa.array(np.arange(len(needed)), mask=~needed))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(3),
                pa.array(t.count, pa.int64()),
                pa.array([full.get(r) for r in range(len(t.count))], pa.string()),
                text,
                W.binary_column(runs.reshape(-1), known_bounds),
                W.binary_column(pos[ask].astype("<i4"), bounds),
                W.binary_column(again[ask], bounds),
            ],
            ["doc_id", "own", "n_words", "kept_sha256", "text", "known", "at", "again"],
        )

    return run


def _sha(raw: np.ndarray, t: _Text, rows: np.ndarray) -> dict[int, str]:
    from hashlib import sha256

    return {
        int(r): sha256(_joined(raw, t.starts[t.first[r] : t.first[r + 1]], t.ends[t.first[r] : t.first[r + 1]])).hexdigest()
        for r in rows
    }


def _joined(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words, joined by one space each."""
    if not len(starts):
        return b""
    size = ends - starts + 1
    out = np.full(int(size.sum()), 0x20, dtype=np.uint8)
    at = np.cumsum(size) - size
    out[W.ragged(at, size - 1)] = raw[W.ragged(starts, size - 1)]
    return out[:-1].tobytes()


def _ask(window: int):
    """Windows to look up, in three numbers for the shuffle: 96 bits of their hashes, ``low`` and the upper half of ``high``, whose
    lower half is the position; and ``row``, doubled, plus one where the window repeats in its own block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = W.utf8(batch.column(1))
            for i, j in W.slices(offsets, BLOCK_BYTES):
                yield block(batch.slice(i, j - i), raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])

    def values(column: pa.Array, kind: str) -> np.ndarray:
        o = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        return np.frombuffer(column.buffers()[2], np.uint8)[o[0] : o[-1]].view(kind) if o[-1] > o[0] else np.zeros(0, kind)

    def block(batch: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        row, _, at, again = batch.columns
        size = np.diff(np.frombuffer(at.buffers()[1], np.int32)[at.offset : at.offset + len(at) + 1]) // 4
        starts, ends, first = W.spans(raw, offsets, W.SPACE_WORDS)
        words = W.word_hashes(raw, starts, ends)
        pos = values(at, "<i4").astype(np.int64)
        place = pos + np.repeat(first[:-1], size)
        low = W.window_hashes(words, window, seed=22)[place] if len(place) else np.zeros(0, np.uint64)
        high = W.window_hashes(words, window, seed=23)[place] if len(place) else np.zeros(0, np.uint64)
        high = high >> W.U64(32) << W.U64(32) | pos.astype(np.uint64)
        told = 2 * np.repeat(row.to_numpy(), size) + values(again, "u1")
        return pa.RecordBatch.from_arrays([_signed(low.copy()), _signed(high), pa.array(told)], ["low", "high", "row"])

    return run


def factors(at: np.ndarray, ref: np.ndarray, ref_at: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Parses a document: first word, end, reference row and first word there of its factors, from left to right.

    At position ``at[i]`` (ascending) the ``window`` words also start at ``ref_at[i]`` of row ``ref[i]``. A factor grows by the
    next word while that stands at the reference's next position.
    """
    grows = (np.diff(at) == 1) & (np.diff(ref) == 0) & (np.diff(ref_at) == 1)
    first = np.flatnonzero(np.concatenate([[True], ~grows])) if len(at) else np.zeros(0, np.int64)
    last = np.concatenate([first[1:], [len(at)]])[: len(first)] - 1
    return at[first], at[last] + window, ref[first], ref_at[first]


def joined(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Spans (first, end) of factors in order, those that touch or cross as one."""
    if not len(first):
        return []
    cut = np.flatnonzero(first[1:] > last[:-1])  # ends ascend, as all factors end a window after their last position
    return list(zip(first[np.concatenate([[0], cut + 1])].tolist(), last[np.concatenate([cut, [len(last) - 1]])].tolist()))


def _lists(rows: list[tuple[np.ndarray, ...]], names: tuple[str, ...]) -> pa.ListArray:
    """A column of lists of structs, a tuple of equally long field arrays per row."""
    bounds = np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])])
    fields = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*rows)]
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(fields, names))


def _found_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its positions that the index names, with references, as runs (first, length, reference row, first there)."""
    for batch in batches:
        lists = batch.column(1)
        owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
        both, ref = (lists.flatten().field(c).to_numpy() for c in ("both", "ref"))
        order = np.lexsort((both >> 32, owner))
        owner, both, ref = owner[order], both[order], ref[order]
        at, ref_at = both >> 32, both & 0xFFFFFFFF
        goes_on = (np.diff(owner) == 0) & (np.diff(at) == 1) & (np.diff(ref) == 0) & (np.diff(ref_at) == 1)
        first = np.flatnonzero(np.concatenate([[True], ~goes_on])) if len(at) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(at)))
        runs = np.stack([at[first], size, ref[first], ref_at[first]], axis=1).astype("<i8")
        bounds = 4 * np.searchsorted(owner[first], np.arange(batch.num_rows + 1))
        yield pa.RecordBatch.from_arrays([batch.column(0), W.binary_column(runs.reshape(-1), bounds)], ["row", "found"])


def _positions(row: int, known: bytes | None, found: bytes | None) -> tuple[np.ndarray, ...]:
    """Repeated positions of a document in order, with their references."""
    first, size, ref, ref_first = np.frombuffer(known or b"", "<i4").astype(np.int64).reshape(-1, 4).T
    at, ref_at = W.ragged(first, size), W.ragged(ref_first, size)
    ref = np.repeat(row + ref, size)  # rows of a block are numbered one after the other
    if found:
        first, size, other, ref_first = np.frombuffer(found, "<i8").reshape(-1, 4).T
        more = W.ragged(first, size), np.repeat(other, size), W.ragged(ref_first, size)
        at, ref, ref_at = (np.concatenate(x) for x in zip((at, ref, ref_at), more))
    order = np.argsort(at, kind="stable")
    return at[order].astype(np.int64), ref[order], ref_at[order].astype(np.int64)


def _parse(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        for batch in batches:
            row, doc, count, full, text, known, found = batch.columns
            raw, offsets = W.utf8(text)
            for i, j in W.slices(offsets, BLOCK_BYTES):
                part = raw[offsets[i] : offsets[j]]
                starts, ends, first = W.spans(part, offsets[i : j + 1] - offsets[i], W.SPACE_WORDS)
                spans, parsed, removed, sha = [], [], [], []
                for r in range(i, j):
                    n, a = count[r].as_py(), int(first[r - i])
                    own = factors(*_positions(row[r].as_py(), known[r].as_py(), found[r].as_py()), window)
                    whole = joined(*own[:2])
                    keep = np.ones(n, dtype=bool)
                    for s, e in whole:
                        keep[s:e] = False
                    parsed.append(own)
                    spans.append(tuple(np.array(whole, dtype=np.int64).reshape(-1, 2).T))
                    removed.append(int(n - keep.sum()))
                    if full[r].is_valid:
                        sha.append(full[r].as_py())
                    else:
                        left = a + np.flatnonzero(keep)
                        sha.append(sha256(_joined(part, starts[left], ends[left])).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        row.slice(i, j - i),
                        doc.slice(i, j - i),
                        count.slice(i, j - i),
                        pa.array(removed, pa.int64()),
                        pa.array(sha, pa.string()),
                        _lists(spans, ("first", "last")),
                        _lists(parsed, ("first", "last", "ref", "ref_first")),
                    ],
                    ["row", "doc_id", "n_words", "n_removed", "kept_sha256", "spans", "factors"],
                )

    return run


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int | None = None
) -> DataFrame:
    """One row per document: its number as ``row``, its key as ``doc_id``, ``n_words``, ``n_removed`` (words in duplicate
    spans), ``kept_sha256`` (of the other words, joined by one space), ``spans`` (of words, ``last`` exclusive) and
    ``factors``: words from ``first`` to before ``last`` also start at word ``ref_first`` of the document with row ``ref``."""
    seed = seed or max(1, min(SEED, window))
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # Seeds come back by key and text, so rows that share a key (null or repeated) don't get each other's. Texts whose
    # hashes collide would look up too many windows, no other.
    rows = rows.withColumn("own", F.xxhash64("doc_id", "text"))

    seeds = rows.select("own", "text").mapInArrow(
        _seed_rows(window, seed), "dealt bigint, seed bigint, own bigint, again boolean, lead boolean"
    )
    seeds = seeds.repartition("dealt").sortWithinPartitions("dealt", "lead")
    seeds = seeds.mapInArrow(_neighbours(["dealt"], ["seed", "own"]), "seed bigint, own bigint")
    seeds = seeds.groupBy("own").agg(F.collect_set("seed").alias("seeds"))  # at most the seeds of one document

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = (
        rows.join(seeds, "own", "left")
        .select("doc_id", "text", "seeds", "own")
        .mapInArrow(
            _window_rows(window, seed),
            f"doc_id {kind}, own bigint, n_words bigint, kept_sha256 string, text string, known binary, at binary, again binary",
        )
        .withColumn("row", F.monotonically_increasing_id())
    )
    found = write_bucketed_scratch_table(spark, found, "factors", "own", parts)

    asked = found.where(F.octet_length("at") > 0).select("row", "text", "at", "again")
    asked = asked.mapInArrow(_ask(window), "low bigint, high bigint, row bigint")
    asked = asked.repartition("low").select(
        "low",
        F.shiftright("high", 32).cast("int").alias("high"),
        F.shiftright("row", 1).alias("row"),
        F.col("high").bitwiseAND(0xFFFFFFFF).cast("int").alias("at"),
        (F.col("row") % 2 == 1).alias("again"),
    )
    asked = asked.sortWithinPartitions("low", "high", "row")
    hits = asked.mapInArrow(_referred, "row bigint, at int, ref bigint, ref_at int")
    # At most the words of one document; then as runs, before they go to the texts.
    both = (F.shiftleft(F.col("at").cast("bigint"), 32) + F.col("ref_at")).alias("both")
    hits = hits.select("row", F.struct(both, "ref").alias("hit")).groupBy("row").agg(F.collect_list("hit").alias("found"))
    hits = hits.mapInArrow(_found_runs, "row bigint, found binary")
    hits = hits.join(found.select("row", "own"), "row").select(F.col("row").alias("hit"), F.col("own").alias("hit_own"), "found")

    # Rows with the same key and text share ``own``. Not an equality of two columns, which would be hashed too and texts shuffled.
    own = found.select("own", "row", "doc_id", "n_words", "kept_sha256", "text", "known")
    told = own.join(hits, (F.col("own") == F.col("hit_own")) & (F.col("row") - F.col("hit") == 0), "left")
    return told.select("row", "doc_id", "n_words", "kept_sha256", "text", "known", "found").mapInArrow(
        _parse(window),
        f"row bigint, doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string, "
        "spans array<struct<first:bigint,last:bigint>>, "
        "factors array<struct<first:bigint,last:bigint,ref:bigint,ref_first:bigint>>",
    )


def factor_table(parsed: DataFrame) -> DataFrame:
    """The factors of ``repeated_spans``, a row each: ``doc_id``, ``first``, ``last``, and the reference's key as ``ref_id`` with
    ``ref_first``. Null keys stay null; documents without factors have no row."""
    rows = parsed.select("row", "doc_id", "factors")
    each = rows.select("doc_id", F.explode("factors").alias("f")).select("doc_id", "f.*")
    names = rows.select(F.col("row").alias("ref"), F.col("doc_id").alias("ref_id"))
    return each.join(names, "ref").select("doc_id", "first", "last", "ref_id", "ref_first")


def op10(docs: DataFrame) -> DataFrame:
    """The contract of op10."""
    return repeated_spans(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")

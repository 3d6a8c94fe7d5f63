"""Alignment of two tokenizers' tokens over the same text, and how often two ids are linked in the whole corpus.

Both sides spell out the same bytes: a space and the text. Side A is a byte-level BPE file (each entry decoded to its bytes),
side B a SentencePiece file (a marker is a space, ``<0xHH>`` one byte), which puts the space there by itself. Every token is
a byte range. Per batch of documents, ``pandas.merge_asof`` keyed by document finds for each token start the other side's
token that covers it, in both directions; the union of the two is the list of all overlapping pairs (links). Offsets where
tokens of both sides end cut the tokens into groups.

Corpus counts. Each task turns its documents into blocks (one row per ``BLOCK_BYTES`` of text or one longer text): the
block's distinct id pairs with their counts, most frequent first, and every link as an index into them, compressed. The
blocks are written once to the shared scratch folder. Only distinct pairs of a block go through the shuffles that sum them
up and bring the sums back, so a pair that every block holds costs one row per block, and no vocabulary-sized table is
broadcast. Tokens are aligned ``ALIGN_BYTES`` of text at a time, which bounds a worker's memory.

Null, empty and differing texts (whose joined token bytes are not the space and the text, as when the text holds U+2581)
have no tokens: zeros, empty lists and an empty digest. Null and repeated keys keep their rows; an empty table gives no
rows; other columns are not read, so their names can't clash. Ties for the highest count all count as best.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemlens.llm import words as W
from itemlens.llm.pieces import MARKER, pieces, spaced
from itemlens.llm.tokens import encoder, tokenizer_path
from itemlens.session import write_scratch_table

#: Text per block, and text aligned at once; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
ALIGN_BYTES = 512 << 10


def byte_entries(vocabulary: dict[str, int]) -> list[bytes]:
    """Bytes of every entry of a byte-level vocabulary, by id.

    Byte-level files write printable Latin-1 characters as themselves and the other bytes, in order, from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}
    out = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        out[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
    return out


def piece_entries(model) -> list[bytes]:
    """Bytes of every piece of a SentencePiece model, by id."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(MARKER, " ").encode())
    return out


def _fragments(n: int, inner: str, last: str) -> list[bytes]:
    return [f"{i}{end}".encode() for i in range(n) for end in (inner, last)]


@dataclass
class Alignment:
    """Tokens, groups and links of a run of documents; ``*_rows`` bound each document's part."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_rows: np.ndarray
    b_rows: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_rows: np.ndarray


class Aligner:
    """A worker's two tokenizers with the bytes of their entries."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = encoder(a_path), pieces(b_path)
        a_bytes, b_bytes = byte_entries(self.a.tokenizer.get_vocab()), piece_entries(self.b.model)
        self.a_table, self.b_table = pa.array(a_bytes, pa.large_binary()), pa.array(b_bytes, pa.large_binary())
        self.a_size = np.array([len(x) for x in a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x) for x in b_bytes], dtype=np.int64)
        self.written = pa.array(
            _fragments(len(a_bytes), ",", "|") + _fragments(len(b_bytes), ",", ";"), pa.large_binary()
        )

    @staticmethod
    def _spell(table: pa.Array, size: np.ndarray, ids: np.ndarray, rows: np.ndarray, text: np.ndarray, bounds: np.ndarray):
        """Rows whose ids spell out their text."""
        end = np.concatenate([[0], np.cumsum(size[ids])])[rows]
        right = np.diff(end) == np.diff(bounds)
        spelt = np.frombuffer(table.take(pa.array(ids)).buffers()[2] or b"", dtype=np.uint8)[: end[-1]]
        if right.all():
            wrong = np.flatnonzero(spelt != text)
            right[np.searchsorted(bounds, wrong, side="right") - 1] = False
        else:
            for r in np.flatnonzero(right).tolist():
                right[r] = np.array_equal(spelt[end[r] : end[r + 1]], text[bounds[r] : bounds[r + 1]])
        return right

    def align(self, raw: np.ndarray, offsets: np.ndarray) -> Alignment:
        rows = len(offsets) - 1
        text, bounds = spaced(raw, offsets)
        a_ids, a_rows = self.a.encode(text, bounds, None)
        b_ids, b_rows = self.b.encode(raw, offsets)
        good = np.diff(offsets) > 0
        full = np.concatenate([[0], np.cumsum(np.where(good, np.diff(bounds), 0))])
        if not good.all():  # empty texts have no tokens, so no space either
            keep = np.repeat(good, np.diff(bounds))
            text, kept = text[keep], np.repeat(good, np.diff(a_rows))
            a_ids, a_rows = a_ids[kept], np.concatenate([[0], np.cumsum(np.where(good, np.diff(a_rows), 0))])
            bounds = full
        right = self._spell(self.a_table, self.a_size, a_ids, a_rows, text, bounds)
        right &= self._spell(self.b_table, self.b_size, b_ids, b_rows, text, bounds)
        if not right.all():
            a_ids, b_ids = a_ids[np.repeat(right, np.diff(a_rows))], b_ids[np.repeat(right, np.diff(b_rows))]
            a_rows = np.concatenate([[0], np.cumsum(np.where(right, np.diff(a_rows), 0))])
            b_rows = np.concatenate([[0], np.cumsum(np.where(right, np.diff(b_rows), 0))])
        a_end, b_end = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
        common = a_end[np.isin(a_end, b_end, assume_unique=True)]
        link_a, link_b = self._links(a_ids, b_ids, a_rows, b_rows, a_end, b_end, rows)
        return Alignment(
            a_ids, b_ids, a_rows, b_rows,
            np.searchsorted(common, a_end), np.searchsorted(common, b_end),
            link_a, link_b, np.searchsorted(link_a, a_rows),
        )

    def _links(self, a_ids, b_ids, a_rows, b_rows, a_end, b_end, rows) -> tuple[np.ndarray, np.ndarray]:
        """Token indexes of all overlapping pairs, in the order of the text."""
        document = np.arange(rows, dtype=np.int32)
        a = pd.DataFrame(
            {
                "document": np.repeat(document, np.diff(a_rows)),
                "start": a_end - self.a_size[a_ids],
                "a": np.arange(len(a_ids)),
            }
        )
        b = pd.DataFrame(
            {
                "document": np.repeat(document, np.diff(b_rows)),
                "start": b_end - self.b_size[b_ids],
                "b": np.arange(len(b_ids)),
            }
        )
        covers_a = pd.merge_asof(a, b, on="start", by="document")
        covers_b = pd.merge_asof(b, a, on="start", by="document")
        # Where both start together, both directions find the same pair.
        x, y = covers_b["a"].to_numpy(), covers_b["b"].to_numpy()
        own = a["start"].to_numpy()[x] != covers_b["start"].to_numpy()
        start = np.concatenate([covers_a["start"].to_numpy(), covers_b["start"].to_numpy()[own]])
        order = np.argsort(start, kind="stable")
        return (
            np.concatenate([covers_a["a"].to_numpy(), x[own]])[order],
            np.concatenate([covers_a["b"].to_numpy(), y[own]])[order],
        )

    def group_digests(self, al: Alignment) -> list[str]:
        """Digest per document of its groups, written as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        last_a = np.append(al.a_group[1:] != al.a_group[:-1], True) if len(al.a_ids) else np.zeros(0, bool)
        last_b = np.append(al.b_group[1:] != al.b_group[:-1], True) if len(al.b_ids) else np.zeros(0, bool)
        code = np.empty(len(al.a_ids) + len(al.b_ids), dtype=np.int64)
        code[np.arange(len(al.a_ids)) + np.searchsorted(al.b_group, al.a_group)] = al.a_ids * np.int64(2) + last_a
        behind = np.arange(len(al.b_ids)) + np.searchsorted(al.a_group, al.b_group, side="right")
        code[behind] = (al.b_ids + np.int64(len(self.a_size))) * 2 + last_b
        written = self.written.take(pa.array(code))
        at = np.frombuffer(written.buffers()[1], dtype=np.int64)[al.a_rows + al.b_rows] if len(code) else al.a_rows
        data = memoryview(written.buffers()[2] or b"")
        return [hashlib.sha256(data[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(at[:-1].tolist(), at[1:].tolist())]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner of two files; kept for the worker's later tasks."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values).cast(kind))


def _aligned(a_path: str, b_path: str):
    names = ["doc_id", "a_ids", "b_ids", "a_group", "b_group", "link_a", "link_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        for batch in batches:
            raw, offsets = W.utf8(batch.column(1))
            for i, j in W.slices(offsets, ALIGN_BYTES):
                al = both.align(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])

                def from_first(values: np.ndarray, bounds: np.ndarray, first: np.ndarray) -> pa.Array:
                    return _lists(values - np.repeat(first, np.diff(bounds)), bounds, pa.int32())

                group = np.append(al.a_group, 0)[np.minimum(al.a_rows[:-1], max(0, len(al.a_group) - 1))]
                out = [
                    batch.column(0).slice(i, j - i),
                    _lists(al.a_ids, al.a_rows, pa.int32()),
                    _lists(al.b_ids, al.b_rows, pa.int32()),
                    from_first(al.a_group, al.a_rows, group),
                    from_first(al.b_group, al.b_rows, group),
                    from_first(al.link_a, al.link_rows, al.a_rows[:-1]),
                    from_first(al.link_b, al.link_rows, al.b_rows[:-1]),
                ]
                yield pa.RecordBatch.from_arrays(out, names)

    return run


def _paths(a: str | None, b: str | None) -> tuple[str, str]:
    return a or tokenizer_path("byte_bpe_50k.json"), b or tokenizer_path("piece_bpe_32k.model")


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str | None = None, b: str | None = None
) -> DataFrame:
    """One row per document: both sides' ids, the group number of every token, and all links as pairs of token numbers
    (``link_a[i]``, ``link_b[i]``), in the order of the text. One scan, no shuffle."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    fields = ", ".join(f"{n} array<int>" for n in ("a_ids", "b_ids", "a_group", "b_group", "link_a", "link_b"))
    return rows.mapInArrow(_aligned(*_paths(a, b)), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {fields}")


def pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, byte by byte of the same weight, compressed: small ones cost little."""
    return zstandard.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").reshape(-1)


_BLOCK = ["block", "doc_ids", "n_a", "n_b", "n_groups", "n_links", "digests", "pairs", "pair_links", "links"]


class _Block:
    """Aligned documents of one block, gathered piece by piece."""

    def __init__(self, kind: pa.DataType):
        self.kind, self.size = kind, 0
        self.keys, self.digests, self.pairs, self.links, self.held = [], [], [], [], []
        self.sizes: list[tuple[np.ndarray, ...]] = []

    def add(self, keys: pa.Array, al: Alignment, digests: list[str], size: int) -> None:
        pair = al.a_ids[al.link_a].astype(np.int64) << 32 | al.b_ids[al.link_b]
        pairs, link, held = np.unique(pair, return_inverse=True, return_counts=True)
        ends = np.append(al.a_group[1:] != al.a_group[:-1], True) if len(al.a_ids) else np.zeros(0, bool)
        groups = np.concatenate([[0], np.cumsum(ends)])[al.a_rows]
        self.keys.append(keys)
        self.digests += digests
        self.pairs.append(pairs)
        self.held.append(held)
        self.links.append(link.reshape(-1).astype(np.uint32))
        self.sizes.append(tuple(np.diff(x) for x in (al.a_rows, al.b_rows, groups, al.link_rows)))
        self.size += size

    def row(self, number: int) -> pa.RecordBatch:
        pairs, place = np.unique(np.concatenate(self.pairs), return_inverse=True)
        held = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(held, place, np.concatenate(self.held))
        order = np.argsort(-held, kind="stable")
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        at = np.cumsum([0, *map(len, self.pairs)])
        links = [rank[place[i:j]][link] for i, j, link in zip(at[:-1], at[1:], self.links)]

        def one(values, item: pa.DataType) -> pa.Array:
            flat = values if isinstance(values, pa.Array) else pa.array(values, item)
            return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat.cast(item))

        out = [
            pa.array([number], pa.int64()),
            one(pa.concat_arrays(self.keys), self.kind),
            *(one(np.concatenate(x), pa.int64()) for x in zip(*self.sizes)),
            one(self.digests, pa.string()),
            one(pairs[order], pa.int64()),
            one(held[order], pa.int64()),
            pa.array([pack(np.concatenate(links))], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(out, _BLOCK)


def _blocks(a_path: str, b_path: str, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        block = _Block(kind)
        for batch in batches:
            raw, offsets = W.utf8(batch.column(1))
            for i, j in W.slices(offsets, ALIGN_BYTES):
                al = both.align(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                block.add(batch.column(0).slice(i, j - i), al, both.group_digests(al), int(offsets[j] - offsets[i]))
                if block.size >= BLOCK_BYTES:
                    yield block.row(number)
                    block, number = _Block(kind), number + 1
        if block.keys:
            yield block.row(number)

    return run


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str | None = None, b: str | None = None) -> DataFrame:
    """The corpus aligned once and written in blocks: per block its documents' sizes and group digests, its distinct id
    pairs (``a << 32 | b``) with their links, and every link as an index into the pairs (see ``pack``)."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    key = rows.schema["doc_id"].dataType
    fields = (
        f"block bigint, doc_ids array<{key.simpleString()}>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
        "n_links array<bigint>, digests array<string>, pairs array<bigint>, pair_links array<bigint>, links binary"
    )
    made = rows.mapInArrow(_blocks(*_paths(a, b), to_arrow_type(key)), fields)
    return write_scratch_table(docs.sparkSession, made, "alignment")


def _entries(aligned: DataFrame) -> DataFrame:
    return aligned.select("block", F.posexplode(F.arrays_zip("pairs", "pair_links")).alias("place", "e")).select(
        "block", "place", F.col("e.pairs").alias("pair"), F.col("e.pair_links").alias("held")
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Corpus-wide links of every id pair in ``blocks``: a_id, b_id, links, and whether no other pair of the B id has more.

    The window per B id holds at most one row per A id.
    """
    counts = _entries(aligned).groupBy("pair").agg(F.sum("held").alias("links"))
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    counts = counts.select(F.shiftright("pair", 32).alias("a_id"), b_id.alias("b_id"), "links", "pair")
    return counts.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b_id")))


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for batch in batches:
        col = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            def flat(name: str) -> np.ndarray:
                return col[name][i].values.to_numpy(zero_copy_only=False) if col[name][i].is_valid else np.zeros(0, np.int64)

            place, links = flat("place"), unpack(col["links"][i].as_py())
            total, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
            total[place], best[place] = flat("total"), flat("best")
            bounds = np.concatenate([[0], np.cumsum(flat("n_links"))])
            summed = np.concatenate([[0], np.cumsum(total[links])])[bounds]
            hits = np.concatenate([[0], np.cumsum(best[links])])[bounds]
            out = [
                col["doc_ids"][i].values,
                *(pa.array(flat(n), pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")),
                pa.array(np.diff(hits), pa.int64()),
                pa.array(np.diff(summed), pa.int64()),
                col["digests"][i].values,
            ]
            yield pa.RecordBatch.from_arrays(out, names)


def op12(docs: DataFrame) -> DataFrame:
    """The contract of op12: sizes, group digest, and how a document's links stand in the corpus-wide counts."""
    aligned = blocks(docs)
    counts = pair_counts(aligned).select("pair", F.col("links").alias("total"), "best")
    back = (
        _entries(aligned)
        .join(counts, "pair")
        .groupBy("block")
        .agg(F.collect_list(F.struct("place", "total", F.col("best").cast("int").alias("best"))).alias("e"))
        .select("block", *(F.col(f"e.{n}").alias(n) for n in ("place", "total", "best")))
    )
    scored = aligned.drop("pairs", "pair_links").join(back, "block", "left")
    kind = aligned.schema["doc_ids"].dataType.elementType.simpleString()
    return scored.mapInArrow(
        _score,
        f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
        "groups_sha256 string",
    )

"""Piece ids of whole texts by a public SentencePiece file, with a table of distinct marked words, and their decoding.

SentencePiece puts a marker (U+2581) before a text and turns each space into one. Where no piece of the file holds a marker
behind another character, no merge crosses the place before a run of markers. A text is then cut there into marked words
(a run of markers and what follows up to the next run), each distinct marked word is segmented once by the library, and the
ids are joined back by position. The table is exact: words are told apart by their bytes, first within a group of texts
(Arrow's dictionary encoding), then among all groups that the Python worker has seen. It is held per worker, not
once for the corpus: sending every word occurrence through a shuffle would cost many times the texts themselves.

If a file's pieces do cross markers, or its normaliser changes more than spaces, whole texts go to the library instead.

Null texts are empty texts; an empty text has no ids and decodes to the empty text; null and repeated keys keep their rows;
an empty table gives no rows; other columns are not read, so their names can't clash. A very long text is cut like any
other, and one marked word of any length is segmented whole. Markers that stand in a text already are markers to the
library too, and come back as spaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemlens.llm import words as W
from itemlens.llm.tokens import GROUP_BYTES, tokenizer_path

MARKER = "▁"
#: Marked words above this many bytes are segmented but not kept.
LONG_WORD = 256
#: Distinct words and ids kept per worker (about 150 bytes a word); beyond either the table starts again.
TABLE_WORDS = 500_000
TABLE_IDS = 8_000_000
#: Ids handed to the library's decoder at once.
DECODE_IDS = 1 << 17

# A sample of what normalisers change: compatibility forms, composition, case, width, white space, controls.
_PROBE = "  aB  ﬁ①Ａé é\t\n\r 　​½ İß한ﾊ\u0000 x "


def spaced(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows with a space put before each."""
    rows = len(offsets) - 1
    out = np.insert(raw, offsets[:-1], 0x20)
    return out, offsets + np.arange(rows + 1)


def marked_words(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start of every marked word in rows that begin with a space."""
    n = len(raw)
    starts_marker = raw == 0x20
    ends_marker = starts_marker
    signs = np.flatnonzero(raw[:-2] == 0xE2) if n > 2 else np.zeros(0, np.int64)
    signs = signs[(raw[signs + 1] == 0x96) & (raw[signs + 2] == 0x81)]
    if len(signs):
        ends_marker = starts_marker.copy()
        starts_marker[signs] = True
        ends_marker[signs + 2] = True
    first = starts_marker
    if n:
        first = starts_marker.copy()
        first[1:] &= ~ends_marker[:-1]
        first[offsets[:-1]] = True
    return np.flatnonzero(first)


class Pieces:
    """A worker's SentencePiece model with its table of distinct marked words."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.opens = np.array([p.startswith(MARKER) for p in pieces])
        plain = self.model.normalize(_PROBE) == MARKER + _PROBE.replace(" ", MARKER)
        self.cuts = plain and not any(MARKER in p.lstrip(MARKER) for p in pieces) and MARKER in pieces
        self.reset()

    def reset(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.int32)

    def _segment(self, found: list[bytes]) -> list[list[int]]:
        """Ids of marked words: the library puts the first marker back by itself."""
        out = self.model.encode([(w[1:] if w[:1] == b" " else w[3:]).decode() for w in found], num_threads=1)
        lone = None
        for i, ids in enumerate(out):
            if not ids:  # a marker alone: the library has no ids for an empty text
                lone = lone or [self.model.piece_to_id(MARKER)]
                out[i] = lone
        return out

    def _add(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(place, number) of the ids of ``found``, appended to the table's ids."""
        ids = self._segment(found)
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter((x for one in ids for x in one), dtype=np.int32, count=int(size.sum()))
        at = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, flat])
        return at, size

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, row offsets into them) of rows of text."""
        rows = len(offsets) - 1
        if not self.cuts:
            data = raw.tobytes()
            whole = [data[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            ids = self.model.encode(whole, num_threads=1)
            size = np.fromiter(map(len, ids), dtype=np.int64, count=rows)
            return np.fromiter((x for one in ids for x in one), np.int32, int(size.sum())), np.concatenate([[0], np.cumsum(size)])
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64)
        text, bounds = spaced(raw, offsets)
        starts = marked_words(text, bounds)
        ends = np.append(starts[1:], len(text)).astype(np.int32)
        buffers = [None, pa.py_buffer(np.append(starts, len(text)).astype(np.int32)), pa.py_buffer(text)]
        table = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
        code = table.indices.to_numpy(zero_copy_only=False)
        distinct = table.dictionary.to_pylist()
        if len(self.slot) + len(distinct) > TABLE_WORDS or len(self.flat) > TABLE_IDS:
            self.reset()
        kept = len(self.flat)
        where = np.fromiter((self.slot.get(w, -1) for w in distinct), dtype=np.int64, count=len(distinct))
        new = np.flatnonzero(where < 0)
        at, size = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        old = np.flatnonzero(where >= 0)
        at[old], size[old] = self.at[where[old]], self.size[where[old]]
        flat = None
        if len(new):
            short = [i for i in new.tolist() if len(distinct[i]) <= LONG_WORD]
            if short:
                found = [distinct[i] for i in short]
                at[short], size[short] = self._add(found)
                self.slot.update(zip(found, range(len(self.at), len(self.at) + len(found))))
                self.at, self.size = np.concatenate([self.at, at[short]]), np.concatenate([self.size, size[short]])
            kept = len(self.flat)
            long = [i for i in new.tolist() if len(distinct[i]) > LONG_WORD]
            if long:
                at[long], size[long] = self._add([distinct[i] for i in long])
        flat, self.flat = self.flat, self.flat[:kept]
        size_of = size[code]
        ids = flat[W.ragged(at[code], size_of)]
        total = np.concatenate([[0], np.cumsum(size_of)])
        # Empty texts hold nothing but the space put before them.
        empty = np.flatnonzero(np.diff(offsets) == 0)
        first = np.searchsorted(starts, bounds)
        if len(empty):
            keep = np.ones(len(ids), dtype=bool)
            lone = total[first[empty]]
            for k in range(int(size_of[first[empty[0]]])):
                keep[lone + k] = False
            held = np.concatenate([[0], np.cumsum(keep)])
            return ids[keep], held[total[first]]
        return ids, total[first]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The library's text for every row of ids; long rows are cut before a piece that opens with a marker."""
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a <= DECODE_IDS or not self.cuts:
                out.append((a, b, ""))
                continue
            gap = ""
            while a < b:
                cut = b
                if b - a > DECODE_IDS:
                    later = np.flatnonzero(self.opens[ids[a + DECODE_IDS : b]])
                    cut = a + DECODE_IDS + int(later[0]) if len(later) else b
                out.append((a, cut, gap))
                a, gap = cut, " "  # the decoder drops the first marker of what it is given
        texts, flat = [], ids.tolist()
        for a, b, gap in out:
            part = self.model.decode(flat[a:b]) if b > a else ""
            if gap:
                texts[-1].append(gap + part)
            else:
                texts.append([part])
        return ["".join(t) if len(t) > 1 else t[0] for t in texts]


_MODELS: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The worker's model of a file; kept for the worker's later tasks."""
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            raw, offsets = W.utf8(batch.column(1))
            for i, j in W.slices(offsets, GROUP_BYTES):
                ids, at = model.encode(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists], ["doc_id", "ids"])

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            lists = batch.column(1)
            bounds = lists.offsets.to_numpy().astype(np.int64)
            ids = lists.values.to_numpy(zero_copy_only=False)
            for i, j in W.slices(bounds, GROUP_BYTES // 4):
                part = lists.slice(i, j - i)
                texts = model.decode(ids[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), part, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"]
                )

    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """One row per document: key and ``ids`` (array of int), the library's ids without begin and end. One scan, no shuffle."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_encode(model or tokenizer_path("piece_bpe_32k.model")), f"doc_id {kind}, ids array<int>")


def decode(coded: DataFrame, model: str | None = None) -> DataFrame:
    """Adds ``decoded``, the library's text for the ids, to rows of (doc_id, ids). Null ids are no ids."""
    rows = coded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, ids array<int>, decoded string"
    return rows.mapInArrow(_decode(model or tokenizer_path("piece_bpe_32k.model")), fields)


def op13(docs: DataFrame) -> DataFrame:
    """The contract of op13: number and digest of a document's ids, and digest of what they decode to."""
    return decode(encode(docs)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

"""Token ids of whole texts by a public tokenizer file, with a cache of short chunks.

Both tokenizers used here first split a text into pre-tokens and then merge inside each one, so a text may be cut
wherever a pre-token must begin and its chunks encoded alone: the ids of the chunks, in order, are the ids of the text.
Chunks repeat, so every distinct one is encoded once per Python worker and looked up by its 64-bit hash and length.

A cut is made only where both tokenizers' rules must start a new pre-token, judged by bytes:
- before a single space, and around a single line feed, that has a letter, digit or safe mark on both sides;
- between a letter and a safe mark.
Letters are A-Z, a-z and the two-byte letters U+00C0..U+00FF; safe marks are ASCII marks but the apostrophe (it starts
contractions). Everything else (other white space, digits beside letters, other scripts) stays inside its chunk.
Special-token strings in a text are ordinary text, as the tokenizers' notes advise (``encode_special_tokens``).
"""

from __future__ import annotations

import os
import re

import numpy as np

from itemlens.llm import words as W

#: End-of-document id that the contracts append to every document.
END_ID = 1
#: Texts are encoded in groups of at most this many bytes (or one longer text).
GROUP_BYTES = 4 << 20
#: Distinct chunks kept per worker (about 50 bytes each); beyond it the cache starts again.
CACHE_CHUNKS = 2_000_000

_OTHER, _SPACE, _LF, _LETTER, _MARK, _DIGIT = range(6)


def _classes() -> np.ndarray:
    t = np.full(256, _OTHER, dtype=np.uint8)
    t[0x20], t[0x0A] = _SPACE, _LF
    t[0x30:0x3A] = _DIGIT
    t[0x41:0x5B] = t[0x61:0x7B] = _LETTER
    for lo, hi in ((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)):
        t[lo:hi] = _MARK
    t[ord("'")] = _OTHER
    return t


_CLASS = _classes()
_LETTERS = re.compile("[ ]?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")


def chunk_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where chunks start; every non-empty row starts one."""
    n = len(raw)
    c = np.zeros(n + 3, dtype=np.uint8)  # two guards before, one after
    mid = c[2 : n + 2]
    mid[:] = _CLASS[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3) if n else np.zeros(0, np.int64)
    lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]  # the signs for times and divided by are no letters
    mid[lead] = _LETTER
    mid[lead + 1] = _LETTER
    before, here = c[1 : n + 1], mid
    solid = c >= _LETTER
    gap = (here == _SPACE) | (here == _LF)
    cut = gap & solid[1 : n + 1] & solid[3 : n + 3]
    cut |= solid[2 : n + 2] & (before == _LF) & solid[:n]
    cut |= ((before == _LETTER) & (here == _MARK)) | ((before == _MARK) & (here == _LETTER))
    rows = offsets[:-1][np.diff(offsets) > 0]
    cut[rows] = True
    return np.flatnonzero(cut)


class Encoder:
    """Encodes groups of texts to one array of ids plus row offsets."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self._reset()

        self.pieces = self._letter_pieces()

    def _letter_pieces(self) -> dict[int, str] | None:
        """What the tokenizer's own normaliser and splitter make of a leading space and of each letter alone.

        A chunk of letters with at most a leading space is one pre-token, so its merge step can be asked directly with
        these pieces joined, at a fraction of a full encoding's cost. None if the file's rules aren't of that kind.
        """
        norm, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer

        def cut(text: str) -> list[str]:
            return [p for p, _ in split.pre_tokenize_str(norm.normalize_str(text) if norm else text)]

        letters = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
        own = {c: cut(c) for c in letters}
        spaced = cut(" a")
        if any(len(p) != 1 for p in (*own.values(), spaced)) or not spaced[0].endswith(own["a"][0]):
            return None
        table = {ord(c): p[0] for c, p in own.items()} | {0x20: spaced[0].removesuffix(own["a"][0])}
        every = " " + "".join(letters)
        return table if cut(every) == [every.translate(table)] else None

    def _ids(self, chunks: list[str]) -> list[list[int]]:
        """The ids of every chunk, each encoded alone."""
        out: list[list[int] | None] = [None] * len(chunks)
        if self.pieces is not None:
            merge = self.tokenizer.model.tokenize
            for i, c in enumerate(chunks):
                if _LETTERS.fullmatch(c):
                    out[i] = [t.id for t in merge(c.translate(self.pieces))]
        rest = [i for i, x in enumerate(out) if x is None]
        full = self.tokenizer.encode_batch_fast([chunks[i] for i in rest], add_special_tokens=False)
        for i, e in zip(rest, full):
            out[i] = e.ids
        return out

    def _reset(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)

    def _learn(self, keys: np.ndarray, chunks: list[str]) -> None:
        """Encodes distinct chunks and merges them into the sorted cache."""
        ids = self._ids(chunks)
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter((x for one in ids for x in one), dtype=np.uint32, count=int(size.sum()))
        at = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, flat])
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.at = np.insert(self.at, where, at)
        self.size = np.insert(self.size, where, size)

    def encode(self, raw: np.ndarray, offsets: np.ndarray, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """(ids, row offsets into them); ``end_id`` closes every row."""
        starts = chunk_starts(raw, offsets)
        ends = np.append(starts[1:], len(raw))
        first = np.searchsorted(starts, offsets)
        key = W.word_hashes(raw, starts, ends, seed=11) ^ (ends - starts).astype(np.uint64)
        distinct, example, inverse = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > CACHE_CHUNKS:
            self._reset()
        where = np.minimum(np.searchsorted(self.keys, distinct), max(0, len(self.keys) - 1))
        new = np.flatnonzero(self.keys[where] != distinct) if len(self.keys) else np.arange(len(distinct))
        if len(new):
            data = raw.tobytes()
            picked = example[new]
            self._learn(distinct[new], [data[s:e].decode() for s, e in zip(starts[picked].tolist(), ends[picked].tolist())])
            where = np.searchsorted(self.keys, distinct)
        size = self.size[where][inverse]
        ids = self.flat[W.ragged(self.at[where][inverse], size)]
        bounds = np.concatenate([[0], np.cumsum(size)])[first]
        if end_id is None:
            return ids, bounds
        rows = len(offsets) - 1
        out = np.full(len(ids) + rows, end_id, dtype=np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(rows), np.diff(bounds))] = ids
        return out, bounds + np.arange(rows + 1)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; kept for the worker's later tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    """Where the installed public tokenizers keep file ``name``."""
    import public_tokenizers

    return public_tokenizers.path(name)

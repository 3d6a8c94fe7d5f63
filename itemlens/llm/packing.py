"""Packing documents into fixed-length training sequences by minimum bin slack.

Every scan task tokenises its rows and packs them in blocks, with no shuffle:

1. A document's full windows of ``capacity`` ids become sequences of their own; what is left of it is shorter than one.
2. The remainders of a block form a multiset of lengths. For each sequence the longest one is set, and a subset-sum
   dynamic program over the others fills the space that is left: bit ``s`` of an integer says whether some choice of
   the lengths seen so far sums to ``s``, lengths enter from the longest down in copies of 1, 2, 4, ..., and the program
   ends as soon as the space can be filled exactly. Walking the recorded bit sets backwards gives the counts of
   the chosen lengths.
3. Where the best choice leaves slack, the longest document left is cut to fill it, so each sequence is full.
4. Fewer than ``capacity`` ids remain at the end of a block. They are cut into sequences whose lengths are falling powers
   of two, which need no padding.

So no sequence is padded at all, and a block adds at most log2(capacity) short sequences. A block is closed when it holds
``BLOCK_IDS`` ids, which bounds memory; one longer document is a block alone. Sequence ids count within the task, in the
way of ``monotonically_increasing_id``: read from a table, a retried task gives the same ids.

Nulls and empty texts are documents with only the end id; repeated rows and repeated ids are packed as separate rows; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemlens.llm import words as W
from itemlens.llm.tokens import END_ID, GROUP_BYTES, encoder, tokenizer_path

CAPACITY = 2048
#: Ids held by one packing block.
BLOCK_IDS = 1 << 21

#: doc_id keeps its own type; ids are little-endian unsigned 32-bit.
FIELDS = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def best_fill(lengths: list[int], counts: dict[int, int], space: int) -> list[tuple[int, int]]:
    """Counts of ``lengths`` (descending) whose sum is the largest that ``space`` allows, by subset sums in a bit set."""
    full, reach, steps = (1 << (space + 1)) - 1, 1, []
    for size in lengths:
        if size > space:
            continue
        left, copies = min(counts[size], space // size), 1
        while left:
            take = min(copies, left)
            steps.append((size, take, reach))
            reach |= (reach << (size * take)) & full
            left -= take
            copies *= 2
        if reach >> space:
            break
    total, chosen = reach.bit_length() - 1, {}
    for size, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[size] = chosen.get(size, 0) + take
            total -= size * take
    return list(chosen.items())


def pack_lengths(sizes: list[int], capacity: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences over documents of ``sizes`` ids: lists of (document, start, length); each id lies in one piece."""
    short: dict[int, list[tuple[int, int]]] = {}
    for doc, size in enumerate(sizes):
        for start in range(0, size - capacity + 1, capacity):
            yield [(doc, start, capacity)]
        if rest := size % capacity:
            short.setdefault(rest, []).append((doc, size - rest))
    for items in short.values():
        items.reverse()  # popped in input order
    lengths = sorted(short, reverse=True)
    counts = {size: len(items) for size, items in short.items()}
    total = sum(size * n for size, n in counts.items())

    def pop(size: int) -> tuple[int, int]:
        doc, start = short[size].pop()
        counts[size] -= 1
        if not counts[size]:
            lengths.remove(size)
        return doc, start

    def push(size: int, item: tuple[int, int]) -> None:
        if not counts.get(size):
            at = next((i for i, x in enumerate(lengths) if x < size), len(lengths))
            lengths.insert(at, size)
        counts[size] = counts.get(size, 0) + 1
        short.setdefault(size, []).append(item)

    def fill(space: int) -> list[tuple[int, int, int]]:
        """Pieces for exactly ``space`` ids; at least so many are left."""
        out = []
        if lengths and lengths[0] <= space:  # the longest is the hardest to place later
            size = lengths[0]
            out.append((*pop(size), size))
            space -= size
        for size, n in best_fill(lengths, counts, space) if space else ():
            for _ in range(n):
                out.append((*pop(size), size))
            space -= size * n
        if space:  # what is left is longer than the slack: cut the longest
            size = lengths[0]
            doc, start = pop(size)
            out.append((doc, start, space))
            push(size - space, (doc, start + space))
        return out

    while total >= capacity:
        total -= capacity
        yield fill(capacity)
    while total:
        part = 1 << (total.bit_length() - 1)
        total -= part
        yield fill(part)


def _packed(path: str, capacity: int, end_id: int | None):
    def block(ids: list, bounds: list, keys: list, first: int) -> tuple[pa.RecordBatch, int]:
        flat, size = np.concatenate(ids), np.concatenate([np.diff(b) for b in bounds])
        begin = np.cumsum(size) - size
        doc, start, length, seq, offset, n = [], [], [], [], [], first
        for pieces in pack_lengths(size.tolist(), capacity):
            at = 0
            for d, s, k in pieces:
                doc.append(d)
                start.append(s)
                length.append(k)
                seq.append(n)
                offset.append(at)
                at += k
            n += 1
        doc, start, length = (np.array(x, dtype=np.int64) for x in (doc, start, length))
        cut = flat[W.ragged(begin[doc] + start, length)].astype("<u4")
        columns = [
            pa.concat_arrays(keys).take(pa.array(doc)),
            pa.array(start),
            pa.array(length),
            W.binary_column(cut, np.concatenate([[0], np.cumsum(length)])),
            pa.array(size[doc]),
            pa.array(seq, pa.int64()),
            pa.array(offset, pa.int64()),
        ]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        return pa.RecordBatch.from_arrays(columns, names), n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, n = encoder(path), TaskContext.get().partitionId() << 33
        ids, bounds, keys, held = [], [], [], 0
        for batch in batches:
            raw, offsets = W.utf8(batch.column(1))
            for i, j in W.slices(offsets, GROUP_BYTES):
                flat, at = enc.encode(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], end_id)
                ids.append(flat)
                bounds.append(at)
                keys.append(batch.column(0).slice(i, j - i))
                held += len(flat)
                if held >= BLOCK_IDS:
                    out, n = block(ids, bounds, keys, n)
                    yield from sliced(out)
                    ids, bounds, keys, held = [], [], [], 0
        if held:
            out, n = block(ids, bounds, keys, n)
            yield from sliced(out)

    def sliced(out: pa.RecordBatch, rows: int = 1024) -> Iterator[pa.RecordBatch]:
        for i in range(0, out.num_rows, rows):
            yield out.slice(i, rows)

    return run


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int | None = END_ID,
) -> DataFrame:
    """One row per piece of a document: its key as ``doc_id``, where it starts in the document, its ids (little-endian
    unsigned 32-bit, with ``end_id`` after the last), the document's ids, its sequence and its offset there.

    ``tokenizer`` is a path that every executor can open; by default the installed public byte-level BPE.
    """
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_packed(path, capacity, end_id), f"doc_id {kind}, {FIELDS}")


def op1(docs: DataFrame) -> DataFrame:
    """The contract of op1: the pieces with a checksum of their ids."""
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )

"""Token ids in word-aligned Simple-8b files, written in document order and read back.

Coding. A 64-bit word has a 4-bit selector in its top bits and ``n`` values of ``w`` bits below it, first value lowest.
The encoder takes the selector that packs most of the next values; the tail of a block is filled up with zeros. Selector
0 is the escape: its 60 bits are an index into the list of values of 2**60 and more, kept raw behind the words. Ids are
coded in blocks of ``BLOCK`` values that start on a word of their own, and every block's first word is listed, so a
reader goes straight to the blocks that hold a document. All blocks of a chunk are coded in step: one numpy pass advances
every block by one word, and decoding unpacks all words of a selector at once.

Files. Parquet is the container (it can be written and read on any store that Spark knows). One row is a chunk: whole
documents of together ``CHUNK_IDS`` ids or one longer document, in ascending order of the key. Columns: ``part`` (file in
key order), ``chunk`` (number in the file), ``before`` (ids in the file before it), ``doc_ids``, ``lengths`` (ids per
document), ``words``, ``block_words`` (first word per block), ``escapes`` (little-endian unsigned 64-bit).

Null texts are empty documents with the end id only; null keys come first; rows with equal keys stay apart, in the order
of their texts; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemlens.llm import words as W
from itemlens.llm.tokens import END_ID, GROUP_BYTES, encoder, tokenizer_path
from itemlens.session import scratch_path

#: Values per block and ids per chunk.
BLOCK = 1024
CHUNK_IDS = 1 << 19

# Values per word and bits per value of selectors 1 to 15; selector 0 is the escape.
COUNTS = (1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
LIMIT = np.uint64(1 << 60)


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of every block, escaped values) of unsigned 64-bit ``values``."""
    v = values.astype(np.uint64)
    n = len(v)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    blocks = -(-n // block)
    stop = np.minimum((np.arange(n) // block + 1) * block, n)
    at = np.arange(n)
    # The first selector whose width holds a value; 16 if none does. One row per block, zeros behind the last value.
    least = np.zeros((blocks, block), dtype=np.uint8)
    least.reshape(-1)[:n] = np.searchsorted(np.array([1 << w for w in WIDTHS[1:]], dtype=np.uint64), v, side="right") + 1
    # Largest over the next COUNTS[s] values, each from the one before: windows may overlap, a maximum doesn't mind.
    most, span = least.copy(), 1
    selector = np.where(most <= 15, 15, 0).astype(np.uint8)
    for s in range(14, 0, -1):
        shift = COUNTS[s] - span
        wider = most.copy()
        if shift < block:
            np.maximum(most[:, :-shift], most[:, shift:], out=wider[:, :-shift])
        most, span = wider, COUNTS[s]
        selector[most <= s] = s
    selector = selector.reshape(-1)[:n]
    jump = np.minimum(at + np.array(COUNTS)[selector], stop)
    # All blocks in step: the k-th pass finds where the k-th word of every block starts.
    here, begun = np.arange(blocks) * block, np.zeros(n, dtype=bool)
    last = np.minimum(here + block, n)
    while len(here):
        begun[here] = True
        here = jump[here]
        more = here < last
        here, last = here[more], last[more]
    starts = np.flatnonzero(begun)
    sel = selector[starts]
    words = sel.astype(np.uint64) << np.uint64(60)
    size = jump[starts] - starts
    for s in range(1, 16):
        if WIDTHS[s] == 0:
            continue
        rows = np.flatnonzero(sel == s)
        for k in range(COUNTS[s]):
            live = rows[size[rows] > k]
            if not len(live):
                break
            words[live] |= v[starts[live] + k] << np.uint64(WIDTHS[s] * k)
    escaped = np.flatnonzero(sel == 0)
    words[escaped] = np.arange(len(escaped), dtype=np.uint64)
    return words, np.searchsorted(starts, np.arange(blocks) * block), v[starts[escaped]]


def decode(
    words: np.ndarray, block_words: np.ndarray, escapes: np.ndarray, n: int, block: int = BLOCK
) -> np.ndarray:
    """The ``n`` values that ``encode`` turned into ``words``."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    room = np.array(COUNTS, dtype=np.int64)[sel]
    edges = np.append(block_words, len(words))
    # Where each word's values begin: within its block by a running sum, blocks at multiples of ``block``.
    before = np.cumsum(room) - room
    which = np.repeat(np.arange(len(block_words)), np.diff(edges))
    begin = before - before[block_words][which] + which * block if len(words) else before
    stop = np.minimum((which + 1) * block, n)
    out = np.zeros(n, dtype=np.uint64)
    for s in range(16):
        rows = np.flatnonzero(sel == s)
        if not len(rows) or (s and not WIDTHS[s]):
            continue
        body = words[rows] & (LIMIT - np.uint64(1))
        if s == 0:
            out[begin[rows]] = escapes[body.astype(np.int64)]
            continue
        mask = np.uint64((1 << WIDTHS[s]) - 1)
        for k in range(COUNTS[s]):
            live = begin[rows] + k < stop[rows]
            out[begin[rows[live]] + k] = (body[live] >> np.uint64(WIDTHS[s] * k)) & mask
    return out


def decode_range(chunk: dict, first: int, last: int, block: int = BLOCK) -> np.ndarray:
    """Values ``first`` to ``last`` (exclusive) of a chunk, decoding only the blocks that hold them."""
    n = int(sum(chunk["lengths"]))
    lo, hi = first // block, min(-(-last // block), len(chunk["block_words"]))
    if first >= last:
        return np.zeros(0, np.uint64)
    words = np.frombuffer(chunk["words"], "<u8")
    edges = np.append(np.array(chunk["block_words"], dtype=np.int64), len(words))
    got = decode(words[edges[lo] : edges[hi]], edges[lo:hi] - edges[lo], np.frombuffer(chunk["escapes"], "<u8"), min(hi * block, n) - lo * block, block)
    return got[first - lo * block : last - lo * block]


def _chunks(path: str, end_id: int | None, kind: pa.DataType):
    names = ["part", "chunk", "before", "doc_ids", "lengths", "words", "block_words", "escapes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(path), TaskContext.get().partitionId()
        keys, ids, sizes, held, chunk, before = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            words, blocks, escapes = encode(np.concatenate(ids))
            row = [
                pa.array([part], pa.int32()),
                pa.array([chunk], pa.int64()),
                pa.array([before], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, sum(map(len, keys))], pa.int32()), pa.concat_arrays(keys).cast(kind)),
                pa.array([np.concatenate(sizes)], pa.list_(pa.int64())),
                pa.array([words.astype("<u8").tobytes()], pa.binary()),
                pa.array([blocks], pa.list_(pa.int64())),
                pa.array([escapes.astype("<u8").tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(row, names)

        for batch in batches:
            raw, offsets = W.utf8(batch.column(1))
            for i, j in W.slices(offsets, min(GROUP_BYTES, CHUNK_IDS)):
                flat, at = enc.encode(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], end_id)
                ids.append(flat)
                sizes.append(np.diff(at))
                keys.append(batch.column(0).slice(i, j - i))
                held += len(flat)
                if held >= CHUNK_IDS:
                    yield close()
                    before, chunk = before + held, chunk + 1
                    keys, ids, sizes, held = [], [], [], 0
        if keys:
            yield close()

    return run


def write_ids(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int | None = END_ID,
) -> None:
    """Writes the ids of all ``docs`` to files under ``path``, documents in ascending key order over all files.

    One range shuffle of (key, text) orders the rows; each task then encodes its rows as a stream.
    """
    source = tokenizer or tokenizer_path("word_bpe_49k.json")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    key = rows.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    ordered = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(
        _chunks(source, end_id, to_arrow_type(key)),
        f"part int, chunk bigint, before bigint, doc_ids array<{key.simpleString()}>, lengths array<bigint>, "
        "words binary, block_words array<bigint>, escapes binary",
    ).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            col = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            sizes = col["lengths"][i].values.to_numpy(zero_copy_only=False)
            blocks = col["block_words"][i].values.to_numpy(zero_copy_only=False)
            words = np.frombuffer(col["words"][i].as_buffer(), "<u8")
            escapes = np.frombuffer(col["escapes"][i].as_buffer(), "<u8")
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            ids = decode(words, blocks, escapes, int(bounds[-1])).astype("<u4")
            start = bounds[:-1] + col["before"][i].as_py()
            part = pa.array(np.full(len(sizes), col["part"][i].as_py(), dtype=np.int32))
            out = [part, col["doc_ids"][i].values, pa.array(start), pa.array(sizes), W.binary_column(ids, bounds)]
            yield pa.RecordBatch.from_arrays(out, ["part", "doc_id", "in_part", "n_tokens", "ids"])


def read_ids(spark, path: str) -> DataFrame:
    """One row per document of the files under ``path``: key, ids of all documents before it, number of its ids, and the
    ids (little-endian unsigned 32-bit).

    Ids before a file are a running sum over one row per file.
    """
    chunks = spark.read.parquet(path)
    kind = chunks.schema["doc_ids"].dataType.elementType.simpleString()
    fields = f"part int, doc_id {kind}, in_part bigint, n_tokens bigint, ids binary"
    docs = chunks.select("part", "before", "doc_ids", "lengths", "words", "block_words", "escapes").mapInArrow(
        _documents, fields
    )
    ids = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)
    files = chunks.groupBy("part").agg(F.max(F.col("before") + ids).alias("held"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("ahead"))
    return docs.join(F.broadcast(files), "part").select(
        "doc_id", (F.col("ahead") + F.col("in_part")).alias("start"), "n_tokens", "ids"
    )


def op7(docs: DataFrame) -> DataFrame:
    """The contract of op7: writes the files to the shared scratch folder and sums up what it reads back."""
    path = scratch_path(docs.sparkSession, "simple8b")
    write_ids(docs, path)
    return read_ids(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

"""Tokenising, packing, files, sharding and the pipeline against brute force and exact round trips."""

import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import plain  # noqa: E402

from itemlens.llm import hilbert, minhash, packing, quality, secrets, simple8b, tokens, wu_manber  # noqa: E402
from itemlens.llm import queries as Q  # noqa: E402
from itemlens.llm import words as W  # noqa: E402

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def frame(spark):
    Q.ship(spark)
    return lambda rows, schema=SCHEMA: spark.createDataFrame(rows, schema).repartition(3)


def full_ids(name, text):
    ids = tokens.encoder(tokens.tokenizer_path(name)).tokenizer.encode(text or "", add_special_tokens=False).ids
    return [*ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunked_encoding_is_the_tokenizers_own(name):
    rng = random.Random(5)
    pieces = list("ab Zé\n.,'!*#\t\r×÷ß— 中文́1 ") + ["<|endoftext|>", " 's", " the", "Ünder", "é"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["", " ", "\n", " a", "a ", "  a  b ", "x" * 50_000, "a b " * 5000, " a b c"]
    enc = tokens.encoder(tokens.tokenizer_path(name))
    raw, offsets = W.utf8(pa.array(texts))
    ids, at = enc.encode(raw, offsets, None)
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, repr(t[:80])


def test_best_fill_is_optimal():
    rng = random.Random(3)
    for _ in range(200):
        sizes = [rng.randrange(1, 30) for _ in range(rng.randrange(1, 9))]
        counts = {s: sizes.count(s) for s in sizes}
        space = rng.randrange(1, 80)
        sums = {0}
        for s in sizes:
            sums |= {x + s for x in sums}
        chosen = packing.best_fill(sorted(counts, reverse=True), counts, space)
        assert sum(s * n for s, n in chosen) == max(x for x in sums if x <= space)
        assert all(n <= counts[s] for s, n in chosen)


def check_sequences(pieces, capacity):
    """pieces: (document, start, length, sequence, offset)."""
    by_doc, by_sequence = {}, {}
    for d, s, n, q, o in pieces:
        by_doc.setdefault(d, []).append((s, n))
        by_sequence.setdefault(q, []).append((o, n))
    for parts in by_sequence.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at and n > 0
            at += n
        assert at == capacity or at & (at - 1) == 0  # neither needs padding
    return by_doc


def test_pack_lengths_cuts_every_document_whole():
    rng = random.Random(1)
    sizes = [rng.choice([1, rng.randrange(1, 3000), 700, 2048, 9000]) for _ in range(800)]
    out = [(d, s, n, q, o) for q, seq in enumerate(packing.pack_lengths(sizes, 2048)) for (d, s, n), o in zip(seq, np.cumsum([0] + [x[2] for x in seq]))]
    by_doc = check_sequences(out, 2048)
    for d, n in enumerate(sizes):
        at = 0
        for s, k in sorted(by_doc[d]):
            assert s == at
            at += k
        assert at == n
    assert len({q for *_, q, _ in out}) <= sum(sizes) / 2048 + 12
    assert list(packing.pack_lengths([], 2048)) == []


def documents():
    rng = random.Random(8)
    rows = [(i * 7 % 401, " ".join(rng.choice(["the", "Ünder", "x9,", "quick\n"]) for _ in range(rng.choice([0, 3, 40, 900])))) for i in range(120)]
    return rows + [(9000, None), (9001, ""), (9002, "long " * 9000)]


def test_packing(frame):
    rows = documents()
    got = packing.op1(frame([(*r, "x") for r in rows], SCHEMA + ", start string")).collect()
    by_doc = check_sequences([(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in got], 2048)
    for doc, text in rows:
        ids, at = full_ids("byte_bpe_50k.json", text), 0
        for s, n in sorted(by_doc[doc]):
            piece = next(r for r in got if r.doc_id == doc and r.start == s)
            assert s == at and piece.doc_tokens == len(ids) and piece.ids_crc32 == crc(ids[s : s + n])
            at += n
        assert at == len(ids)
    assert packing.op1(frame([(None, "a"), (None, "a")])).count() == 2
    assert packing.op1(frame([])).count() == 0


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    cases = [[0] * 3000, [], [1], [2**60, 5, 2**64 - 1, 2**60 - 1] * 700, rng.integers(0, 50_000, 10_000)]
    cases.append(rng.integers(0, 3, 9000) * rng.integers(0, 2**40, 9000))
    for case in cases:
        v = np.array(case, dtype=np.uint64)
        words, blocks, escapes = simple8b.encode(v)
        assert (simple8b.decode(words, blocks, escapes, len(v)) == v).all()
        chunk = {"lengths": [len(v)], "words": words.tobytes(), "block_words": blocks, "escapes": escapes.tobytes()}
        for _ in range(10):
            lo, hi = sorted(rng.integers(0, len(v) + 1, 2).tolist())
            assert (simple8b.decode_range(chunk, lo, hi) == v[lo:hi]).all()


def test_simple8b_files(frame):
    rows = documents()
    got = sorted(map(tuple, simple8b.op7(frame([(*r, 1) for r in rows], SCHEMA + ", part int")).collect()))
    at, want = 0, []
    for doc, text in sorted(rows):
        ids = full_ids("word_bpe_49k.json", text)
        want.append((doc, at, len(ids), crc(ids)))
        at += len(ids)
    assert got == want
    twice = simple8b.op7(frame([(1, "b"), (1, "a"), (1, "a"), (None, "c")])).collect()
    assert sorted(r.start for r in twice) == [0, 2, 4, 6] and [r.start for r in twice if r.doc_id is None] == [0]
    assert simple8b.op7(frame([])).count() == 0


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 1), (1, 3)])
def test_hilbert_curve_steps_to_neighbours(spark, dims, bits):
    side = 1 << bits
    cells = spark.range(side**dims).select(*(((F.col("id") / side**k).cast("int") % side).cast("int").alias(f"c{k}") for k in range(dims)))
    rows = cells.select("*", hilbert.hilbert_index([F.col(f"c{k}") for k in range(dims)], bits).alias("at")).collect()
    rows.sort(key=lambda r: r["at"])
    assert [r["at"] for r in rows] == list(range(side**dims))
    for x, y in zip(rows, rows[1:]):
        assert sum(abs(a - b) for a, b in zip(tuple(x)[:-1], tuple(y)[:-1])) == 1


def test_sharding(frame):
    rng = random.Random(2)
    rows = []
    for i in range(333):  # a third of the rows is one source with one text
        hot = i % 3 == 0
        rows.append((i, "same" if hot else "é" * rng.randrange(400), "hot" if hot else rng.choice("abcdef"), rng.choice(["en", None]), i))
    rows += [(None, None, None, None, 0), (None, None, None, None, 0)]
    schema = SCHEMA + ", source string, lang string, shard int"
    got = hilbert.op4(frame(rows, schema)).collect()
    counts = {}
    for r in got:
        counts.setdefault(r.shard, []).append(r.slot)
    assert sorted(counts) == list(range(8)) and max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in counts.values())
    want = sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == want
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert hilbert.op4(frame([], schema)).count() == 0


def test_pipeline(spark, sf_small):
    import corpus_pipeline as P

    assert [name.split()[0] for name, _ in P.STAGES] == ["quality", "MinHash", "benchmark", "secret", "packing"]
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("labels", "benchmark"))
    good = {r.doc_id for r in quality.op8(docs, labels).where("kept").collect()}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.doc_id in good]
    rows = [r for r, g in zip(rows, plain.groups(rows)) if g[3]]
    items = [(r.item_id, r.text) for r in bench.collect()]
    rows = [r for r, c in zip(rows, plain.contamination(rows, items)) if not c[5]]
    clean = {}
    for doc, text in rows:
        found = plain.base_spans(text) + plain.entropy_spans(text, secrets.CLASSES, secrets.ALLOWED)
        clean[doc] = plain.redacted(text, found)
    got = P.run(spark, sf_small).collect()
    by_doc = check_sequences([(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in got], 2048)
    assert set(by_doc) == set(clean) and len(clean) > 50
    for r in got:
        ids = full_ids("byte_bpe_50k.json", clean[r.doc_id])
        assert r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[r.start : r.start + r.length])
    out = P.redact_secrets(spark, docs, sf_small)
    assert out.columns == docs.columns and out.where("n_chars <> char_length(text)").count() == 0


def test_pipeline_returns_the_sequences(spark, frame):
    import corpus_pipeline as P

    texts = {1: "a b c", 2: "", 3: "word " * 3000}
    got = P.STAGES[-1][1](spark, frame(list(texts.items())), "").collect()
    for doc, text in texts.items():
        ids = b"".join(bytes(r.ids) for r in sorted(got, key=lambda r: r.start) if r.doc_id == doc)
        assert np.frombuffer(ids, "<u4").tolist() == list(full_ids("byte_bpe_50k.json", text))
    assert all(len(r.ids) == 4 * r.length for r in got) and sum(r.length for r in got if r.sequence_id == got[0].sequence_id) <= 2048


def test_filters_keep_the_schema_of_documents(spark, frame):
    rows = frame([(1, "a b", "en", "s", 3, "x")], SCHEMA + ", lang string, source string, n_chars bigint, kept string")
    labels, bench = frame([], "doc_id long, quality int, toxic int"), frame([], "item_id long, text string")
    for out in (quality.keep_good(rows, labels), minhash.deduplicate(rows), wu_manber.decontaminate(rows, bench), secrets.redact(rows)):
        assert out.dtypes == rows.dtypes

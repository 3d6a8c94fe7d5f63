"""Piece ids, cross-tokenizer alignment and source divergences against brute force in plain Python."""

import hashlib
import os
import random
import re
import sys
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import plain  # noqa: E402

from itemlens.llm import alignment, divergence, pieces, tokens  # noqa: E402
from itemlens.llm import queries as Q  # noqa: E402
from itemlens.llm import words as W  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string"
PIECES = tokens.tokenizer_path("piece_bpe_32k.model")
ALPHABET = ["a", "b", " ", "  ", "\n", "é", "中", "\x00", "the", " Th", "1", "<s>", "ﬁ", "\U0001f600", "é", "\t", "<|endoftext|>"]


def odd_texts(n, seed=1, letters=(*ALPHABET, "▁", "▁▁", "<0x41>", "'s")):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(n)]
    return [*texts, "", " ", "▁", " ▁", "", "x" * 600 + " y", "ab" * 5000, None, "x", "x", "a ", "  lead"]


@pytest.fixture(scope="module")
def frame(spark):
    Q.ship(spark)
    return lambda rows, schema=SCHEMA: spark.createDataFrame(rows, schema).repartition(3)


def keyed(texts, langs=("en", "de", None), sources=("s1", "s2", "", None)):
    rng = random.Random(7)
    return [(i if i % 11 else None, t, rng.choice(langs), rng.choice(sources)) for i, t in enumerate(texts)]


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


# SentencePiece ids


def library(texts):
    model = pieces.pieces(PIECES).model
    ids = [model.encode(t or "") for t in texts]
    return ids, [model.decode(x) for x in ids]


def test_joined_words_are_the_librarys_ids_and_text(monkeypatch):
    model = pieces.Pieces(PIECES)
    assert model.cuts
    texts = odd_texts(4000)
    want, decoded = library(texts)
    for block, words, ids in ((7, 1 << 30, 1 << 30), (1 << 17, 50, 100)):  # cut decoding; a table that starts again
        monkeypatch.setattr(pieces, "DECODE_IDS", block)
        monkeypatch.setattr(pieces, "TABLE_WORDS", words)
        monkeypatch.setattr(pieces, "TABLE_IDS", ids)
        raw, offsets = W.utf8(pa.array(texts))
        for i, j in W.slices(offsets, 3000):
            got, at = model.encode(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            assert [got[a:b].tolist() for a, b in zip(at, at[1:])] == want[i:j]
            assert model.decode(got, at) == decoded[i:j]


def test_whole_texts_where_pieces_may_cross_markers():
    model = pieces.Pieces(PIECES)
    model.cuts = False
    texts = odd_texts(200)
    raw, offsets = W.utf8(pa.array(texts))
    got, at = model.encode(raw, offsets)
    want, decoded = library(texts)
    assert [got[a:b].tolist() for a, b in zip(at, at[1:])] == want
    assert model.decode(got, at) == decoded


def test_op13_against_the_library(frame):
    rows = keyed(odd_texts(150))
    rows += rows[:20]
    ids, decoded = library([r[1] for r in rows])
    want = Counter((r[0], len(x), plain.sha(",".join(map(str, x))), plain.sha(d)) for r, x, d in zip(rows, ids, decoded))
    assert rows_of(pieces.op13(frame(rows))) == want


def test_pieces_of_very_long_texts(frame):
    texts = ["word ünd 中 " * 150_000, "q" * 300_000, "a b\n" * 200_000]
    got = {r.doc_id: r for r in pieces.decode(pieces.encode(frame(list(enumerate(texts)), "doc_id long, text string"))).collect()}
    for i, t in enumerate(texts):
        assert got[i].decoded == t
        assert list(got[i].ids) == pieces.pieces(PIECES).model.encode(t)


def test_pieces_of_empty_tables_and_clashing_columns(frame):
    assert pieces.op13(frame([])).collect() == []
    wide = "doc_id string, text string, ids int, decoded string, n_tokens long"
    (row,) = pieces.op13(frame([("k", "a  b", 1, "z", 9)], wide)).collect()
    ids, decoded = library(["a  b"])
    assert tuple(row) == ("k", len(ids[0]), plain.sha(",".join(map(str, ids[0]))), plain.sha("a  b"))


# Alignment


def ranges(ids, entries):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(entries[i])))
        at = out[-1][1]
    return out


def aligned(text):
    """(a ids, b ids, groups as text, links as pairs of token numbers), all pairs of tokens compared."""
    al = alignment.aligner(*alignment._paths(None, None))
    a_bytes, b_bytes = al.a_table.to_pylist(), al.b_table.to_pylist()
    nothing = [], [], "", []
    if not text:
        return nothing
    whole = (" " + text).encode()
    a = al.a.tokenizer.encode(" " + text, add_special_tokens=False).ids
    b = al.b.model.encode(text)
    if b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
        return nothing
    ra, rb = ranges(a, a_bytes), ranges(b, b_bytes)
    links = [(i, j) for i, x in enumerate(ra) for j, y in enumerate(rb) if x[0] < y[1] and y[0] < x[1]]
    parts, low = [], 0
    for end in sorted({x[1] for x in ra} & {y[1] for y in rb}):
        parts.append("|".join(",".join(str(i) for i, x in zip(ids, r) if low < x[1] <= end) for ids, r in ((a, ra), (b, rb))))
        low = end
    return a, b, ";".join(parts), links


def op12_plain(rows):
    per = [aligned(r[1]) for r in rows]
    count = Counter((a[i], b[j]) for a, b, _, links in per for i, j in links)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    out = Counter()
    for r, (a, b, groups, links) in zip(rows, per):
        pairs = [(a[i], b[j]) for i, j in links]
        best = sum(count[p] == most[p[1]] for p in pairs)
        digest = plain.sha(groups) if a else ""
        out[r[0], len(a), len(b), groups.count(";") + 1 if a else 0, len(links), best, sum(count[p] for p in pairs), digest] += 1
    return out


def test_op12_against_all_pairs(frame):
    rows = keyed(odd_texts(250, 2, ALPHABET) + odd_texts(40, 3))
    rows += rows[:30]
    assert rows_of(alignment.op12(frame(rows))) == op12_plain(rows)


def test_small_blocks_give_the_same_counts(frame, monkeypatch):
    rows = keyed(odd_texts(120, 4, ALPHABET))
    want = op12_plain(rows)
    for block, once in ((300, 300), (2000, 300)):
        monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
        monkeypatch.setattr(alignment, "ALIGN_BYTES", once)
        blocks = alignment.blocks(frame(rows))
        assert blocks.count() > 4
        assert rows_of(alignment.op12(frame(rows))) == want
        counts = {(r.a_id, r.b_id): r.links for r in alignment.pair_counts(blocks).collect()}
        assert sum(counts.values()) == sum(k[4] * n for k, n in want.items())


def test_packed_numbers_round_trip():
    import numpy as np

    for x in ([], [0], [2**32 - 1, 5, 0], range(70_000)):
        assert alignment.unpack(alignment.pack(np.array(x, dtype=np.uint32))).tolist() == list(x)


def test_aligned_tokens_groups_and_links(frame):
    texts = odd_texts(60, 5)
    got = {r.doc_id: r for r in alignment.align(frame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        a, b, groups, links = aligned(t)
        r = got[i]
        assert (list(r.a_ids), list(r.b_ids)) == (a, b)
        assert sorted(zip(r.link_a, r.link_b)) == links
        written = [[], []]
        for side, ids, of in ((0, r.a_ids, r.a_group), (1, r.b_ids, r.b_group)):
            for x, g in zip(ids, of):
                written[side] += [[] for _ in range(g + 1 - len(written[side]))]
                written[side][g].append(str(x))
        assert ";".join("|".join(map(",".join, g)) for g in zip(*written)) == groups


def test_alignment_of_very_long_texts(frame):
    text = "A word, and ünother 12 " * 40_000
    (r,) = alignment.op12(frame([(1, text)], "doc_id long, text string")).collect()
    model = pieces.pieces(PIECES).model
    assert r.n_b == len(model.encode(text)) and r.n_links == r.n_a + r.n_b - r.n_groups


def test_alignment_of_empty_tables_and_clashing_columns(frame):
    assert alignment.op12(frame([])).collect() == []
    assert rows_of(alignment.op12(frame([(1, None, "", ""), (2, "a▁b", "", "")]))) == Counter(
        [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    )
    wide = "doc_id string, text string, links int, pairs string, block long, best int"
    got = alignment.op12(frame([("k", "ab cd", 1, "z", 9, 2)], wide))
    assert rows_of(got) == op12_plain([("k", "ab cd")])


# Divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergences(rows, least=10, top=10):
    docs = [(r[2] or "", r[3] or "", TERM.findall(plain.fold(r[1]))) for r in rows]
    out = Counter()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t, n in held.items() if n >= least]
        count = {s: Counter() for s in {d[1] for d in mine}}
        for _, s, words in mine:
            count[s].update(w for w in words if held[w] >= least)

        def shares(c):
            return {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}

        q = shares(sum(count.values(), Counter()))
        p = {s: shares(c) for s, c in count.items()}

        def f(x, y):
            return (x - y) ** 2 // (x + y)

        for s in count:
            pair = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in count if o != s)
            term = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if count[s][t] and p[s][t] > q[t])[:top]
            for part, found in (("pair", pair), ("term", term)):
                out.update((lang, s, part, item.decode(), -v, k) for k, (v, item) in enumerate(found, 1))
    return out


def prose(n, seed=3):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ba", "É", "Ka", "ö", "中", "x") for b in ("na", "TO", "ri", "ß", "q")]
    out = [" ,.1".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(n)]
    return [*out, None, "", "123 _ ~", "\n", "z" * 400]


@pytest.fixture()
def corpus():
    return keyed(prose(300))


def test_op11_against_plain_python(frame, corpus):
    want = divergences(corpus)
    assert any(k[2] == "term" and k[5] == 10 for k in want)
    assert rows_of(divergence.op11(frame(corpus))) == want


def test_spilled_stripes_add_up(corpus, spark, monkeypatch):
    monkeypatch.setattr(divergence, "TERMS", 5)
    monkeypatch.setattr(divergence, "FOLD_BYTES", 200)
    table = pa.RecordBatch.from_arrays(
        [pa.array([r[k] or "" for r in corpus]) for k in (2, 3, 1)], ["lang", "source", "text"]
    )
    docs, count = Counter(), Counter()
    spills = list(divergence._fold(iter([table])))
    assert len(spills) > 20
    for batch in spills:
        for r in batch.to_pylist():
            docs[r["lang"], r["term"]] += r["docs"]
            for s, n in zip(r["sources"], r["counts"]):
                count[r["lang"], r["term"], s] += n
    want_docs, want = Counter(), Counter()
    for _, text, lang, source in corpus:
        words = TERM.findall(plain.fold(text))
        want_docs.update((lang or "", t) for t in {*words, ""})
        want.update((lang or "", t, source or "") for t in words)
    assert docs == want_docs and +count == want


def test_tasks_share_the_work(frame, corpus, monkeypatch):
    monkeypatch.setattr(divergence, "TASK_WORK", 100)
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", 3)
    assert rows_of(divergence.op11(frame(corpus))) == divergences(corpus)


def test_merged_stripes(frame, corpus):
    got = {(r.lang, r.term): r for r in divergence.stripes(frame(corpus)).collect()}
    for lang in ("en", "de", ""):
        mine = [r for r in corpus if (r[2] or "") == lang]
        assert got[lang, ""].docs == len(mine)
        assert sorted(got[lang, ""].sources) == sorted({r[3] or "" for r in mine})
    words = Counter(t for r in corpus if r[2] == "en" for t in set(TERM.findall(plain.fold(r[1]))))
    assert {k[1]: r.docs for k, r in got.items() if k[0] == "en" and k[1]} == dict(words)


@pytest.mark.parametrize("block", [1, 2, 512])
def test_blocks_of_sources_give_the_same_rows(spark, corpus, monkeypatch, block):
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", block)
    totals, kept = [], []
    docs = [(r[2] or "", r[3] or "", Counter(TERM.findall(plain.fold(r[1])))) for r in corpus if r[2] == "en"]
    held = Counter(t for d in docs for t in d[2])
    names = sorted({d[1] for d in docs})
    sums = {s: Counter() for s in names}
    for _, s, c in docs:
        sums[s].update({t: n for t, n in c.items() if held[t] >= 10})
    terms = [t for t in held if held[t] >= 10]
    want = Counter({k[:5]: n for k, n in divergences([r for r in corpus if r[2] == "en"]).items()})
    for at in range(-(-len(names) // block)):
        totals.append((0, at, "en", None, names, [sum(sums[s].values()) for s in names], len(terms)))
        kept += [(0, at, "en", t, [s for s in names if sums[s][t]], [sums[s][t] for s in names if sums[s][t]], None) for t in terms]
    rows = sorted(totals + kept, key=lambda r: (r[0], r[1], r[3] is not None))
    fields = ["part", "block", "lang", "term", "sources", "counts", "kept"]
    batch = pa.RecordBatch.from_pylist([dict(zip(fields, r)) for r in rows])
    got = Counter(tuple(r.values()) for out in divergence._diverge(iter([batch])) for r in out.to_pylist())
    assert got == want


def test_languages_without_kept_terms_and_odd_tables(frame):
    assert divergence.op11(frame([])).collect() == []
    few = [(1, "a b", "en", "x"), (1, "a b", "en", "y"), (None, None, None, None)]
    assert rows_of(divergence.op11(frame(few))) == Counter([("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)])
    wide = "doc_id long, text string, lang string, source string, term string, docs int, part int, value long, rank int"
    rows = keyed(prose(60))
    got = divergence.op11(frame([(*r, "t", 1, 2, 3, 4) for r in rows], wide))
    assert rows_of(got) == divergences(rows)


def test_repeated_rows_and_long_texts_count(frame):
    rows = [(1, "Foo bar " * 200_000, "en", "x")] + [(1, "foo baz", "en", "y")] * 12
    assert rows_of(divergence.op11(frame(rows))) == divergences(rows)


def test_long_division_is_exact():
    import numpy as np

    rng = random.Random(9)
    for _ in range(2000):
        total = rng.randrange(3, rng.choice([50, 10**6, 8 * 10**15]))
        count = rng.randrange(0, total - 2)
        got = divergence.share(np.array([count], dtype=np.int64), total)
        assert got[0] == 1 + 10**9 * (count + 2) // total


def test_divergence_sql_agrees(frame, corpus, spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", corpus)
    got = con.execute(divergence.SQL).fetchall()
    assert Counter(got) == divergences(corpus)


def test_digest_of_groups_is_of_their_text():
    al = alignment.aligner(*alignment._paths(None, None))
    raw, offsets = W.utf8(pa.array(["", "Unbelievable thing", "", "x"]))
    digests = al.group_digests(al.align(raw, offsets))
    want = [aligned(t)[2] for t in ("", "Unbelievable thing", "", "x")]
    assert digests == [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in want]

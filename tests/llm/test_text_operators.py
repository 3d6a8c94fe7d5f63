"""Operators on texts against brute force, with null, empty, repeated, tied and clashing rows."""

import os
import random
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import plain  # noqa: E402
import pyarrow as pa  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from itemlens.llm import components, language, lempel_ziv, licenses, minhash, quality, secrets, wu_manber  # noqa: E402
from itemlens.llm import queries as Q  # noqa: E402

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def frame(spark):
    Q.ship(spark)

    def make(rows, schema=SCHEMA, parts=5):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def edge_rows(text):
    """Null and empty texts, a null key twice, and one row three times."""
    return [(9000, None), (9001, ""), (9002, " \n\t "), (None, text), (None, text), (9003, text), (9003, text)]


def test_repeated_spans(frame):
    rng = random.Random(2)
    base = [" ".join(rng.choice(["a", "b", "é"]) for _ in range(200)) for _ in range(3)]
    rows = []
    for i in range(150):  # every row shares a passage, so a third of all windows have few keys
        own = [" ".join(str(rng.randrange(50)) for _ in range(rng.randrange(30))) for _ in range(2)]
        words, at = rng.choice(base).split(), rng.randrange(150)
        rows.append((i, own[0] + "\n" + " ".join(words[at : at + rng.randrange(60)]) + "\t " + own[1]))
    rows += edge_rows(base[0]) + [(8000, "x " * 500), (8001, "y" * 100_000 + " z" * 40)]
    assert rows_of(lempel_ziv.op10(frame(rows))) == sorted(plain.repeats(rows, 35), key=str)
    for window, seed in ((5, 2), (1, 1)):
        got = lempel_ziv.repeated_spans(frame(rows), window=window, seed=seed).drop("row", "spans", "factors")
        assert rows_of(got) == sorted(plain.repeats(rows, window), key=str)


def test_factors_join_where_they_touch():
    import numpy as np

    at, ref = np.array([0, 1, 4, 10]), np.array([7, 7, 7, 7])
    got = lempel_ziv.factors(at, ref, np.array([5, 6, 9, 15]), 3)
    assert list(zip(*(x.tolist() for x in got))) == [(0, 4, 7, 5), (4, 7, 7, 9), (10, 13, 7, 15)]
    assert lempel_ziv.joined(*got[:2]) == [(0, 7), (10, 13)]
    none = np.zeros(0, dtype=np.int64)
    assert lempel_ziv.joined(*lempel_ziv.factors(none, none, none, 3)[:2]) == []


def factor_rows(seed):
    rng = random.Random(seed)
    base = [[str(rng.randrange(9)) for _ in range(60)] for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [rng.choice(base)[rng.randrange(40) :][: rng.randrange(30)] + [str(rng.randrange(1000))] for _ in range(4)]
        rows.append((i, " ".join(w for p in parts for w in p)))
    return rows + edge_rows(rows[0][1]) + [(8000, "x " * 300)]


def test_positions_go_to_texts_that_stay_in_place(frame, spark):
    docs = frame(factor_rows(6), parts=3)
    want = sorted((str(r.doc_id), r.n_removed, r.kept_sha256) for r in lempel_ziv.repeated_spans(docs, window=6, seed=3).collect())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lempel_ziv.repeated_spans(docs, window=6, seed=3)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert sorted((str(r.doc_id), r.n_removed, r.kept_sha256) for r in out.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    exchanged = [line for line in plan.splitlines() if "Exchange" in line]
    assert "Bucketed: true" in plan and not any("text" in line for line in exchanged)


def test_factors_against_a_plain_greedy_parser(frame):
    for window, seed in ((6, 3), (3, 1)):
        docs = frame(factor_rows(window), parts=1)  # one block, whose rows keep their order
        words = [(r.text or "").split() for r in docs.collect()]
        parsed = sorted(lempel_ziv.repeated_spans(docs, window=window, seed=seed).collect())
        place = [r.row for r in parsed]
        want = plain.greedy_factors(words, window)
        assert [[(f.first, f.last, place.index(f.ref), f.ref_first) for f in r.factors] for r in parsed] == want
        assert sum(map(len, want)) > 100


def test_factors_of_many_blocks_stand_at_their_references(frame, monkeypatch):
    rows = [(i, t) for i, (_, t) in enumerate(factor_rows(5))]
    texts = {i: (t or "").split() for i, t in rows}
    window = 6
    parsed = lempel_ziv.repeated_spans(frame(rows, parts=7), window=window, seed=3)
    found = {r.doc_id: [(s.first, s.last) for s in r.spans] for r in parsed.collect()}
    table = lempel_ziv.factor_table(parsed).collect()
    covered = {i: set() for i in texts}
    for f in table:
        own, other = texts[f.doc_id][f.first : f.last], texts[f.ref_id][f.ref_first :][: f.last - f.first]
        assert own == other and len(own) >= window and (f.doc_id, f.first) != (f.ref_id, f.ref_first)
        covered[f.doc_id] |= set(range(f.first, f.last))
    assert covered == {i: {w for s, e in found[i] for w in range(s, e)} for i in texts}
    assert any(f.ref_id != f.doc_id for f in table) and any(f.last - f.first > window for f in table)


def test_references_across_batches():
    rows = [(1, 1, 5, 0), (1, 1, 6, 1), (1, 1, 7, 2), (1, 2, 5, 3), (2, 2, 8, 4), (2, 2, 9, 5), (3, 0, 1, 6)]
    want = [(5, 0, 6, 1), (6, 1, 5, 0), (7, 2, 5, 0), (8, 4, 9, 5), (9, 5, 8, 4)]
    whole = pa.table({n: pa.array(c, k) for n, c, k in zip(
        ("low", "high", "row", "at"), zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int32()))})
    whole = whole.append_column("again", pa.array([False] * len(rows)))
    for size in (1, 2, 3, 7):
        got = [tuple(r.values()) for b in lempel_ziv._referred(iter(whole.to_batches(size))) for r in b.to_pylist()]
        assert sorted(got) == want


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(2)
    rows = []
    for _ in range(8):
        base = [rng.choice("abcdefghijklmnop") + str(rng.randrange(30)) for _ in range(rng.choice([3, 6, 40, 120]))]
        for _ in range(40):
            words = list(base)
            for _ in range(rng.randrange(6)):
                if rng.random() < 0.5:
                    words[rng.randrange(len(words))] = str(rng.randrange(99))
            rows.append((len(rows) * 3 % 1009, "\t".join(words).title() if rng.random() < 0.2 else " ".join(words)))
    return rows + edge_rows("x Y z") + edge_rows(rows[0][1])


def test_blocks_of_texts_take_little_memory():
    """What a worker holds follows from the block, however much text a batch has."""
    import tracemalloc

    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(4000)) for _ in range(400)]  # about 9 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts)], ["own", "text"])
    tracemalloc.start()
    rows = sum(b.num_rows for b in lempel_ziv._seed_rows(35, 20)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows > 100_000 and peak < 100e6, peak


def test_near_duplicates(frame, copies, monkeypatch):
    want = sorted(plain.groups(copies), key=str)
    assert rows_of(minhash.op9(frame(copies))) == want
    # Blocks of few nodes, and components by star steps, give the same groups.
    monkeypatch.setattr(minhash, "BLOCK_NODES", 7)
    monkeypatch.setattr(minhash, "BLOCK_SET_BYTES", 5000)
    monkeypatch.setattr(minhash, "CUT_NODES", 3)
    monkeypatch.setattr(minhash, "CUT_SET_BYTES", 1000)
    monkeypatch.setattr(components, "LOCAL_LINKS", 0)
    assert rows_of(minhash.op9(frame(copies))) == want


@pytest.mark.parametrize("most,unit", [(1, 1), (5, 2), (40, 3), (1000, 1), (1000, 1000)])
def test_blocks_bring_all_pairs_outside_the_main_component_together(frame, most, unit):
    import numpy as np

    rng = random.Random(6)
    rows = [(g, n, 0 if rng.random() < 0.6 else n % 7 + 1, 1) for g, size in ((1, 90), (2, 1), (3, 2), (4, 12)) for n in range(size)]
    rows += [(5, n, 0, 1) for n in range(30)]  # one component: nothing to do
    dealt = minhash._in_blocks(frame(rows, "key long, node long, component long, load int"), "key", most, unit)
    tasks, met = {}, set()
    for r in dealt.collect():
        tasks.setdefault((r.key, r.task), []).append(r)
    for (key, _), members in tasks.items():
        side = np.array([r.side for r in members])
        minor = np.array([r.component != r.main for r in members])
        for x, facing in minhash._facing(side, minor):
            met.update((key, *sorted((members[x].node, members[y].node))) for y in facing.tolist() if y != x)
    want = set()
    for key in {k for k, *_ in rows}:
        group = [(n, c) for k, n, c, _ in rows if k == key]
        sizes = {}
        for _, c in group:
            sizes[c] = sizes.get(c, 0) + 1
        main = max(sizes, key=lambda c: (sizes[c], c))
        if len(sizes) > 1:
            want |= {(key, min(a, b), max(a, b)) for a, c in group for b, d in group if a != b and (c != main or d != main)}
    assert met == want
    largest = max(map(len, tasks.values()))
    assert largest == 90 if unit == 1000 else largest < 60


def test_deduplicate_keeps_one_row_of_each_group(frame, copies):
    got = minhash.deduplicate(frame([(d, t, d, "s") for d, t in copies], SCHEMA + ", component_id long, gone_id string"))
    assert got.columns == ["doc_id", "text", "component_id", "gone_id"]
    want = {(d, t) for (d, t), g in zip(copies, plain.groups(copies)) if g[3]}
    assert sorted(((r[0], r[1]) for r in got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("operator,expected", [(minhash.op9, plain.groups), (lempel_ziv.op10, lambda r: plain.repeats(r, 35))])
def test_rows_that_share_a_key_cost_no_more(frame, operator, expected):
    rng = random.Random(12)
    bases = [[str(rng.randrange(10**6)) for _ in range(80)] for _ in range(50)]
    texts = [" ".join(rng.choice(bases)[: 40 + rng.randrange(40)] + [str(rng.randrange(99))] * 5) for _ in range(2000)]
    took = []
    for key in (lambda i: i, lambda i: None, lambda i: None if i % 3 else 7):
        rows = [(key(i), t) for i, t in enumerate(texts)]
        start = time.monotonic()
        got = operator(frame(rows)).collect()
        took.append(time.monotonic() - start)
        assert sorted(map(tuple, got), key=str) == sorted(expected(rows), key=str)
    assert max(took[1:]) < 2 * took[0] + 5


def test_repeated_spans_with_clashing_columns(frame):
    rows = [(1, "a " * 60, 5, "s"), (None, "b c", 6, None)]
    got = lempel_ziv.op10(frame(rows, SCHEMA + ", own long, seeds string"))
    assert rows_of(got) == sorted(plain.repeats([r[:2] for r in rows], 35), key=str)


def test_odd_sketch_estimates_distance():
    import numpy as np

    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 62, (50, 160)).astype(np.uint64)
    b = a.copy()
    b[:, :40] += np.uint64(1)  # three quarters agree
    apart = np.bitwise_count((minhash.odd_sketch(a, 512) ^ minhash.odd_sketch(b, 512)).view(np.uint64)).sum(axis=1)
    assert abs(apart.mean() - minhash.most_bits(0.75, 160, 512)) < 4
    assert (apart < minhash.most_bits(0.55, 160, 512)).all()


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_decontamination(frame, block_bytes):
    rng = random.Random(3)
    voc = ["a", "b", "É", "c1", "d"]
    items = [(i, " ".join(rng.choice(voc) for _ in range(rng.choice([0, 1, 3, 5, 10, 11, 14])))) for i in range(30)]
    items += [(30, None), (None, "a b"), (7, items[7][1])]
    rows = []
    for i in range(200):
        words = (rng.choice(voc) if rng.random() < 0.7 else rng.choice(voc).swapcase() for _ in range(rng.randrange(40)))
        rows.append((i, "-".join(words)))
    rows += edge_rows("zz " + (items[5][1] or "")) + [(8000, "a.b " * 3000)]
    bench = frame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    found = wu_manber.find_passages(frame(rows), bench, block_bytes=block_bytes)
    want = plain.contamination(rows, items)
    got = [
        (r.doc_id, r.n_words, sum(h["last"] - h["first"] for h in r.hits), len(r.items), plain.sha(",".join(r.items)), bool(r.hits))
        for r in found.collect()
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    if block_bytes > 1000:
        assert rows_of(wu_manber.op5(frame(rows), bench)) == sorted(want, key=str)
    clean = wu_manber.decontaminate(frame([(*r, 1) for r in rows], SCHEMA + ", hits int"), bench, block_bytes=block_bytes)
    assert clean.columns == ["doc_id", "text", "hits"]
    assert sorted((r[0] for r in clean.collect()), key=str) == sorted((w[0] for w in want if not w[5]), key=str)


def secret_rows():
    rng, al = random.Random(4), "abcdefABC0123xyzXYZ+/_-= "

    def assign():
        key = rng.choice(["password", "ToKen", "api_key", "APIKEY", "secret"])
        value = "".join(rng.choice(al[:-1]) for _ in range(rng.randrange(20)))
        return key + rng.choice(["", "'", '"']) + rng.choice(["", "  "]) + rng.choice(":=") + rng.choice(["", " '"]) + value

    rows = []
    for i in range(200):
        parts = []
        for _ in range(rng.randrange(8)):
            parts.append(
                rng.choice(
                    [
                        assign(),
                        "AKIA" + "".join(rng.choice("ABC019") for _ in range(rng.randrange(20))),
                        "".join(rng.choice("0123456789abcdef") for _ in range(rng.randrange(50))),
                        "é😀 wörd\n",
                        "".join(rng.choice(al[:-2]) for _ in range(rng.randrange(90))),
                        "a" * 24 + "1" + "a" * 13,
                        "one_two/three-four_five9",
                        "123e4567-e89b-12d3-a456-426614174000",
                    ]
                )
            )
        rows.append((i, rng.choice(["", " ", "é"]).join(parts)))
    return rows + edge_rows(assign() + "0123456789abcd") + [(8000, "ab " * 20_000 + "f" * 40)]


def test_secrets(frame):
    rows, names = secret_rows(), secrets.KINDS

    def spans(text):
        return plain.base_spans(text), plain.entropy_spans(text, secrets.CLASSES, secrets.ALLOWED)

    def written(found):
        return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(found))

    want = []
    for doc, text in rows:
        base, more = spans(text or "")
        count = [sum(k == kind for _, k, _ in base) for kind in range(3)]
        want.append((doc, *count, plain.sha(written(base)), written(base + more)))
    assert rows_of(secrets.op2(frame(rows))) == sorted(want, key=str)
    assert sum("entropy" in w[5] for w in want) > 20

    got = secrets.redact(frame([(*r, "x") for r in rows], SCHEMA + ", hit_id string"))
    assert got.columns == ["doc_id", "text", "hit_id"]
    clean = [(d, t if t is None else plain.redacted(t, sum(spans(t), [])), "x") for d, t in rows]
    assert rows_of(got) == sorted(clean, key=str)


def test_secrets_in_very_long_candidates(frame):
    rng, n = random.Random(8), 2_000_000
    base64 = "ABCDEFGHIKLMNOPQRSTUVWXYZabcdefghiklmnopqrstuvwxyz0123456789+/"
    texts = ["ab/" * (n // 3), "ab1_" * (n // 4), "ab1_" * (n // 4) + "!", "x" * n, "a-" * (n // 2), "ab/cd-" * 2000 + "é" + "z" * n]
    rows = list(enumerate(texts)) + [(len(texts), "".join(rng.choice(base64) for _ in range(20_000)))]
    got = {r.doc_id: r.spans for r in secrets.op2(frame(rows)).collect()}
    assert [got[i] for i in range(len(texts))] == [""] * len(texts)
    want = plain.entropy_spans(rows[-1][1], secrets.CLASSES, secrets.ALLOWED)
    assert got[len(texts)] == ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(want)) != ""
    clean = {r.doc_id: r.text for r in secrets.redact(frame(rows)).collect()}
    assert [clean[i] for i in range(len(texts))] == texts and len(clean[len(texts)]) < 2000


def test_examples_hide_no_key_beside_them(frame):
    key = "9fK2mQ7xL0pR4tZ8vB1nC6wY3sD5gH"
    rows = [(1, f"/srv/example/{key}"), (2, "x_example_abcdefghij0123456789ABCDEFGHIJ"), (3, f"of {key}"), (4, key + "EXAMPLE")]
    got = {r.doc_id: r.spans for r in secrets.op2(frame(rows)).collect()}
    assert got[1].startswith("entropy_base64:") and got[1].endswith(f":{len(rows[0][1])}") and got[2] == got[4] == "" and got[3] != ""


def quality_rows(seed=9):
    rng = random.Random(seed)
    text = lambda a, n: " ".join(f"{a if rng.random() < 0.7 else 'w'}{int(rng.random() ** 2 * 60)}" for _ in range(n))
    rows = [(i, text("w", rng.randrange(40, 90))) for i in range(150)] + [(500 + i, text("j", 70)) for i in range(60)]
    rows += edge_rows(text("w", 60)) + [(8000, "w1 w2 " * 3000), (8001, "one")]
    labels = [(i, 1, 0) for i in range(0, 100)] + [(500 + i, 0, 0) for i in range(30)] + [(3, 0, 0), (4, 1, 1), (None, 1, 0)]
    return rows, labels


def test_quality_scores_and_verdicts_against_plain_counts(frame, spark):
    from pyspark.sql import functions as F

    rows, labels = quality_rows()
    labels = frame(labels, "doc_id long, quality int, toxic int")
    buckets = {}

    def hashed(values):  # Spark's own hash, asked value by value
        new = [v for v in set(values) if v not in buckets]
        if new:
            kind = "w string" if isinstance(new[0], str) else "a long, b long"
            df = spark.createDataFrame([(v,) if isinstance(v, str) else v for v in new], kind)
            buckets.update(zip(new, (r[0] for r in df.select(F.xxhash64(*df.columns)).collect())))
        return [buckets[v] for v in values]

    words = [plain.WORD.findall(t or "") for _, t in rows]
    hashed([w for ws in words for w in ws])
    single = [[buckets[w] for w in ws] for ws in words]
    hashed([p for ws in single for p in zip(ws, ws[1:])])
    grams = [[h % quality.BUCKETS for h in ws + [buckets[p] for p in zip(ws, ws[1:])]] for ws in single]
    part = {r.trusted: r.part for r in quality.trusted_keys(labels).collect()}
    assert set(part) == set(range(100)) - {3, 4} and set(part.values()) == {0, 1}
    score = plain.likelihood_ratios(grams, [part.get(doc) == 0 for doc, _ in rows], quality.BUCKETS, quality.SMOOTHING)
    judged = quality.judge(frame(rows), labels)
    cut = None
    got = {}
    for r in judged.collect():
        got.setdefault(r.doc_id, []).append(r)
    base = [plain.base_quality(*r)[-1] for r in rows]
    side = {k: sorted(s for (doc, _), s, b in zip(rows, score, base) if not b and s is not None and doc in keys)
            for k, keys in (("good", {d for d, p in part.items() if p == 1}), ("bad", set(range(500, 530))))}
    lost = [quality.FALSE_REJECTS + (1 - quality.FALSE_REJECTS) * i / quality.STEPS for i in range(quality.STEPS + 1)]
    at = lambda v, q: plain.quantile(v, q)
    cut = plain.best_cut([at(side["good"], q) for q in lost], [at(side["bad"], i / quality.STEPS) for i in range(quality.STEPS + 1)],
                         len(side["bad"]), lost, quality.GOOD_WEIGHT, quality.BAD_PRIOR)
    assert sum(s is not None and s < cut for s in score) > 40
    for (doc, _), s, failed in zip(rows, score, base):
        for r in got[doc]:
            assert r.base_failed == failed
            assert (r.score is None) == (s is None) and (s is None or abs(r.score - s) < 1e-9)
            if s is None or abs(s - cut) > 1e-9:
                assert r.kept == (not failed and (s is None or s >= cut))


def test_quality_shuffles_the_targets_texts_only(spark):
    from pyspark.sql import functions as F

    docs = spark.range(2000).select(F.when(F.col("id") % 50 > 0, F.col("id") % 1990).alias("doc_id"), F.lit("some words").alias("text"))
    labels = spark.range(0, 400, 2).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    trusted = quality.trusted_keys(labels)
    target = {r.trusted for r in trusted.where("part = 0").collect()}
    want = sorted(r.doc_id for r in docs.collect() if r.doc_id in target)
    assert 50 < len(target) < 150 and len(want) > len(set(want))
    for words in (1, 4, 1 << 10):  # the smallest filter holds nearly every key
        got = quality.target_documents(docs, trusted, words)
        assert sorted(r.doc_id for r in got.collect()) == want
    narrow = quality.target_documents(docs.withColumn("doc_id", F.col("doc_id").cast("int")), trusted)
    assert sorted(r.doc_id for r in narrow.collect()) == want
    passed = docs.where("doc_id IS NOT NULL").withColumn("bits", quality.key_filter(trusted.where("part = 0"), "trusted").scalar())
    word, bit = quality._spot("doc_id", quality.FILTER_WORDS)
    assert len(want) <= passed.where(F.getbit(F.get("bits", word), bit) == 1).count() <= len(want) + 5
    plan = quality.target_documents(docs, trusted)._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("SortMergeJoin"):].split("Exchange hashpartitioning(doc_id")[1]
    assert "getbit" in side.lower().split("exchange")[0]  # below the shuffle of the texts


def test_quality_uses_every_label(spark):
    rows = spark.range(70_000).select(F.col("id").alias("doc_id"), (F.col("id") < 45_000).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    parts = {r.part: r["count"] for r in quality.trusted_keys(rows).groupBy("part").count().collect()}
    assert sum(parts.values()) == 45_000 and min(parts.values()) > 20_000
    assert quality.bad_keys(rows).count() == 25_000


def test_quality_quantiles_are_percentiles(spark):
    rng = random.Random(4)
    values = spark.createDataFrame([(rng.choice([rng.gauss(0, 1), 0.5]),) for _ in range(997)] + [(None,)], "score double")
    shares = [0.002, 0.25, 0.5, 0.9991, 1.0]
    got, n = quality.quantiles(values, shares)
    assert n == 997 and got == values.agg(F.percentile("score", F.array(*map(F.lit, shares)))).first()[0]
    assert quality.quantiles(values.limit(0), shares) == ([], 0)


def test_quality_base_rules(frame):
    rng = random.Random(1)
    voc = ["a", "b", "é😀", "#", "x|y", "\n", "\t", "\x0b"]
    rows = [(i, " ".join(rng.choice(voc) for _ in range(rng.randrange(90)))) for i in range(150)]
    rows += edge_rows("a b c a b c a b c") + [(8000, "w " * 30_000)]
    want = sorted((plain.base_quality(*r) for r in rows), key=str)
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    labels = frame([(i, i % 2, 0) for i in range(50)] + [(None, None, None)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        got = quality.op8(frame(rows), known)
        assert rows_of(got.select(cols)) == want
        assert all(not r.kept for r in got.collect() if r.base_failed)
    assert all(r.kept for r in quality.op8(frame(rows), labels.limit(0)).collect() if not r.base_failed)
    kept = quality.keep_good(frame([(*r, True) for r in rows], SCHEMA + ", kept boolean"), labels)
    assert kept.columns == ["doc_id", "text", "kept"]


def test_quality_rejects_what_the_target_lacks(frame):
    rng = random.Random(6)
    good = [(i, " ".join(f"w{int(rng.random() ** 2 * 300)}" for _ in range(120))) for i in range(600)]
    junk = [(1000 + i, " ".join(f"j{int(rng.random() ** 2 * 300)}!!" for _ in range(120))) for i in range(100)]
    labels = frame([(i, 1, 0) for i in range(0, 600, 2)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality.op8(frame(good + junk), labels).where("kept").collect()}
    assert not any(i >= 1000 for i in kept)
    assert len(kept) >= 590


def test_quality_withstands_wrong_labels(frame):
    rng = random.Random(7)
    text = lambda a, share: " ".join(f"{a if rng.random() < share else 'w'}{int(rng.random() ** 2 * 300)}" for _ in range(120))
    good = [(i, text("w", 1)) for i in range(600)]
    junk = [(1000 + i, text("j", 0.3 + 0.7 * rng.random())) for i in range(200)]
    wrong = set(range(1000, 1010))  # junk labelled as good, and good labelled as junk
    labels = [(i, 1, 0) for i in range(0, 600, 2)] + [(i, int(i in wrong), 0) for i in range(1000, 1100)] + [(i, 0, 0) for i in (1, 3)]
    labels = frame(labels, "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality.op8(frame(good + junk), labels).where("kept").collect()}
    assert sum(i >= 1000 for i in kept) <= 4
    assert len(kept) >= 590


def test_language(frame):
    rng = random.Random(5)
    syllables = {"aa": ["tha", "ing", "er", "ou"], "bb": ["che", "ung", "ich", "sch"], "cc": ["çã", "ñe", "los", "ría"]}
    rows = []
    for i in range(600):
        lang = rng.choice(list(syllables))
        words = ("".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(60))
        rows.append((i, " ".join(words).upper() if i % 10 == 0 else " ".join(words), lang))
    odd = [(9000, None, "aa"), (9001, "", "aa"), (9002, "12 +- 3", None), (None, "tha ing", None)]
    got = language.op3(frame(rows + odd, SCHEMA + ", lang string"))
    truth = {r[0]: r[2] for r in rows}
    found = {r.doc_id: r for r in got.collect()}
    held = [r for r in found.values() if r.held_out and r.doc_id in truth]
    assert 100 < len(held) < 200
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert {found[k].lang_pred for k in (9000, 9001, 9002)} == {"und"} and found[None].lang_pred in syllables
    assert all(0 <= r.score <= 1 for r in found.values())
    unlabelled = language.op3(frame([(1, "abc", None)], SCHEMA + ", lang string")).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]


def language_rows():
    rng = random.Random(15)
    letters = {"aa": "etaoin", "bb": "enisra", "zh": "的一是不了在人有我他", "long": "xyzwvu"}
    rows = []
    for i in range(160):
        lang = rng.choice(list(letters))
        size = 30_000 if lang == "long" else rng.randrange(1, 900)
        gap = 0.03 if lang == "zh" else 0.2  # one script has no spaces but at sentence ends
        rows.append((i, "".join(" " if rng.random() < gap else rng.choice(letters[lang]) for _ in range(size)), lang))
    rows += [(700 + i, "only one text here", "single") for i in range(1)] + [(800 + i, "q" * 5, None) for i in range(3)]
    rows += [(d, t, "aa") for d, t in edge_rows("tea eat oat")] + [(8000, "neon " * 40_000, "aa"), (900, "aa bb", "tie1"), (900, "aa bb", "tie2")]
    return rows


def test_language_sizes_and_choice_against_plain_python(frame):
    import zlib

    rows = language_rows()
    held = [d is not None and zlib.crc32(str(d).encode()) % 4 == 2 for d, _, _ in rows]
    contents = plain.dictionaries([r[1:] for r, h in zip(rows, held) if not h], 64 << 10)
    docs = frame([(*r, 1, "s") for r in rows], SCHEMA + ", lang string, held_out int, lang_pred string")
    known = "lang is not null and text is not null and not coalesce(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, false)"
    from pyspark.sql import functions as F

    assert language.learned(docs, F.expr(known)) == contents and {"zh", "long", "single"} <= set(contents)
    assert len(contents["zh"]) > 2000
    got = sorted(language.op3(docs).collect(), key=str)
    want = sorted(((d, h, *plain.language(t, contents)) for (d, t, _), h in zip(rows, held)), key=str)
    assert [tuple(g)[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g.score - w[3]) < 1e-9 for g, w in zip(got, want))
    # Random words of a few letters tell nothing between "aa" and "bb"; long texts and those without spaces are learned.
    truth = {d: lang for d, _, lang in rows if d is not None and d < 160}
    assert {g.lang_pred for g in got if truth.get(g.doc_id) == "long"} == {"long"}
    assert {g.lang_pred for g in got if truth.get(g.doc_id) == "zh"} == {"zh"}


def test_many_languages_share_the_dictionary_bytes(frame, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(language, "TOTAL_BYTES", 600 * 100)
    rows = [(i, f"word{chr(97 + i % 26)}{chr(97 + i % 23)} shared " * 3, f"l{i:03d}") for i in range(600) for _ in range(2)]
    got = language.learned(frame(rows, SCHEMA + ", lang string"), F.lit(True))
    assert len(got) == 600 and max(map(len, got.values())) <= 100 and min(map(len, got.values())) > 5


def test_licenses(frame):
    mit = (
        "Copyright (c) 2020 Someone\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and files. The above copyright notice and this permission notice shall be included in all copies. THE "
        'SOFTWARE IS PROVIDED "AS IS", without warranty. In no event shall the authors be liable for any claim.\n'
    )
    rows = [
        (1, mit + "Released under the MIT Licence. All rights reserved."),
        (2, "Text. Licensed under the Apache License, Version 2.0.\nMore text"),
        (3, "# This work is licensed under the GNU General Public License, version 3.\nLicensed under CC BY-NC 4.0."),
        (4, "Licensed under the Foo License."),
        (4, "Licensed under the Foo License."),
        (None, "nothing known; a hash acc0de"),
        (5, None),
        (6, ""),
    ]
    got = rows_of(licenses.op6(frame(rows)).select("doc_id", "licenses", "has_unknown"))
    want = [
        (1, "MIT,all-rights-reserved", False),
        (2, "Apache-2.0", False),
        (3, "CC-BY-NC,GPL-3.0", False),
        (4, "", True),
        (4, "", True),
        (None, "", False),
        (5, "", False),
        (6, "", False),
    ]
    assert got == sorted(want, key=str)


MIT_TEXT = """MIT License

Copyright (c) 2021 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD_TEXT = """Copyright (c) 2021, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS) HOWEVER CAUSED.
"""
GPL_TEXT = """Copyright (C) 2021  Jane Doe

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
APACHE_TEXT = """Copyright 2021 Jane Doe

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""


def test_wrapped_licenses(frame):
    bsd2 = BSD_TEXT[: BSD_TEXT.index("3. ")] + BSD_TEXT[BSD_TEXT.index("THIS SOFTWARE") :]
    known = [
        (MIT_TEXT, "MIT,copyright-notice"),
        (BSD_TEXT, "BSD-3-Clause,all-rights-reserved"),
        (bsd2, "BSD-2-Clause,all-rights-reserved"),
        (GPL_TEXT, "GPL-3.0,copyright-notice"),
        (APACHE_TEXT, "Apache-2.0,copyright-notice"),
        ("Prose before it\nCopyright 2021 X\n" + MIT_TEXT[MIT_TEXT.index("Permission") :], "MIT,copyright-notice"),
        ("A title\nLicensed under the MIT License\nCopyright 2021 X\nAll rights reserved", "MIT,all-rights-reserved"),
        ("Licensed under the Apache License,\nVersion 2.0", "Apache-2.0"),
        ("This work is released under the creative\ncommons zero waiver", "CC0-1.0"),
        ("Available under\nthe MIT License\n\nMore", "MIT"),
    ]
    rows, want = [], {}
    for sign in ("", "# ", " * ", "// ", "-- ", ";; ", "    "):
        for end in ("\n", "\r\n"):
            for text, names in known:
                want[len(rows)] = (names, False)
                rows.append((len(rows), "".join((sign + x).rstrip() + end for x in text.splitlines())))
    assert {r.doc_id: (r.licenses, r.has_unknown) for r in licenses.op6(frame(rows)).collect()} == want


def test_windows_of_items_without_an_id_hit(frame):
    text = "a b c d e f g h i j"
    rows = [(1, f"x {text} y"), (2, "x y")]
    bench = frame([(None, text)], "item_id long, text string")
    got = rows_of(wu_manber.op5(frame(rows), bench))
    assert got == [(1, 12, 10, 0, plain.sha(""), True), (2, 2, 0, 0, plain.sha(""), False)]
    assert [r.doc_id for r in wu_manber.decontaminate(frame(rows), bench).collect()] == [2]


LICENSE_WORDS = (
    "licensed under|released under|the terms of|the|this|gnu general public license|gnu gpl|gpl|3|2|2.0|lgpl|agpl|license|"
    "apache license version 2.0|mozilla public license|redistribute it|available|distributed|in no event shall|be liable|x|"
    "creative commons|cc by|cc0|attribution-noncommercial|all rights reserved|copyright|bsd license|the mit license|subject to|"
    "you should have received a copy of the gnu|general public license|distributed in the hope that it will be useful|"
    "neither the name of|may be used to endorse or promote products|redistributions of source code must retain|under|"
    "permission is hereby granted free of charge to any person obtaining a copy of this software"
).split("|")


def greedy(pattern, joined):
    """The same sentence by a plain pattern, as the published rule reads."""
    if not joined:
        return f"^(?:{pattern})$"
    start = "^" if pattern.startswith((".*", "(.* )?")) else "(?:^|\\n)"
    return f"(?s){start}(?:{pattern.replace('[ -]', '[_-]').replace(' ', '[_]').replace('_', ' \\n')})$"


def test_linear_patterns_know_the_same_sentences():
    import re

    rng = random.Random(10)
    seen = set()
    lines = [[" ".join(rng.choice(LICENSE_WORDS) for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 4))] for _ in range(3000)]
    for name, pattern in licenses.SENTENCES:
        alone, over = dict(licenses.ALONE)[name], dict(licenses.JOINED + licenses.JOINED_LAST)[name]
        for own in lines:
            known = bool(re.search(greedy(pattern, False), own[0]))
            assert bool(re.search(alone, own[0])) == known, (name, own[0])
            body = "\n".join(own)
            assert bool(re.search(over, body)) == bool(re.search(greedy(pattern, True), body)), (name, body)
            seen |= {name} if known else set()
    assert len(seen) >= 18


@pytest.mark.parametrize("text", [
    "licensed " * 300_000, "licensed under the gnu gpl " * 100_000, "released under " * 150_000 + "x", "the x\nthis y\n" * 100_000 + "license",
    "copyright" + " " * 2_000_000 + "x", "license" + "-" * 2_000_000 + "x", "in no event shall\n" * 100_000, "license\n" + " \t" * 1_000_000 + "x",
    "licensed under the mozilla public license " * 50_000,
], ids=range(9))
def test_long_sentences_take_linear_time(frame, text):
    import time

    start = time.time()
    rows = licenses.op6(frame([(1, text)])).collect()
    assert len(rows) == 1 and time.time() - start < 30


def test_licenses_with_clashing_columns(frame):
    rows = [(1, MIT_TEXT, 5, "q", "z"), (1, MIT_TEXT, 5, "q", "z"), (None, None, None, None, None)]
    got = licenses.op6(frame(rows, SCHEMA + ", rest int, sentences string, hit_0 string"))
    assert [(r.doc_id, r.licenses) for r in got.orderBy("doc_id").collect()] == [(None, ""), (1, "MIT,copyright-notice"), (1, "MIT,copyright-notice")]


def test_empty_tables(frame):
    none = frame([], SCHEMA + ", lang string, source string")
    labels = frame([], "doc_id long, quality int, toxic int")
    bench = frame([], "item_id long, text string")
    for got in (
        secrets.op2(none),
        language.op3(none),
        wu_manber.op5(none, bench),
        licenses.op6(none),
        quality.op8(none, labels),
        minhash.op9(none),
        lempel_ziv.op10(none),
    ):
        assert got.count() == 0
    assert [r.contaminated for r in wu_manber.op5(frame([(1, "a b")]), bench).collect()] == [False]


def test_native_paths_have_no_python(frame):
    rows = frame([(1, "a b", "en", "s")], SCHEMA + ", lang string, source string")
    labels = frame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    from itemlens.llm import hilbert

    for df in (secrets.op2(rows), secrets.redact(rows), licenses.op6(rows), quality.op8(rows, labels), hilbert.op4(rows)):
        plan = df._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "MapInArrow", "Pandas", "CartesianProduct"))


def test_oracles_agree(spark, sf_small):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    for name, sql in Q.SQL.items():
        res = con.execute(sql)
        df = Q.QUERIES[name](spark, sf_small)
        assert df.columns == [d[0] for d in res.description], name
        assert rows_of(df) == sorted(res.fetchall(), key=str), name


def test_arrow_views_of_texts():
    import numpy as np

    from itemlens.llm import words as W

    raw, offsets = W.utf8(pa.array(["x", None, "aé b", ""]).slice(1))
    assert raw.tobytes().decode() == "aé b" and offsets.tolist() == [0, 0, 5, 5]
    starts, ends, first = W.spans(raw, offsets, W.SPACE_WORDS)
    assert [raw[s:e].tobytes().decode() for s, e in zip(starts, ends)] == ["aé", "b"] and first.tolist() == [0, 0, 2, 2]
    long = np.frombuffer(b"q" * (3 << 20) + b" q", np.uint8)  # a word longer than a segment
    starts, ends, _ = W.spans(long, np.array([0, len(long)]), W.SPACE_WORDS)
    h = W.word_hashes(long, starts, ends)
    assert len(h) == 2 and h[1] == W.word_hashes(np.frombuffer(b"q", np.uint8), np.array([0]), np.array([1]))[0]

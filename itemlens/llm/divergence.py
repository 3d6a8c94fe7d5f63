"""Audit of how far the sources of a language differ in their use of words, by in-mapper stripes.

Folding. Every task folds whole documents into a table of stripes, one per (language, term): the term's document frequency
and its occurrences per source. Distinct terms are found per group of texts (Arrow's dictionary encoding) and merged into the
task's table by hash; a table beyond ``TERMS`` terms or ``ENTRIES`` entries is emitted ("spilled") and starts again. The stripes
are shuffled once, by (language, term), and merged there: adding up is associative, so any number of spills gives the same
sums. A term that every document holds costs one row per spill, not one per occurrence.

Divergences. Kept stripes (document frequency of ``MIN_DOCS`` or more) are dealt by term over tasks; behind a copy of
the totals (one row per language: its sources, their counts, the number of kept terms) each task turns its stripes
into shares and adds up a matrix of sources by sources, and its leading terms per source. Matrices and leaders are small and
merged by key. The number of tasks follows from the work (kept terms times pairs of sources, ``TASK_WORK`` for each), not
from the number of partitions, so matrices stay few. The totals are as long as a language's list of sources, whose square is
the result's length; matrices are cut into blocks of ``SOURCE_BLOCK`` sources, so a task holds at most that many rows of one.

Shares are whole numbers, p = 1 + floor(SCALE * (count + 2) / (N + 2 V)), found by long division in steps of 1000, so that
nothing overflows below 9e15 counted words; a term's divergence is floor((p - q)**2 / (p + q)).

Null texts, languages and sources are read as ''. Texts without terms still make their (language, source) group occur. Null and
repeated keys are not read: each row is a document. Ties go by the item's UTF-8 bytes. A language without kept terms has
divergences 0 between its sources; an empty table gives no rows; other columns are not read, so their names can't clash. A
term of any length is a term.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemlens.llm import words as W
from itemlens.llm.oracles import FOLD
from itemlens.session import write_scratch_table

#: Bounds of a task's table of stripes: distinct terms, and (term, language, source) entries.
TERMS = 400_000
ENTRIES = 3_000_000
#: Text folded at once.
FOLD_BYTES = 4 << 20
#: Rows of a matrix of sources that one task adds up, cells handled at once, and divergences that one task works out.
SOURCE_BLOCK = 512
CELLS = 1 << 20
TASK_WORK = 1 << 26

# Documents that keep a term, leading terms per group, scale of the shares, added count, and the bytes of terms.
MIN_DOCS = 10
TOP_TERMS = 10
SCALE_STEPS = 3  # of 1000 each: 1,000,000,000
ADDED = 2
LETTERS = W.table_of(bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
PATTERN = "[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

STRIPE = "lang string, term string, docs bigint, sources array<string>, counts array<bigint>"


class Stripes:
    """A task's table: per (term, group) entry the documents and occurrences, groups being (language, source) pairs."""

    def __init__(self) -> None:
        self.terms: dict[bytes, int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self._clear()

    def _clear(self) -> None:
        self.terms.clear()
        self.terms[b""] = 0  # no text holds it: its stripe counts the documents of each group
        self.groups.clear()
        self.key = np.zeros(0, np.int64)
        self.docs = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def full(self) -> bool:
        return len(self.terms) > TERMS or self.held > ENTRIES or len(self.groups) >= 1 << 20

    def fold(self, raw: np.ndarray, offsets: np.ndarray, groups: np.ndarray) -> None:
        """Adds rows of text; ``groups`` has each row's group."""
        rows = len(offsets) - 1
        starts, ends, first = W.spans(raw, offsets, LETTERS)
        size = ends - starts
        bounds = np.concatenate([[0], np.cumsum(size)])
        letters = W.LOWER[raw[LETTERS[raw]]]
        wide = pa.py_buffer(bounds.astype(np.int64))
        table = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, wide, pa.py_buffer(letters)]).dictionary_encode()
        known = self.terms
        term = np.fromiter(
            (known.setdefault(t, len(known)) for t in table.dictionary.to_pylist()), np.int64, len(table.dictionary)
        )
        row = np.repeat(np.arange(rows), np.diff(first))
        width = max(1, len(term))
        in_doc, n = np.unique(row * np.int64(width) + table.indices.to_numpy(zero_copy_only=False), return_counts=True)
        key = term[in_doc % width] << 20 | groups[in_doc // width] if len(in_doc) else in_doc
        self._wait(np.concatenate([key, groups]), np.concatenate([np.ones(len(key), np.int64), np.ones(rows, np.int64)]), np.concatenate([n, np.zeros(rows, np.int64)]))

    def _wait(self, key: np.ndarray, docs: np.ndarray, count: np.ndarray) -> None:
        self.waiting.append(_added(key, docs, count))
        self.held += len(self.waiting[-1][0])
        if self.held > 2 * len(self.key) + (1 << 18):
            self._merge()

    def _merge(self) -> None:
        parts = [(self.key, self.docs, self.count), *self.waiting]
        self.key, self.docs, self.count = _added(*(np.concatenate(x) for x in zip(*parts)))
        self.waiting, self.held = [], len(self.key)

    def spill(self) -> Iterator[pa.RecordBatch]:
        """The stripes, and an empty table."""
        self._merge()
        if len(self.key):
            names = list(self.groups)
            langs = sorted({x for x, _ in names})
            lang_of = np.array([langs.index(x) for x, _ in names])
            group, term = self.key & ((1 << 20) - 1), self.key >> 20
            stripe = term * len(langs) + lang_of[group]
            order = np.argsort(stripe, kind="stable")
            stripe, group = stripe[order], group[order]
            cut = np.concatenate([[0], np.flatnonzero(np.diff(stripe)) + 1])
            bounds = pa.array(np.append(cut, len(stripe)).astype(np.int32))
            lang = pa.array(langs, pa.string()).take(pa.array(stripe[cut] % len(langs)))
            word = pa.array(list(self.terms), pa.binary()).take(pa.array(stripe[cut] // len(langs))).cast(pa.string())
            docs = pa.array(np.add.reduceat(self.docs[order], cut))
            sources = pa.array([x for _, x in names], pa.string()).take(pa.array(group))
            out = [
                lang,
                word,
                docs,
                pa.ListArray.from_arrays(bounds, sources),
                pa.ListArray.from_arrays(bounds, pa.array(self.count[order])),
            ]
            whole = pa.RecordBatch.from_arrays(out, ["lang", "term", "docs", "sources", "counts"])
            for at in range(0, whole.num_rows, 20_000):
                yield whole.slice(at, 20_000)
        self._clear()


def _added(key: np.ndarray, docs: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of ``docs`` and ``count`` per distinct key, keys ascending."""
    if not len(key):
        return key, docs, count
    order = np.argsort(key, kind="stable")
    key = key[order]
    cut = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
    return key[cut], np.add.reduceat(docs[order], cut), np.add.reduceat(count[order], cut)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = Stripes()
    for batch in batches:
        raw, offsets = W.utf8(batch.column(2))
        for i, j in W.slices(offsets, FOLD_BYTES):
            pairs = zip(batch.column(0).slice(i, j - i).to_pylist(), batch.column(1).slice(i, j - i).to_pylist())
            groups = np.fromiter((table.groups.setdefault(p, len(table.groups)) for p in pairs), np.int64, j - i)
            table.fold(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], groups)
            if table.full():
                yield from table.spill()
    yield from table.spill()


def stripes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Merged stripes: lang, term, docs (documents of the language that hold it) and its occurrences per source.

    The term '' counts documents only: its sources are all that occur in the language. One shuffle, of spilled stripes.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang_col), ("source", source_col), ("text", text_col))))
    spilled = rows.mapInArrow(_fold, STRIPE)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Both groupings keep the partitioning by (lang, term).
    dealt = spilled.repartition(parts, "lang", "term")
    each = dealt.withColumn("e", F.explode(F.arrays_zip("sources", "counts"))).select(
        "lang", "term", F.col("e.sources").alias("source"), F.col("e.counts").alias("n"),
        F.when(F.col("e.sources") == F.element_at("sources", 1), F.col("docs")).otherwise(0).alias("docs"),
    )
    merged = each.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = merged.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("e"))
    return whole.select("lang", "term", "docs", F.col("e.source").alias("sources"), F.col("e.n").alias("counts"))


def share(count: np.ndarray, total) -> np.ndarray:
    """1 + floor(SCALE * (count + ADDED) / total) by long division; ``total`` holds ADDED for each kept term."""
    left, out = count + ADDED, np.zeros(np.broadcast(count, total).shape, dtype=np.int64)
    for _ in range(SCALE_STEPS):
        left = left * 1000
        out = out * 1000 + left // total
        left = left % total
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class _Totals:
    """A language's sources, sums over kept terms, and the part of a matrix that this task adds up."""

    def __init__(self, sources: list[str], sums: list[int], kept: int, block: int):
        self.sources, self.kept = sources, kept
        self.at = {s: i for i, s in enumerate(sources)}
        sums = np.array(sums, dtype=np.int64)
        self.total = np.maximum(1, sums + ADDED * kept)
        self.whole = max(1, int(sums.sum()) + ADDED * kept)
        self.rows = np.arange(len(sources))[block * SOURCE_BLOCK : (block + 1) * SOURCE_BLOCK]
        self.matrix = np.zeros((len(self.rows), len(sources)), dtype=np.int64)
        self.top: list[list[tuple[int, bytes]]] = [[] for _ in self.rows]

    def add(self, terms: list[str], counts: np.ndarray) -> None:
        """Adds stripes: ``counts`` has a row per term, a column per source."""
        p = share(counts, self.total[None, :])
        q = share(counts.sum(axis=1), self.whole)
        for k, s in enumerate(self.rows.tolist()):
            mine = p[:, s]
            self.matrix[k] += divergence(mine[:, None], p).sum(axis=0)
            over = np.flatnonzero((counts[:, s] > 0) & (mine > q))
            if len(over):
                f = divergence(mine[over], q[over])
                if len(over) > TOP_TERMS:  # all that reach the tenth value, ties included
                    reach = np.partition(f, -TOP_TERMS)[-TOP_TERMS]
                    over, f = over[f >= reach], f[f >= reach]
                found = [(-v, terms[i].encode()) for v, i in zip(f.tolist(), over.tolist())]
                self.top[k] = sorted(self.top[k] + found)[:TOP_TERMS]


_OUT = ["lang", "source", "part", "item", "value"]


def _diverge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, _Totals] = {}
    task, used = None, set()

    def close() -> Iterator[pa.RecordBatch]:
        for lang, t in totals.items():
            if lang not in used and task[0]:
                continue
            names, n = pa.array(t.sources, pa.string()), len(t.sources)
            for k, s in enumerate(t.rows.tolist()):
                other = np.flatnonzero(np.arange(n) != s)
                cols = [names.take(pa.array(other)), pa.array(t.matrix[k][other])]
                yield _rows(lang, t.sources[s], "pair", *cols)
                if t.top[k]:
                    items = pa.array([w.decode() for _, w in t.top[k]], pa.string())
                    yield _rows(lang, t.sources[s], "term", items, pa.array([-v for v, _ in t.top[k]], pa.int64()))

    for batch in batches:
        data = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        part, block = (data[n].to_numpy(zero_copy_only=False) for n in ("part", "block"))
        langs = np.array(data["lang"].to_pylist(), dtype=object)
        named = data["term"].is_valid().to_numpy(zero_copy_only=False)
        change = (part[1:] != part[:-1]) | (block[1:] != block[:-1]) | (langs[1:] != langs[:-1]) | ~named[1:] | ~named[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(change) + 1, [batch.num_rows]]) if batch.num_rows else []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            here = (int(part[lo]), int(block[lo]))
            if here != task:
                yield from close()
                totals, task, used = {}, here, set()
            lang = langs[lo]
            if not named[lo]:
                one = batch.slice(lo, 1).to_pylist()[0]
                totals[lang] = _Totals(one["sources"], one["counts"], one["kept"], here[1])
                continue
            t = totals[lang]
            used.add(lang)
            step = max(1, CELLS // max(1, len(t.sources)))
            for at in range(lo, hi, step):
                rows = batch.slice(at, min(step, hi - at))
                sources, counts = rows.column(rows.schema.get_field_index("sources")), rows.column(rows.schema.get_field_index("counts"))
                coded = sources.flatten().dictionary_encode()
                place = np.array([t.at[s] for s in coded.dictionary.to_pylist()], dtype=np.int64)
                dense = np.zeros((rows.num_rows, len(t.sources)), dtype=np.int64)
                term = np.repeat(np.arange(rows.num_rows), np.diff(sources.offsets.to_numpy()))
                dense[term, place[coded.indices.to_numpy(zero_copy_only=False)]] = counts.flatten().to_numpy(zero_copy_only=False)
                t.add(rows.column(rows.schema.get_field_index("term")).to_pylist(), dense)
    if task is not None:
        yield from close()


def _rows(lang: str, source: str, part: str, items: pa.Array, values: pa.Array) -> pa.RecordBatch:
    same = [pa.array([x] * len(items), pa.string()) for x in (lang, source, part)]
    return pa.RecordBatch.from_arrays([*same, items, values], _OUT)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Divergences of every group (lang, source): ``pair`` against each other source, ``term`` its leading terms against
    the language; ranked per group and part by value, then item."""
    spark = docs.sparkSession
    made = stripes(docs, text_col, lang_col, source_col).where((F.col("docs") >= MIN_DOCS) | (F.col("term") == ""))
    held = write_scratch_table(spark, made, "stripes")
    kept = held.where(F.col("term") != "")
    # Sums per group over kept terms; groups without any come from the stripes of ''.
    each = held.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    sums = each.groupBy("lang", F.col("e.sources").alias("source")).agg(F.sum("e.counts").alias("n"))
    sums = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("e"))
    number = held.groupBy("lang").agg(F.count(F.when(F.col("term") != "", 1)).alias("kept"))
    totals = sums.join(number, "lang").select(
        "lang", F.col("e.source").alias("sources"), F.col("e.n").alias("counts"), "kept"
    )
    totals = write_scratch_table(spark, totals, "totals")
    wide = F.size("sources").cast("double")
    work = F.sum(F.col("kept") * wide * F.least(wide, F.lit(float(SOURCE_BLOCK))))
    most, work = totals.agg(F.max(F.size("sources")), work).first()
    blocks = F.explode(F.sequence(F.lit(0), F.lit((max(1, most or 0) - 1) // SOURCE_BLOCK))).alias("block")
    parts = max(1, math.ceil((work or 0) / TASK_WORK))
    columns = ["part", "block", "lang", "term", "sources", "counts", "kept"]
    head = totals.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "*").select("*", blocks)
    head = head.withColumn("term", F.lit(None).cast("string")).select(columns)
    tail = kept.select(F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int").alias("part"), "*", blocks)
    tail = tail.withColumn("kept", F.lit(None).cast("bigint")).select(columns)
    dealt = head.unionByName(tail).repartition(parts, "part", "block")
    # Totals first: they have no term; then stripes, language by language.
    dealt = dealt.sortWithinPartitions("part", "block", F.col("term").isNotNull(), "lang")
    found = dealt.mapInArrow(_diverge, "lang string, source string, part string, item string, value bigint")
    # A task's matrix cells add up; a term is in one task, so its value stays.
    found = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= TOP_TERMS))


def op11(docs: DataFrame) -> DataFrame:
    """The contract of op11: all ranks of the pairs, the first ten terms."""
    return audit(docs).select("lang", "source", "part", "item", "value", "rank")


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all({FOLD.format("coalesce(text, '')")}, '{PATTERN}') AS ws FROM documents),
w AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c, 0) AS c,
  1 + (1000000000::HUGEINT * (coalesce(c, 0) + {ADDED})) // (n + 2 * v)::HUGEINT AS p
  FROM g JOIN kept USING (lang) JOIN v USING (lang) JOIN n USING (lang, source) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c) + {ADDED})::HUGEINT) // (sum(sum(c)) OVER (PARTITION BY lang) + 2 * any_value(v))::HUGEINT AS q
  FROM c JOIN v USING (lang) GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
joined AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM joined)
WHERE part = 'pair' OR rank <= {TOP_TERMS}"""

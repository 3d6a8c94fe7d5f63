"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Every word and every pair of neighbouring words falls into one of ``BUCKETS`` hash buckets. Two multinomials are counted:
the raw one over all documents, the target one over trusted documents. A document's score is the mean over its n-grams of
log(target share / raw share), so long and short texts compare. Documents below the threshold are rejected. It comes from
documents that the target was not counted on and that pass the base rules, trusted ones and ones labelled bad: of the
trusted scores' quantiles from ``FALSE_REJECTS`` up, the one with most bad documents below it, less ``GOOD_WEIGHT`` times
the trusted share that it gives up. A few wrong labels on either side lower all these differences alike and don't move the
cut. Without documents labelled bad it is the ``FALSE_REJECTS`` quantile alone.

All labelled rows are used: a bit of a hash of the key deals every trusted document to the target or to the threshold, and all
documents labelled bad go to the threshold. Labels meet scores in a join by key. For the target, a filter of key hashes drops
other documents in the scan, so of the texts only the target's, and few others, are shuffled for the join by key; raw counts
need no labels. The quantiles are read off a distributed sort of
the labelled scores, so the driver gets a few rows per quantile. Raw counts, scores and verdicts cover every document. A document
is scored inside its row: its n-grams look their ratios up in one array of ``BUCKETS`` numbers, and no n-gram is shuffled for it.
Without trusted documents nothing is rejected by the score.

The base rules (word characters, symbols, repeated lines, words in repeated 3-word windows) are array functions per
document: equal 3-word windows are neighbours after sorting (hash, position), so a text of n words costs n log n. The
whole path is DataFrame functions.

Null and empty texts have no words and fail the base rule; null keys, repeated rows and repeated keys are documents of
their own; an empty table gives no rows; only the key and the text are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemlens.operators.topk import global_rank
from itemlens.session import write_scratch_table

BUCKETS = 1 << 16
#: 64-bit words of the filter of the target's keys, 2 MB whatever the input; more keys let more other texts through to the join.
FILTER_WORDS = 1 << 18
#: Added to every bucket's count.
SMOOTHING = 1.0
#: Share of unseen trusted documents that the threshold gives up at least.
FALSE_REJECTS = 0.002
#: What a share of trusted documents lost counts against the same share of bad ones kept.
GOOD_WEIGHT = 2.0
#: Added to the number of bad documents, so that a few labels don't cost many good documents.
BAD_PRIOR = 10
#: Quantiles of the labelled scores that the threshold is chosen from.
STEPS = 1000

# Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\u000b\f\r"
SEPARATOR = "[\\x20\\x09-\\x0D]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATOR), "")


def _part(values: str, start: int, less: int) -> Column:
    """The array from element ``start`` (0 is the first), ``less`` elements shorter."""
    return F.slice(F.col(values), F.lit(1 + start), F.greatest(F.size(values) - less, F.lit(0)))


def _joint(x: Column, y: Column) -> Column:
    """Hashes of the pairs of two arrays of equal length."""
    return F.zip_with(x, y, lambda a, b: F.xxhash64(a, b))


def _hashed(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``words``, the 64-bit hashes of the words in order, and ``pairs``, those of neighbouring words."""
    out = docs.withColumn("words", F.transform(_words(F.coalesce(text, F.lit(""))), lambda w: F.xxhash64(w)))
    return out.withColumn("pairs", _joint(_part("words", 0, 1), _part("words", 1, 1)))


def _bucket(ngram: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.col(ngram), F.lit(buckets)).cast("int")


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``words`` and ``pairs`` (hashes), ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words``."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    out = _hashed(docs, text).withColumn("lines", lines)
    out = out.withColumn("windows", _joint(_part("pairs", 0, 1), _part("words", 2, 2)))
    many = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("placed", F.when(many, placed))
    twins = F.zip_with(
        _part("placed", 0, 1),
        _part("placed", 1, 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array()),
    )
    out = out.withColumn("twice", F.array_sort(F.array_distinct(F.flatten(twins))))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "twice", start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"))
    )
    return out.select(
        *docs.columns,
        "words",
        "pairs",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.translate(body, WHITE, "")).cast("bigint").alias("word_chars"),
        (F.char_length(body) - F.char_length(F.translate(body, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered["n"], F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def trusted_keys(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(trusted, part) of all labelled keys of quality and without toxicity; part 0 is the target's, part 1 the threshold's."""
    good = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("trusted"))
    good = good.agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).where("q = 1 and t = 0")
    return good.select("trusted", F.pmod(F.shiftright(F.xxhash64("trusted"), 7), F.lit(2)).alias("part"))


def bad_keys(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(trusted, part) of all keys labelled without quality only; part is 2."""
    bad = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("trusted")).agg(F.max("quality").alias("q")).where("q = 0")
    return bad.select("trusted", F.lit(2).cast("bigint").alias("part"))


def quantiles(values: DataFrame, shares: list[float]) -> tuple[list[float], int]:
    """The quantiles of the column ``score`` at ``shares``, interpolated as by ``percentile``, and the number of its values.

    Values are ranked by a distributed sort; only those at the wanted ranks, two for a share, come to the driver.
    """
    ranked = global_rank(values.where("score IS NOT NULL").select("score", F.monotonically_increasing_id().alias("tie")), ["score", "tie"])
    n = ranked.count()
    if not n:
        return [], 0
    at = [(n - 1) * p for p in shares]
    ranks = sorted({int(f(h)) + 1 for h in at for f in (np.floor, np.ceil)})
    wanted = F.broadcast(values.sparkSession.createDataFrame([(r,) for r in ranks], "rank bigint"))  # two rows for a share
    found = {r.rank: r.score for r in ranked.join(wanted, "rank").select("rank", "score").collect()}

    def between(h: float) -> float:
        low, high = int(np.floor(h)), int(np.ceil(h))
        a, b = found[low + 1], found[high + 1]
        return a if a == b else (high - h) * a + (h - low) * b

    return [between(h) for h in at], n


def best_cut(good: list[float], bad: list[float], n_bad: int, lost: list[float]) -> float:
    """Of ``good``, the quantiles of trusted scores at the shares ``lost``, the one that best parts them from ``bad``, evenly
    spaced quantiles of ``n_bad`` bad scores."""
    below = np.searchsorted(np.array(bad), np.array(good), "left") / len(bad) * n_bad / (n_bad + BAD_PRIOR)
    return good[int(np.argmax(below - GOOD_WEIGHT * np.array(lost)))]


def threshold(scored: DataFrame, known: DataFrame, failed: Column, false_rejects: float) -> float | None:
    """The score below which documents are rejected; ``known`` has the keys of labelled documents, part 1 trusted, part 2 bad."""
    held = scored.withColumn("failed", failed).join(known, F.col("doc_id") == F.col("trusted")).select("part", "failed", "score")
    held = write_scratch_table(scored.sparkSession, held, "labelled")
    lost = [false_rejects + (1 - false_rejects) * i / STEPS for i in range(STEPS + 1)]
    side = lambda part: held.where((F.col("part") == part) & ~F.col("failed"))
    good, _ = quantiles(side(1), lost)
    bad, n_bad = quantiles(side(2), [i / STEPS for i in range(STEPS + 1)])
    if good and bad:
        return best_cut(good, bad, n_bad, lost)
    alone, _ = quantiles(held.where("part = 1"), [false_rejects])
    return alone[0] if alone else None


def _spot(key: str, words: int) -> tuple[Column, Column]:
    """The word and the bit of a key in a filter of ``words`` words; a hash of its own, apart from the bit that deals the keys."""
    h = F.xxhash64(F.col(key), F.lit(1))
    return F.pmod(F.shiftrightunsigned(h, 6), F.lit(words)).cast("int"), F.pmod(h, F.lit(64)).cast("int")


def key_filter(keys: DataFrame, key: str, words: int = FILTER_WORDS) -> DataFrame:
    """One row: the bits of all keys as one array of the fixed length ``words``. It holds every key's bit, and others' by chance."""
    word, bit = _spot(key, words)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))
    held = keys.select(word.alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or(one).alias("bits"))
    return _in_order(held, "at", "bits", F.lit(0).cast("bigint"), words)


def target_documents(docs: DataFrame, trusted: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) whose key is trusted, part 0. The filter drops nearly all others where they are read,
    so only these texts are shuffled; the join by key decides."""
    target = trusted.where("part = 0")
    rows = docs.where(F.col("doc_id").isNotNull())
    if docs.schema["doc_id"].dataType == trusted.schema["trusted"].dataType:  # else equal keys may have unequal hashes
        word, bit = _spot("doc_id", words)
        rows = rows.withColumn("bits", key_filter(target, "trusted", words).scalar())
        rows = rows.where(F.getbit(F.get("bits", word), bit) == 1).select("doc_id", "text")
    return rows.join(target.hint("merge"), F.col("doc_id") == F.col("trusted")).select("doc_id", "text")


def fit(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame | None:
    """(bucket, ratio) for every bucket that occurs in ``docs`` (doc_id, text); None without a target."""
    number = lambda n, name: F.lit(n).cast("bigint").alias(name)
    rows = docs.select("text", number(1, "raw"), number(0, "good"))
    rows = rows.unionAll(target_documents(docs, trusted).select("text", number(0, "raw"), number(1, "good")))
    # With explode, Spark filters on the size of the array first and hashes every text twice.
    seen = _hashed(rows, "text").select("raw", "good", F.explode_outer(F.concat("words", "pairs")).alias("ngram"))
    seen = seen.where(F.col("ngram").isNotNull())
    counts = seen.groupBy(_bucket("ngram", buckets).alias("bucket")).agg(F.sum("raw").alias("raw"), F.sum("good").alias("target"))
    counts = write_scratch_table(docs.sparkSession, counts, "ngrams")
    raw, target = counts.agg(F.sum("raw"), F.sum("target")).first()
    if not target:
        return None
    spread = smoothing * buckets
    ratio = F.log((F.col("target") + smoothing) / F.lit(target + spread)) - F.log((F.col("raw") + smoothing) / F.lit(raw + spread))
    return counts.select("bucket", ratio.alias("ratio"))


def _in_order(rows: DataFrame, at: str, value: str, missing: Column, n: int) -> DataFrame:
    """One row: the values at 0 to n - 1 as one array of the fixed length ``n``, ``missing`` where ``rows`` has none."""
    every = rows.sparkSession.range(n).select(F.col("id").cast("int").alias(at)).join(rows, at, "left")
    each = F.struct(F.col(at).alias("at"), F.coalesce(value, missing).alias("value"))
    return every.agg(F.array_sort(F.collect_list(each)).alias("all")).select(F.col("all.value").alias("values"))


def ratio_array(model: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: the ratios of ``fit`` in the order of the buckets, as one array of the fixed length ``buckets``; 0 for a bucket
    that no document has."""
    return _in_order(model, "bucket", "ratio", F.lit(0.0), buckets)


def _score(ratios: str, buckets: int = BUCKETS) -> Column:
    """Mean ratio of a row's ``words`` and ``pairs``; null without any."""
    n = F.size("words") + F.size("pairs")
    add = lambda a, h: a + F.get(F.col(ratios), F.pmod(h, F.lit(buckets)).cast("int"))
    total = F.aggregate("pairs", F.aggregate("words", F.lit(0.0), add), add)
    return F.when(n > 0, total / n)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_rejects: float = FALSE_REJECTS) -> DataFrame:
    """One row per document: its key as ``doc_id``, ``row`` (its number), ``text_hash``, the base rules' figures, ``base_failed``,
    ``score`` (null without words or trusted documents) and ``kept``."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    trusted = write_scratch_table(docs.sparkSession, trusted_keys(labels), "trusted")
    model = fit(own, trusted)
    facts = ["doc_id", "row", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    own = own.withColumn("row", F.monotonically_increasing_id()).withColumn("text_hash", F.xxhash64("text"))
    rows = base_rules(own)
    if model is None:
        scored = rows.select(*facts, F.lit(None).cast("double").alias("score"))
    else:
        rows = rows.withColumn("ratios", ratio_array(model).scalar())
        scored = rows.select(*facts, _score("ratios").alias("score"))
    scored = write_scratch_table(docs.sparkSession, scored, "scores")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    limit = threshold(scored, trusted.where("part = 1").union(bad_keys(labels)), failed, false_rejects) if model is not None else None
    good = F.lit(True) if limit is None else F.coalesce(F.col("score") >= F.lit(limit), F.lit(True))
    return scored.select(*facts, failed.alias("base_failed"), "score", (~failed & good).alias("kept"))


def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract of op8."""
    return judge(docs, labels).drop("row", "text_hash")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns."""
    judged = judge(docs, labels, id_col, text_col)
    names = [f"c{i}" for i in range(len(docs.columns))]
    key, text = (F.col(names[docs.columns.index(c)]) for c in (id_col, text_col))
    bad = judged.where("not kept").select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_text")).distinct()
    same = key.eqNullSafe(F.col("bad_id")) & (F.xxhash64(text.cast("string")) == F.col("bad_text"))
    return docs.toDF(*names).join(bad, same, "left_anti").toDF(*docs.columns)

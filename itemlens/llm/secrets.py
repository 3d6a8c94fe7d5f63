"""Secret scan: key patterns, and sliding-window Shannon entropy over candidate strings.

Three base kinds are patterns (``assign``, ``access``, ``hex``). Two more come from entropy: for each character class,
candidates are the runs of its characters of at least a window's length. A window slides over the candidate; the counts
of its characters change by the one that enters and the one that leaves, and with them the sum of n log2 n that gives the
window's entropy. Windows at or above the class's threshold that overlap or touch make one span. Candidates on the allow
list (plain words, identifiers in words, UUIDs, digests of package locks) give none, and spans that are no longer than a
window beside counting sequences and examples are dropped.

Everything is DataFrame functions. A text's matches and the gaps between them come from extracting and splitting by the
same pattern, so offsets (code points, end exclusive) are running sums over them. Only kinds, lengths and candidates are
shuffled, no texts. All patterns run in loops over single characters, so a candidate or text of any length is matched in
linear time and constant stack.

Null texts are empty; null keys, repeated rows and repeated keys are documents of their own; an empty table gives no rows;
other columns aren't read by ``scan`` and stay in ``redact``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The base kinds in their order, and their patterns.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_LENGTH = 12
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"


@dataclass(frozen=True)
class CharacterClass:
    """Candidates of one class: runs of ``alphabet``'s characters; windows of ``window`` of them need ``bits``."""

    kind: str
    pattern: str
    alphabet: str
    window: int
    bits: float


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharacterClass("entropy_hex", "[0-9A-Fa-f]", _DIGITS + "abcdefABCDEF", 24, 3.0),
    CharacterClass("entropy_base64", "[A-Za-z0-9+/_-]", _DIGITS + _LOWER + _LOWER.upper() + "+/_-", 20, 3.75),
)
KINDS = (*BASE_KINDS, *(c.kind for c in CLASSES))

#: Candidates that match one of these are no secrets. Repeated groups are possessive: the matcher then runs through a candidate
#: of any length in a loop, where a greedy group would take a call per repetition. Nothing is given up by it, as a separator
#: ends each repetition.
ALLOWED = (
    "[A-Za-z_-]+",  # words
    "[0-9_-]+",  # numbers
    "[a-z]+[0-9]{1,4}",  # a word with a number
    "(?:[A-Za-z]++[0-9]{0,3}+[_/-])++[A-Za-z]*[0-9]{0,3}",  # identifiers and paths made of words
    "[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",  # UUIDs
    "sha(1|256|384|512)-.*",  # digests of package locks
)
#: A span that holds the first is the example of some manual. The second are no part of a secret: a span needs a window's
#: length of characters in a row beside them, so a key that follows an example's path in the same candidate stays.
EXAMPLE = "EXAMPLE"
COUNTING = "example|0123456789|1234567890|abcdefghij|ABCDEFGHIJ"


def _found(text: Column, kind: int, pattern: str, length: int = 0) -> Column:
    """(kind, gap before the match, its length, whether it counts, its text) for every match of a pattern, in order."""
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    counts = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if length else matches
    each = F.zip_with(
        F.arrays_zip(matches.alias("m"), counts.alias("c")),
        F.slice(gaps, F.lit(1), F.size(matches)),
        lambda m, gap: F.struct(
            F.lit(kind).alias("kind"),
            F.char_length(gap).cast("bigint").alias("gap"),
            F.char_length(m["m"]).cast("bigint").alias("length"),
            (F.char_length(m["c"]) >= length).alias("counts"),
            (m["m"] if kind >= len(BASE_KINDS) else F.lit(None).cast("string")).alias("text"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,gap:bigint,length:bigint,counts:boolean,text:string>>")
    return F.when(text.rlike(pattern), each).otherwise(none)


def high_entropy(candidate: Column, c: CharacterClass) -> Column:
    """Spans (first, last exclusive; from 0) of a candidate whose windows reach the class's entropy."""
    size, w = len(c.alphabet), c.window
    codes = F.transform(F.array_remove(F.split(candidate, ""), ""), lambda x: F.position(x, F.lit(c.alphabet)) - 1)

    def weight(n: Column) -> Column:
        return F.when(n > 1, n * F.log2(n)).otherwise(F.lit(0.0))

    def step(a: Column, x: Column) -> Column:
        enters, leaves = x["enters"], x["leaves"]
        n_in, n_out = F.get(a["counts"], enters), F.get(a["counts"], leaves)
        change = weight(n_in + 1) - weight(n_in)
        change = change + F.when(leaves.isNotNull(), weight(n_out - 1) - weight(n_out)).otherwise(F.lit(0.0))
        total = a["sum"] + F.when(enters.eqNullSafe(leaves), F.lit(0.0)).otherwise(change)
        counts = F.transform(
            a["counts"], lambda n, k: n + (k == enters).cast("int") - F.coalesce((k == leaves).cast("int"), F.lit(0))
        )
        end = x["at"] + 1
        high = (end >= w) & (F.lit(math.log2(w)) - total / w >= c.bits - 1e-9)
        joins = high & (end - w <= a["last"])
        closes = high & ~joins & (a["last"] > a["first"])
        done = F.when(closes, F.concat(a["done"], F.array(F.struct(a["first"].alias("first"), a["last"].alias("last")))))
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            F.when(high & ~joins, end - w).otherwise(a["first"]).alias("first"),
            F.when(high, end).otherwise(a["last"]).alias("last"),
            done.otherwise(a["done"]).alias("done"),
        )

    start = F.struct(
        F.array_repeat(F.lit(0), size).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
        F.array().cast("array<struct<first:int,last:int>>").alias("done"),
    )
    # Each character with the one that leaves when it enters.
    moves = F.zip_with(
        F.transform(codes, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
        F.concat(F.array_repeat(F.lit(None).cast("int"), w), codes),
        lambda a, old: F.when(a.isNotNull(), F.struct(a["i"].alias("at"), a["x"].alias("enters"), old.alias("leaves"))),
    )
    moves = F.filter(moves, lambda x: x.isNotNull())

    def finish(a: Column) -> Column:
        last = F.array(F.struct(a["first"].alias("first"), a["last"].alias("last")))
        return F.when(a["last"] > a["first"], F.concat(a["done"], last)).otherwise(a["done"])

    return F.aggregate(moves, start, step, finish)


def _placed(candidate: Column, spans: Column, kind: int, window: int) -> Column:
    """Spans of a candidate, without examples, as spans of its text."""

    def secret(s: Column) -> Column:
        held = F.substring(candidate, s["first"] + 1, s["last"] - s["first"])
        return ~held.contains(EXAMPLE) & F.exists(F.split(held, COUNTING), lambda x: F.char_length(x) >= window)

    def place(s: Column) -> Column:
        first, last = F.col("start") + s["first"], F.col("start") + s["last"]
        return F.struct(first.alias("start"), F.lit(kind).alias("kind"), last.alias("end"))

    return F.transform(F.filter(spans, secret), place)


def _of_kind(kind: int) -> Column:
    return F.filter("spans", lambda s: s["kind"] == kind)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its key as ``doc_id``, ``text_hash`` and ``spans`` (start, kind as its place in ``KINDS``, end)
    in that order."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), body.alias("text")).withColumn("row", F.monotonically_increasing_id())
    text = F.col("text")
    found = [_found(text, 0, ASSIGN, ASSIGN_LENGTH), _found(text, 1, ACCESS), _found(text, 2, HEX)]
    for k, c in enumerate(CLASSES):
        found.append(_found(text, len(BASE_KINDS) + k, f"{c.pattern}{{{c.window},}}"))
    rows = rows.select("row", "doc_id", F.xxhash64("text").alias("text_hash"), F.concat(*found).alias("found"))
    rows = rows.select("row", "doc_id", "text_hash", F.posexplode_outer("found").alias("n", "f"))
    before = Window.partitionBy("row", "f.kind").orderBy("n")
    rows = rows.withColumn("end", F.sum(F.col("f.gap") + F.col("f.length")).over(before))
    rows = rows.withColumn("start", F.col("end") - F.col("f.length"))

    whole = F.when(F.col("f.counts"), F.array(F.struct("start", F.col("f.kind").alias("kind"), "end")))
    allowed = F.col("f.text").rlike("^(?:" + "|".join(f"(?:{p})" for p in ALLOWED) + ")$")
    spans = F.when(F.col("f.kind") < len(BASE_KINDS), whole)
    for k, c in enumerate(CLASSES):
        kind = len(BASE_KINDS) + k
        spans = spans.when((F.col("f.kind") == kind) & ~allowed, _placed(F.col("f.text"), high_entropy(F.col("f.text"), c), kind, c.window))
    rows = rows.select("row", "doc_id", "text_hash", spans.alias("spans"))
    one = rows.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"), F.flatten(F.collect_list("spans")).alias("spans")
    )
    return one.select("doc_id", "text_hash", F.array_sort("spans").alias("spans"))


def _written(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """All documents with all their columns, every span of the scan replaced by ``mark``; overlapping spans are one.

    A column ``n_chars`` (or any column of that name) is left to the caller.
    """
    hits = scan(docs, id_col, text_col).where(F.size("spans") > 0).select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_text"), F.col("spans").alias("hit_spans")
    )
    hits = hits.dropDuplicates(["hit_id", "hit_text"])  # repeated rows have the same spans
    names = [f"c{i}" for i in range(len(docs.columns))]
    key, at = F.col(names[docs.columns.index(id_col)]), docs.columns.index(text_col)
    text = F.col(names[at])
    same = key.eqNullSafe(F.col("hit_id")) & (F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))) == F.col("hit_text"))
    start = F.struct(F.lit(0).cast("bigint").alias("from"), F.array().cast("array<struct<from:bigint,to:bigint>>").alias("keep"))

    def step(a: Column, s: Column) -> Column:  # spans come by start
        gap = F.array(F.struct(a["from"].alias("from"), s["start"].alias("to")))
        first = F.size(a["keep"]) == 0
        return F.struct(
            F.greatest(a["from"], s["end"]).alias("from"),
            F.when(first | (s["start"] > a["from"]), F.concat(a["keep"], gap)).otherwise(a["keep"]).alias("keep"),
        )

    def finish(a: Column) -> Column:
        return F.concat(a["keep"], F.array(F.struct(a["from"].alias("from"), F.char_length(text).cast("bigint").alias("to"))))

    def cut(p: Column) -> Column:
        return F.substring(text, (p["from"] + 1).cast("int"), (p["to"] - p["from"]).cast("int"))

    kept = F.aggregate("hit_spans", start, step, finish)
    clean = F.when(F.col("hit_spans").isNull(), text).otherwise(F.array_join(F.transform(kept, cut), mark))
    out = docs.toDF(*names).join(hits, same, "left")
    return out.select(*(clean.alias(c) if i == at else F.col(c) for i, c in enumerate(names))).toDF(*docs.columns)


def op2(docs: DataFrame) -> DataFrame:
    """The contract of op2."""
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))
    count = [
        F.size(_of_kind(k)).cast("bigint").alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)
    ]
    return scan(docs).select("doc_id", *count, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))

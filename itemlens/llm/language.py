"""Language identification by compression with per-language dictionaries.

Texts are read in lower case with all runs of other characters than letters as one space, since capitals and marks say
nothing of the language. Learning: from the labelled documents about ``LEARNED`` texts per language, drawn by a hash of key
and text, give the raw-content zstandard dictionary: the terms that several of them use, the most used ones last, where
references are shortest. (Whole texts as content would turn a copy of a wrongly labelled document into a perfect match.)
Of a text above ``LEARNED_CHARS``, ``PARTS`` parts spread evenly from its start to its end are learned. A term is a word, or,
in runs of more than ``LONG_WORD`` letters as in scripts without spaces, each ``GRAM`` letters. Every learned language has a
dictionary; all together take ``TOTAL_BYTES``, one at most ``DICTIONARY_BYTES``. Predicting: a text is cut into pieces of
``PIECE_BYTES``; each piece is compressed once per language with that language's dictionary, and the sizes of all pieces are
added up. The language with the fewest bytes wins; equal sums go to the first in alphabetical order.

``score`` is the winner's lead over the second in units of ``SURE`` of the plain size, from 0 to 1. Where the lead is below
``MARGIN`` of the plain size, the prediction is narrow and ``rejected`` is true; ``lang_pred`` still names the best.

Null texts and texts without a letter are ``und`` with score 0. Null languages, null keys' folds (``held_out`` null: false) and
null texts: a row without language or letters isn't learned from; a null key is a key. Repeated rows are learned as often as
they occur and get equal predictions. An empty table gives no rows; without any labelled text every prediction is ``und``.
Other columns aren't read, whatever their names, and language and source are never inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
#: Texts learned from per language (the bound of the sample).
LEARNED = 1000
#: Letters of a longer text that are learned, in parts spread over it.
LEARNED_CHARS = 16 << 10
PARTS = 4
#: Texts that must use a term for the dictionary to have it, where the language has that many.
SHARED_BY = 2
#: Runs of more letters are learned by their ``GRAM`` letters.
LONG_WORD = 24
GRAM = 4
#: Bytes of one dictionary, and of all.
DICTIONARY_BYTES = 64 << 10
TOTAL_BYTES = 32 << 20
PIECE_BYTES = 4096
LEVEL = 6
#: Leads, as shares of the plain size: below the first a prediction is rejected, from the second on it is certain.
MARGIN = 0.01
SURE = 0.1


def _learned_text(text: Column) -> Column:
    """The text, or its parts with a line end between."""
    size = LEARNED_CHARS // PARTS
    step = (F.length(text) - size) / (PARTS - 1)
    parts = [F.substring(text, F.floor(step * i).cast("int") + 1, F.lit(size)) for i in range(PARTS)]
    return F.when(F.length(text) <= LEARNED_CHARS, text).otherwise(F.concat_ws("\n", *parts))


def _terms(text: Column) -> Column:
    """Distinct terms of a text."""
    runs = F.split(F.trim(F.regexp_replace(F.lower(text), r"\P{L}+", " ")), " ")
    grams = F.transform(
        F.filter(runs, lambda w: F.length(w) > LONG_WORD), lambda w: F.regexp_extract_all(w, F.lit(f"(?=(.{{{GRAM}}}))"), 1)
    )
    return F.array_distinct(F.concat(F.filter(runs, lambda w: F.length(w) <= LONG_WORD), F.flatten(grams)))


def learned(docs: DataFrame, labelled: Column, lang_col: str = "lang", per_language: int = LEARNED) -> dict[str, bytes]:
    """Dictionary content per language.

    The sample is drawn by comparing a hash of key and text with a share per language, so about ``per_language`` texts are
    counted, however many there are; the driver gets terms and counts, in the order of their use, at most as many per
    language as can fill a dictionary, which are ``TOTAL_BYTES`` at most in all.
    """
    rows = docs.where(labelled).select(
        F.col("doc_id"), F.col("text"), F.col(lang_col).cast("string").alias("lang")
    )
    rows = rows.where(F.octet_length("text") > 0)
    count = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    held: dict[str, list[bytes]] = {r["lang"]: [] for r in count.collect()}  # one row per language
    each = min(DICTIONARY_BYTES, TOTAL_BYTES // max(1, len(held)))
    chance = (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / (1 << 40)) * F.col("n")
    # The counts are a row per language, as the dictionaries that every task holds.
    sample = rows.join(F.broadcast(count), "lang").where(chance < per_language)
    words = sample.select("lang", "n", F.explode(_terms(_learned_text(F.col("text")))).alias("word"))
    used = words.where("word <> ''").groupBy("lang", "n", "word").agg(F.count(F.lit(1)).alias("texts"))
    shared = used.where(F.col("texts") >= F.least(F.lit(SHARED_BY), F.lit(per_language), F.col("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("texts"), "word"))
    most = shared.withColumn("rank", rank).where(F.col("rank") <= each // 2)
    room = dict.fromkeys(held, each)
    for r in most.orderBy("lang", "rank").toLocalIterator():
        word = b" " + r["word"].encode()
        if len(word) <= room[r["lang"]]:
            held[r["lang"]].append(word)
            room[r["lang"]] -= len(word)
    return {lang: b"".join(reversed(parts)) or b" " for lang, parts in sorted(held.items())}


class Classifier:
    """Sizes of a text under every language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        import regex
        import zstandard as z

        self.languages = sorted(dictionaries)
        self.others = regex.compile(r"\P{L}+")
        self.tools = []
        for lang in self.languages:
            d = z.ZstdCompressionDict(dictionaries[lang], dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.tools.append(z.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False))

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        data = self.others.sub(" ", text.lower()).strip().encode() if text else b""
        if not self.tools or not data:
            return UNDETERMINED, 0.0, True
        pieces = [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
        sizes = [sum(len(t.compress(p)) for p in pieces) for t in self.tools]
        best, *rest = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        lead = (sizes[rest[0]] - sizes[best]) / len(data) if rest else SURE
        return self.languages[best], min(1.0, lead / SURE), lead < MARGIN


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(model.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                lang, score, rejected = zip(*map(classify, part.column(2).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(lang), pa.array(score, pa.float64()), pa.array(rejected)],
                    ["doc_id", "held_out", "lang_pred", "score", "rejected"],
                )

    return run


def identify(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """One row per document: its key as ``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``rejected``.

    Documents for which ``held_out`` (a condition on the key) holds aren't learned from.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    known = ~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()
    model = docs.sparkSession.sparkContext.broadcast(learned(rows, known))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        _predict(model), f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean"
    )


def op3(docs: DataFrame) -> DataFrame:
    """The contract of op3: a fold of the documents by the checksum of their keys is held out."""
    return identify(docs, F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2)

"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in the shared scratch folder and
read again as the next stage's docs:

1. quality rules: documents that fail the base rules or the likelihood-ratio verdict go;
2. near-dedup: of every group of near duplicates the document with the least key stays;
3. decontamination: documents that hold a window of a benchmark item go;
4. secret scan: secrets are replaced by a mark, ``n_chars`` follows the new text, every document stays;
5. packing: the pieces of full training sequences, with their token ids.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemlens.llm import minhash, packing, quality, secrets, wu_manber
from itemlens.llm.queries import ship, table
from itemlens.session import ensure_checkpoint_dir, write_scratch_table


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship(spark)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return minhash.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return wu_manber.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    columns, clean = docs.columns, secrets.redact(docs)
    if "n_chars" not in columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars"))).select(columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality rules", keep_good),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scan", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is the last stage's."""
    _ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_scratch_table(spark, stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs


#: The hashed model, tokenisation and packing can't be expressed in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None

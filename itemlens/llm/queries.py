"""The registered queries of this subpackage: each applies one operator to whole tables of a folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from itemlens.llm import (
    alignment,
    divergence,
    hilbert,
    language,
    lempel_ziv,
    licenses,
    minhash,
    oracles,
    packing,
    pieces,
    quality,
    secrets,
    simple8b,
    wu_manber,
)
from itemlens.session import ensure_checkpoint_dir

ROOT = Path(__file__).resolve().parents[2]
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package importable in Python workers that the driver's own path doesn't reach.

    The code (no data) is zipped once per application and served to the executors by Spark.
    """
    app = spark.sparkContext.applicationId
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if app in _SHIPPED or ROOT in paths:
        return
    target = Path(tempfile.mkdtemp(prefix="itemlens-code-")) / "itemlens.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted((ROOT / "itemlens").rglob("*.py")):
            z.write(f, f.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _over(*names: str):
    """A query that reads tables ``names`` and hands them to the operator."""

    def deco(op: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            ship(spark)
            return op(*(table(spark, sf_dir, n) for n in names))

        run.__doc__ = op.__doc__
        return run

    return deco


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": _over("documents")(packing.op1),
    "op2_secrets": _over("documents")(secrets.op2),
    "op3_language": _over("documents")(language.op3),
    "op4_hilbert": _over("documents")(hilbert.op4),
    "op5_decontamination": _over("documents", "benchmark")(wu_manber.op5),
    "op6_licenses": _over("documents")(licenses.op6),
    "op7_simple8b": _over("documents")(simple8b.op7),
    "op8_quality": _over("documents", "labels")(quality.op8),
    "op9_minhash": _over("documents")(minhash.op9),
    "op10_lempel_ziv": _over("documents")(lempel_ziv.op10),
    "op11_divergence": _over("documents")(divergence.op11),
    "op12_alignment": _over("documents")(alignment.op12),
    "op13_pieces": _over("documents")(pieces.op13),
}

#: DuckDB SQL for the same rows, where SQL can express the query on whole tables.
SQL: dict[str, str] = {
    "op5_decontamination": oracles.DECONTAMINATION,
    "op6_licenses": licenses.SQL,
    "op9_minhash": oracles.NEAR_DUPLICATES,
    "op10_lempel_ziv": oracles.REPEATED_SPANS,
    "op11_divergence": divergence.SQL,
}

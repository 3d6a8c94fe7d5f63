"""Every registered query runs on the smallest table folder; oracle-checked ones match DuckDB exactly."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_mod  # noqa: E402
from itemlens.sources.catalog import TABLES  # noqa: E402

QUERIES = entry_mod.queries()
FORBIDDEN_OPERATORS = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")
# MLlib's recommendForUserSubset crosses user-factor blocks with item-factor blocks inside the library; the report asks it
# for three users.
MLLIB_BLOCK_PRODUCT = {"als_user_report"}


def _plan_text(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


SQLS = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_small):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["item_id", "title", "n_ratings", "avg_rating"]


def test_every_sql_key_is_a_query():
    assert set(SQLS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_small, name):
    from check_oracle import _SPARK_TO_DUCK, _rows

    df = QUERIES[name](spark, sf_small)
    plan = _plan_text(df)
    for bad in FORBIDDEN_OPERATORS:
        if bad == "CartesianProduct" and name in MLLIB_BLOCK_PRODUCT:
            continue
        assert bad not in plan, f"{name} plans {bad}"
    rows = [tuple(r) for r in df.collect()]
    if name not in SQLS:
        assert len(rows) > 0 and df.columns
        for row in rows:
            assert not any(isinstance(v, float) and v in (float("inf"), float("-inf")) for v in row)
        return
    res = duck.execute(SQLS[name])
    drows = res.fetchall()
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    stypes = {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    dtypes = {d[0]: str(d[1]) for d in res.description}
    assert stypes == dtypes
    assert len(rows) == len(drows)
    assert _rows(df.columns, rows) == _rows(dcols, drows)


def test_filters_pushed_and_columns_pruned(spark, sf_small):
    sim = _plan_text(QUERIES["similar_vectors_topn"](spark, sf_small))
    assert "PushedFilters: [IsNotNull(vec_id), EqualTo(vec_id,7)]" in sim
    full_lineitem = "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int"
    for name in ("regression_lr1", "vote_by_year", "ratings_with_titles"):
        assert full_lineitem not in _plan_text(QUERIES[name](spark, sf_small)), name


def test_bench_prints_one_json_line(sf_small):
    import json
    import subprocess

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=sf_small, BENCH_RUNS="1", BENCH_QUERIES="similar_vectors_topn", BENCH_CPUS="2")
    out = subprocess.run(
        [sys.executable, os.path.join(root, "bench.py")], env=env, capture_output=True, text=True, timeout=600
    )
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert out.returncode == 0 and len(lines) == 1
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= rec.keys() and rec["unit"] == "sec"
    assert set(rec["queries"]) == {"similar_vectors_topn"}

"""Write PLANS.md: physical-plan summaries of the headline queries (``explain("formatted")`` digested).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
For each query: operator counts, every parquet scan with its pruned ReadSchema and PushedFilters, and the join
strategies chosen before adaptive re-planning (AQE may still turn a sort-merge join into a broadcast at runtime).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from itemlens.plans.registry import all_queries  # noqa: E402
from itemlens.session import local_session  # noqa: E402


def summarize(df) -> tuple[Counter, list[tuple[str, str, str]]]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    ops = Counter(m.split(" [")[0].strip() for m in re.findall(r"^\(\d+\) (.+)$", text, re.M))
    scans = []
    for m in re.finditer(r"\(\d+\) Scan parquet.*?\n(?:.*\n){0,10}", text):
        block = m.group(0)
        loc = re.search(r"Location: .*?\[(.*?)\]", block)
        schema = re.search(r"ReadSchema: (.*)", block)
        pushed = re.search(r"PushedFilters: (.*)", block)
        scans.append(
            (
                loc.group(1).rstrip("/").split("/")[-1] if loc else "?",
                schema.group(1) if schema else "-",
                pushed.group(1) if pushed else "-",
            )
        )
    return ops, scans


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(cores=8, shuffle_partitions=16)
    print("# PLANS\n")
    print(f"Physical plans of the headline queries at `{sf_dir}`, digested from `explain(\"formatted\")` by")
    print("`tools/plan_report.py`. Plans are shown before adaptive re-planning: AQE may still turn a sort-merge join")
    print("into a broadcast hash join when a side is small at runtime, coalesce partitions, or split skewed ones.")
    print("Materialised tables (`ratings`, per-item sales) appear as parquet scans of the shared checkpoint folder.\n")
    for spec in all_queries().values():
        if not spec.bench:
            continue
        ops, scans = summarize(spec.build(spark, sf_dir))
        print(f"## {spec.name}\n")
        print("operators: " + ", ".join(f"{k} x{v}" for k, v in sorted(ops.items())) + "\n")
        print("| scan | ReadSchema | PushedFilters |")
        print("| --- | --- | --- |")
        for loc, schema, pushed in scans:
            print(f"| {loc} | `{schema}` | `{pushed}` |")
        print()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)

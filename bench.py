"""Benchmark the headline queries.

Runs every registered query flagged ``bench`` at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:
``{"metric": "headline_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.
Each query is executed in full through the ``noop`` sink (no collect to the driver); the reported time is the median
of ``$BENCH_RUNS`` warm runs (one where a run takes over 10 s) after one cold run, which also fills the materialised
tables and trains the models; ``cold`` has its times. ``$BENCH_EVENT_LOG_DIR`` writes Spark's event log there for
stage and task times.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from itemlens.plans.registry import all_queries
    from itemlens.session import local_session
    from itemlens.sources.hot import hot_tables

    extra = {}
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if log_dir:  # stage and task times without the UI: Spark's event log in a scratch folder
        os.makedirs(log_dir, exist_ok=True)
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    spark = local_session(
        cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), extra_conf=extra
    )
    specs = [s for s in all_queries().values() if (s.name in only if only else s.bench)]
    timings: dict[str, float] = {}
    cold: dict[str, float] = {}
    for spec in specs:
        samples = []
        for i in range(runs + 1):
            if i > 1 and samples[0] > 10:  # long queries: one warm run
                break
            t0 = time.perf_counter()
            spec.build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                samples.append(time.perf_counter() - t0)
            else:
                cold[spec.name] = round(time.perf_counter() - t0, 3)
        timings[spec.name] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "cold": cold,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(out))
    hot_tables(spark).close()
    spark.stop()


if __name__ == "__main__":
    main()

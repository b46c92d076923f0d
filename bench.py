"""Benchmark of the headline queries.

Runs each query (plan construction + execution into the ``noop`` sink) on
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``
and prints one JSON line with the median of ``$BENCH_RUNS`` warm runs per
query (after one warm-up run).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a6_dm_cartera",
    "a7_dm_resumen_credito",
    "a9_vw_recaudo_diario",
    "a10_vw_cartera_cohorte",
    "a11_vw_top_mora",
    "q04_top_atraso",
    "q05_dataset_bi",
    "k13_control_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE

    from lendlake.plans.registry import queries
    from lendlake.session import get_session

    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = get_session(
        app="lendlake-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        extra={
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
            "spark.local.dir": os.path.join(scratch, "local"),
        },
    )
    qs = queries()
    times: dict[str, float] = {}
    for name in names:
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # the first run warms the JVM and code caches
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

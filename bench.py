"""Benchmark: the written ETL pipeline plus every registered query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (optional comma list). Prints ONE JSON line on stdout.
Each query is executed in full through the ``noop`` sink (no collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from nimbusmart.plans import roles, stages
    from nimbusmart.plans.pipeline import run_bronze, run_gold, run_silver
    from nimbusmart.plans.profile import Phases, run_action
    from nimbusmart.plans.queries import REGISTRY
    from nimbusmart.session import build_session, checkpoint_dir

    conf = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    spark = build_session(
        "nimbusmart-bench", master=f"local[{cpus}]", shuffle_partitions=cpus * 2, extra_conf=conf
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = f"{checkpoint_dir(spark)}/bench-{int(time.time())}"

    phases = Phases()

    def timed(name, fn):
        with phases.phase(name):
            fn()

    # warm-up (JVM, class loading, code generation) on the smallest scale, not timed
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        wbase = f"{base}/warmup"
        run_bronze(roles.weather(spark, warm_dir), roles.cities(spark, warm_dir),
                   roles.countries(spark, warm_dir), f"{wbase}/bronze")
        run_silver(spark, f"{wbase}/bronze", f"{wbase}/silver")
        run_gold(spark, f"{wbase}/silver", f"{wbase}/gold")
    run_action(REGISTRY["row_count"].fn(spark, sf_dir))

    if not only:
        w, c, k = roles.weather(spark, sf_dir), roles.cities(spark, sf_dir), roles.countries(spark, sf_dir)
        timed("pipeline_bronze", lambda: run_bronze(w, c, k, f"{base}/bronze"))
        timed("pipeline_silver", lambda: run_silver(spark, f"{base}/bronze", f"{base}/silver"))
        timed("pipeline_gold", lambda: run_gold(spark, f"{base}/silver", f"{base}/gold"))

    # The marts that the serving queries open are written once, as a phase of its own.
    if not only:
        timed("written_marts", lambda: stages.gold_registry(spark, sf_dir))

    for name, q in REGISTRY.items():
        if only and name not in only:
            continue
        timed(name, lambda q=q: run_action(q.fn(spark, sf_dir)))

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    timings = {k: round(v, 3) for k, v in phases.timings.items()}
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "total_query_sec", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()

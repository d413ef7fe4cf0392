"""Benchmark: build the warehouse from the driver tables, then run the marts
and reports on the published tables.  One untimed warm-up pass on the
smallest tables (BENCH_WARMUP_DIR, default /root/testdata/sf0.001) comes
first, so the timings are of a warm JVM.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_THREADS (concurrent models per wave, default 4).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from martforge.session import build_session, checkpoint_dir, scratch_path
    spark = build_session(f"local[{cpus}]", app="martforge-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)

    from martforge.operators.quality import run_suite
    from martforge.plans import analytics as A
    from martforge.plans import checks as C
    from martforge.plans.publish import write_table
    from martforge.plans.warehouse import BUILD_WAVES, LAYOUT, PublishedWarehouse, Warehouse

    threads = int(os.environ.get("BENCH_THREADS", "4"))

    def pipeline(sf_path: str, timings: dict[str, float]) -> float:
        """Run everything once; per-model times go to ``timings`` (models of
        one wave overlap), the end-to-end wall time is returned."""
        root = scratch_path(spark, f"bench-{uuid.uuid4().hex[:8]}")
        lock = threading.Lock()

        def timed(name, fn):
            t0 = time.perf_counter()
            fn()
            with lock:
                timings[name] = round(time.perf_counter() - t0, 3)

        def run(df):
            df.write.format("noop").mode("overwrite").save()

        def concurrently(jobs: dict):
            with ThreadPoolExecutor(max_workers=max(1, min(threads, len(jobs)))) as pool:
                for f in [pool.submit(timed, n, fn) for n, fn in jobs.items()]:
                    f.result()

        start = time.perf_counter()
        # 1. build: landing -> staging -> star, in dependency waves; the
        #    models of one wave are written concurrently (the source's model
        #    build uses 4 threads as well)
        holder = {}
        timed("landing_line_numbering",
              lambda: holder.setdefault("wh", Warehouse.from_driver_tables(spark, sf_path)))
        wh = holder["wh"]
        for wave in BUILD_WAVES:
            concurrently({n: (lambda n=n: write_table(getattr(wh, n), f"{root}/warehouse/{n}",
                                                      sort_by=LAYOUT.get(n))) for n in wave})
        timings["etl_build_total"] = round(time.perf_counter() - start, 3)
        pw = PublishedWarehouse(spark, f"{root}/warehouse")
        # 2. marts, each written as a table (independent of each other)
        concurrently({n: (lambda n=n, b=b: pw.store_mart(n, b(pw))) for n, b in C.MART_MODELS.items()})
        # 3. the 30 tests on marts, on the written tables
        timed("dq_mart_suite", lambda: run(run_suite(C.MART_SUITE, C.model_resolver(pw))))
        # 4. reports read by people, one after the other
        reports = {
            "refunds_by_state_reason": lambda: A.refunds_by_state_reason(pw),
            "customer_order_history": lambda: A.customer_order_history(pw),
            "customer_summary": lambda: A.customer_summary(pw),
            "cohort_first_order": lambda: A.cohort_first_order(pw),
            "category_rollup_units": lambda: A.category_rollup_units(pw),
        }
        for name, build in reports.items():
            timed(name, lambda b=build: run(b()))
        return round(time.perf_counter() - start, 3)

    # untimed warm-up pass on the smallest tables: JVM JIT and code
    # generation warm up once per application, as on a long-running cluster
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        pipeline(warm_dir, {})
    timings: dict[str, float] = {}
    total = pipeline(sf_dir, timings)

    print(json.dumps({"metric": "warehouse_build_marts_tests_reports_wall_warm", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

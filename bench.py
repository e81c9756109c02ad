"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is built and fully executed into Spark's no-op sink (nothing is
collected to the driver); build time counts, since checkpoints run there.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "errors_sales",             # C: validation fan-out + error numbering
    "standardize_sales",        # D: text rules over the largest feed
    "dedupe_company_sales",     # E1: six sequential pair passes
    "upsert_company_crm",       # E9: dedupe, match, mint, attach, merge
    "upsert_person_sales",      # E10 after E9 on the largest feed
    "fold_company_master",      # E12: all five feeds, both masters
    "manual_merge_apply",       # E13-E15
    "candidates_domain",        # F5
    "error_trend",              # F1 + F2
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from partyfold.session import build_session
    from partyfold.plans.queries import registry

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, app_name="partyfold-bench")
    queries = registry()
    # start the JVM side once (session, parquet reader) outside the timings
    spark.read.parquet(os.path.join(sf_dir, "region.parquet")).count()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        df = queries[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()

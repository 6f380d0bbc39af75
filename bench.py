"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is built and fully evaluated (all result rows fetched) once to
warm the JVM, then timed as the best of ``$BENCH_REPS`` (default 2) runs; of one run, once
the whole has taken ``$BENCH_LONG`` seconds (default 240).
Build time (planning actions such as a site count) is included; garbage from
earlier runs is collected between runs, outside the timed region.
"""

from __future__ import annotations

import gc
import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cityscan.plans.catalog import QUERIES  # noqa: E402
from cityscan.session import build_session  # noqa: E402

HEADLINE = [
    "bucket_count",
    "bucket_count_udf",
    "union_periods",
    "distinct_years",
    "topk_share_per_year",
    "topk_share_per_year_sql",
    "token_count_lookup",
    "token_join_merge",
    "token_join_shuffle_hash",
    "token_join_broadcast",
    "nearest_site",
    "nearest_site_array",
    "nearest_site_grid",
    "nearest_site_sql",
    "geojson_zones",
    "zone_income",
    "points_in_zones",
    "zone_rollup",
    "zone_corr",
    "zone_corr_nullzero",
    "zone_corr_extremes",
    "token_join_bucketed",
    "nearest_site_levels",
    "nearest_site_city",
    "nearest_site_globe",
    "csv_incidents",
    "csv_semicolon",
    "geojson_ranges",
    "shapes",
    "points_in_zones_skewed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "2"))
    long = time.perf_counter() + float(os.environ.get("BENCH_LONG", "240"))
    only = [k for k in sys.argv[1:] if k in QUERIES] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        app="cityscan-bench",
        shuffle_partitions=max(cpus, 2),
        extra={"spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": str(32 << 20)},
    )
    times: dict[str, float] = {}
    failed: dict[str, str] = {}

    def settle() -> None:
        # release the previous query's broadcasts, shuffles and checkpoints
        # (cleaned once both sides drop their references) outside the timing
        gc.collect()
        spark.sparkContext._jvm.System.gc()

    for k in only:
        settle()
        try:
            QUERIES[k](spark, sf_dir).collect()  # warm-up
            best = float("inf")
            for _ in range(reps if time.perf_counter() < long else 1):
                settle()
                t0 = time.perf_counter()
                QUERIES[k](spark, sf_dir).collect()
                best = min(best, time.perf_counter() - t0)
        except Exception as e:  # report and keep measuring the others
            failed[k] = f"{type(e).__name__}: {str(e)[:200]}"
            print(f"{k}: FAILED {failed[k]}", file=sys.stderr)
            continue
        times[k] = round(best, 3)
        print(f"{k}: {best:.3f}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""Timings of the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (space-separated
names, default the headline list).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadlens.plans import catalog  # noqa: E402
from roadlens.session import local_session  # noqa: E402

HEADLINE = [
    "performance_statistics", "carry_attributes", "trip_measures", "scenario_diff", "speed_class_stats", "daily_aggregate",
    "district_diff", "speed_p95", "s3_flow", "speed_volume_hourly", "speed_volume_audit", "transit_delay", "vdf_lookup",
    "qvdf_override", "lookup_precedence", "convert_links", "boundary_audit", "od_sparse", "raw_profile", "enforced_profile",
    "step_metrics", "transfer_simple", "table_fingerprint", "near_links",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_linenumber").count().collect()
    seconds: dict[str, float] = {}
    for name in names:
        begin = time.time()
        try:
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - begin, 3)
        except Exception as exc:  # a broken query must not hide the others
            print(f"{name}: {str(exc)[:400]}", file=sys.stderr)
            seconds[name] = -1.0
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(s for s in seconds.values() if s >= 0), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()

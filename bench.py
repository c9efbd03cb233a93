"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line. Each query is executed in full
through the ``noop`` sink (nothing is collected to the driver); the time is
the best of $BENCH_REPEAT runs (default 2) after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Headline queries: the end-to-end layer tables plus the heaviest operators.
HEADLINE = [
    "bronze_patients_stream",
    "bronze_observations_stream",
    "silver_patients_batch",
    "silver_observations_batch",
    "silver_patients_pipeline",
    "gold_demographics",
    "gold_financial",
    "gold_lifetime",
    "gold_quality",
    "gold_clinical_summary",
    "gold_vital_signs",
    "gold_observation_types",
    "gold_risk_indicators",
    "gold_patient_overview",
    "expectation_metrics",
    "alerts",
    "duplicate_rank",
    "dedup_composite",
    "agg_grouped",
    "agg_percentile",
    "stream_dedup_latest",
    "gold_incremental_refresh",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = sys.argv[1:]

    from lakestrata.registry import REGISTRY
    from lakestrata.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="lakestrata-bench")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")

    def run(key: str) -> float:
        t0 = time.perf_counter()
        REGISTRY[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # Warm-up (one-time JVM class loading, code generation, stream start-up),
    # on the smallest data set next to the bench data when there is one.
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warm_dir = warm_dir if os.path.isdir(warm_dir) else sf_dir
    for key in ("agg_global", "stream_exactly_once", "bronze_organizations_stream"):
        REGISTRY[key](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for key in only or HEADLINE:
        times[key] = round(min(run(key) for _ in range(repeat)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()

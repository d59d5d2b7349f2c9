"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

Every query is fully computed into a no-op sink. One untimed pass over two small queries warms the JVM; each query is
then run BENCH_RUNS times (default 2) and the fastest run counts.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from vigilake.session import local_session
from vigilake.workload import load_queries

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "a02_flatten_network", "b01_falco_unified", "b06_kubearmor_unified", "b11_detection_rules",
    "c07_deduplicate", "c08_clean", "c09_value_counts",
    "d08_port_entropy", "d11_syscall_frequencies", "d12_top_bigrams", "d17_feature_matrix",
    "f01_minmax", "f02_zscore", "f05_oversampled_counts", "g05_overall_metrics", "g13_threshold",
    "h02_event_type_techniques", "h06_next_stage_posterior", "h09_threat_assessment",
    "i01_validate_alerts", "i04_action_results", "i08_policy_ledger", "i12_drain_plan",
    "j01_alert_projection", "j02_entity_status", "j05_minute_series", "j07_summary_stats",
]
WARM_UP = ["c09_value_counts", "d01_session_counts"]


def seconds(build, spark) -> float:
    started = time.perf_counter()
    build(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8)
    registered = load_queries()
    for name in WARM_UP:
        seconds(registered[name].build, spark)
    timings = {}
    for name in HEADLINE:
        timings[name] = round(min(seconds(registered[name].build, spark) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "total seconds over the headline queries", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": Path(SF_DIR).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

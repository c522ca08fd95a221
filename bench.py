"""Headline queries, timed one by one; prints one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the cores to use.
Every query is planned and run to the last row and column (a sink that discards
them) twice, and the faster run counts: the first pays for compiling generated
code, a cost that does not grow with the data.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.plans import catalogue  # noqa: E402
from plumbline.session import local_session  # noqa: E402

HEADLINE = (
    "standardize_table", "standardize_flow_extract", "event_flatten", "join_enrich", "join_event_context", "dq_duplicate_grain",
    "dq_record_status", "exception_explode", "rule_summary", "meter_daily", "facility_daily", "actual_vs_nominated",
    "flow_reconciliation", "exception_summary_daily", "run_fact", "pipeline_health", "rca_context", "related_context_fallback",
    "rca_packet", "checkpoints", "value_counts", "exception_kpis", "anomaly_plus_sample", "event_upsert", "triage_upsert",
    "align_to_target", "dedupe_by_key", "scenario_interval_join", "calendar_densify", "latest_run_per_customer",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores))
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            catalogue.run(name, spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    spark.stop()
    scale = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()

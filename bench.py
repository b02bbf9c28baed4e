"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query's plan is executed completely with the ``noop`` sink (no collect to the driver). The
headline set is the reference's full run: warehouse build, the 28 data tests, dashboard summaries,
scoring, evaluation, the decision-rule backtest, and the boosted-tree walk-forward.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "warehouse_build", "stg_bookings", "fct_bookings", "daily_occupancy", "monthly_kpis", "cancellation_drivers",
    "dq_rule_results", "booking_totals", "quality_counters", "cancel_timing",
    "walk_forward_prior_rate", "classification_scores", "calibration_table", "weekly_forecast",
    "twin_leak_count", "policy_curve", "policy_sensitivity", "policy_report_round_trip",
    "gbt_walk_forward",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    from roomledger.plans.registry import QUERIES
    from roomledger.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    from roomledger.plans.warehouse import materialized

    times = {}
    for name in only:
        t0 = time.time()
        if name == "warehouse_build":  # raw -> staging -> facts -> nights -> marts, written once
            materialized(spark, sf_dir).all()
        else:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

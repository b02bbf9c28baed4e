"""Condensed physical plans of the headline queries -> PLANS.md.

For each query: counts of shuffles (Exchange), broadcasts, joins, windows, scans and scalar
subqueries, and for every parquet scan the table it reads, the columns it reads, its partition filters
and its pushed filters. The plans are the final adaptive plans after one execution (``noop`` sink) at
the given scale.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = ["stg_bookings", "monthly_kpis", "cancellation_drivers", "dq_rule_results", "walk_forward_prior_rate",
           "classification_scores", "twin_leak_count", "policy_curve", "surrogate_row_id", "top_agents"]


def summarize(plan: str) -> list[str]:
    out = []
    counts = {k: len(re.findall(p, plan)) for k, p in [
        ("shuffle exchanges", r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"),
        ("broadcast exchanges", r"BroadcastExchange"), ("broadcast hash joins", r"BroadcastHashJoin"),
        ("sort-merge joins", r"SortMergeJoin"), ("windows", r"\bWindow "), ("parquet scans", r"FileScan parquet"),
        ("scalar subqueries", r"Subquery subquery")]}
    out.append(", ".join(f"{k}: {v}" for k, v in counts.items()))
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\][^\n]*", plan):
        line = m.group(0)
        cols = ", ".join(re.sub(r"#\d+L?", "", c) for c in m.group(1).split(",") if c)
        loc = re.search(r"Location: \w+(?:\([^)]*\))?\[([^\]]*)\]", line)
        table = loc.group(1).split(",")[0].rstrip("/").split("/")[-1].replace(".parquet", "") if loc else "?"
        pf = re.search(r"PartitionFilters: (\[[^\]]*\])", line)
        pu = re.search(r"PushedFilters: (\[[^\]]*\])", line)
        out.append(f"- scan `{table}` columns [{cols}]"
                   + (f"; partition filters {re.sub(r'#\d+L?', '', pf.group(1))}" if pf and pf.group(1) != "[]" else "")
                   + (f"; pushed {pu.group(1)}" if pu and pu.group(1) != "[]" else ""))
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from roomledger.plans.registry import QUERIES as REG
    from roomledger.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=16)
    print(f"# Physical plans (condensed), {os.path.basename(sf_dir)}\n")
    print("Generated by `tools/plan_report.py`: final adaptive plans after one run of each query.\n")
    for name in QUERIES:
        df = REG[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n")
        print("\n".join(summarize(plan)) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()

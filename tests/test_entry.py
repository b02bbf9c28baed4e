"""Driver contract: entry runs; every registered query has an oracle unless it is a trained model or
reads file bytes."""

import __spark_entry__ as entry

ROWS_ONLY = {"gbt_rounds", "gbt_walk_forward", "gbt_scores", "feature_importance", "ablation_scores",
             "gbt_scored_bookings", "gbt_policy_curve",
             "random_split_scores", "random_split_leaky_scores",
             "gbt_splits", "gbt_validation_loss", "source_fingerprint"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"hotel", "arrival_month", "bookings", "cancellation_rate"} <= set(df.columns)


def test_oracle_coverage():
    from roomledger.plans import registry
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) - set(registry.ORACLE) == ROWS_ONLY


def test_dashboard_sections_are_ordered(spark):
    from roomledger.operators import quality
    from roomledger.plans.dashboard import dashboard_sections
    from roomledger.plans.warehouse import materialized
    from roomledger.sources.fixtures import FIRST_ARRIVAL, LAST_ARRIVAL

    wh = materialized(spark, "/root/testdata/sf0.001")
    res = quality.rule_results(quality.warehouse_rules(wh, FIRST_ARRIVAL, LAST_ARRIVAL))
    secs = dashboard_sections(wh, res, 6)
    monthly = [(r.hotel, r.arrival_month) for r in secs["monthly"].collect()]
    assert monthly == sorted(monthly)
    assert secs["tests"].first().tests == 28


def test_library_uses_no_python_row_functions():
    import pathlib
    import re
    root = pathlib.Path(__file__).resolve().parents[1] / "roomledger"
    pattern = re.compile(r"\b(udf|pandas_udf|mapInPandas|applyInPandas|mapPartitions|localCheckpoint)\s*\(")
    hits = [f"{p.name}:{i}" for p in root.rglob("*.py")
            for i, line in enumerate(p.read_text().splitlines(), 1) if pattern.search(line)]
    assert hits == []

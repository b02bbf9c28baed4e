"""The flag of identical rows moves whole rows once at most; derived columns are neither stored with digests nor moved."""

import pytest

from roomledger.operators import joins, staging
from roomledger.plans.warehouse import StoredWarehouse
from roomledger.sources.fixtures import load_raw_bookings

ROWS = [(i, "ab"[i % 2] if i % 5 else None, i // 4 if i % 3 else None) for i in range(60)] + [(100, None, None), (101, "a", 700)]
HOT = [(200 + i, "h", 9) for i in range(40)]


@pytest.mark.parametrize("hot", [staging.HOT_ROWS, 10])
def test_too_many_repeated_digests_move_all_rows_once(spark, monkeypatch, hot):
    from pyspark.sql.classic.dataframe import DataFrame
    df = spark.createDataFrame(ROWS + HOT, "id long, k string, v long")
    twins = {r[0]: sum(r[1:] == o[1:] for o in ROWS + HOT) > 1 for r in ROWS + HOT}
    wide, checkpoint = [], DataFrame.checkpoint

    def watched(self, eager=True):
        plan = self._jdf.queryExecution().executedPlan().toString()
        wide.extend(line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and ", v#" in line)
        return checkpoint(self, eager)

    monkeypatch.setattr(DataFrame, "checkpoint", watched)
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 1)
    monkeypatch.setattr(staging, "HOT_ROWS", hot)
    flagged = staging.flag_identical_rows(df, ["k", "v"], "twin")
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert {r.id: r.twin for r in flagged.collect()} == twins and flagged.count() == len(twins)
    assert plan.count("Exchange hashpartitioning(__digest_a") == 1 and "SortMergeJoin" not in plan
    if hot > len(HOT):  # no digest is hot: nothing but the digests moved before
        assert not wide


def test_a_hot_digest_of_colliding_keys_stays_in_place(spark, monkeypatch):
    rows = [(i, "ab"[i % 2] if i < 8 else f"x{i}", None if i == 9 else 1.5) for i in range(14)]
    df = spark.createDataFrame(rows, "id long, k string, v double")
    monkeypatch.setattr(staging.F, "xxhash64", lambda *a: staging.F.lit(7).cast("long"))
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    for hot in (staging.HOT_ROWS, 10):
        monkeypatch.setattr(staging, "HOT_ROWS", hot)
        got = {r.id: r.twin for r in staging.flag_identical_rows(df, ["k", "v"], "twin").collect()}
        assert got == {i: i < 8 for i in range(14)}


def test_derived_columns_are_made_after_the_moves(spark, tmp_path):
    wh = StoredWarehouse(load_raw_bookings(spark, "/root/testdata/sf0.001"), str(tmp_path))
    out = staging.stage_bookings(wh.raw)
    stored = {f.rsplit("/", 1)[0] for f in out.inputFiles() if "rows-with-digest" in f}
    assert len(stored) == 1
    assert set(spark.read.parquet(stored.pop()).columns) == {"booking_id", "is_no_show", *staging.TWIN_KEY, *staging.DIGEST}
    assert out.columns[-1] == "dq_identical_to_another_row" and out.count() == wh.fct_rows().count() + out.filter(
        "dq_negative_adr OR dq_adr_outlier OR dq_zero_guests").count()
    plan = wh.fct_rows()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("lead_time_band") < plan.index("RebalancePartitions") and "lead_time_band" not in plan[plan.index("RebalancePartitions"):]

"""Staging and marts: night expansion edge cases, twin flag semantics, one-pass drivers."""

import datetime as dt

from pyspark.sql import functions as F

from roomledger.operators import marts
from roomledger.operators.staging import flag_identical_rows
from roomledger.plans.warehouse import facts

from .conftest import SF_SMALL


def test_zero_night_booking_has_no_night_rows(spark):
    df = spark.createDataFrame([(1, "City Hotel", dt.date(2016, 1, 1), 0, False, 10.0),
                                (2, "City Hotel", dt.date(2016, 1, 30), 3, True, 20.0)],
                               "booking_id long, hotel string, arrival_date date, nights int, is_canceled boolean, adr_eur double")
    rows = marts.room_nights(df).collect()
    assert sorted((r.booking_id, r.stay_date) for r in rows) == [
        (2, dt.date(2016, 1, 30)), (2, dt.date(2016, 1, 31)), (2, dt.date(2016, 2, 1))]


def test_identical_rows_are_null_safe_and_survive_a_hot_key(spark):
    hot = [(i, "a", None) for i in range(300)]          # one key holding most rows, with a null column
    rest = [(1000, "b", 1), (1001, "b", 1), (1002, "c", None), (1003, "c", 2)]
    df = spark.createDataFrame(hot + rest, "id long, k1 string, k2 int")
    out = {r.id: r.twin for r in flag_identical_rows(df, ["k1", "k2"], "twin").collect()}
    assert len(out) == 304
    assert all(out[i] for i in range(300))
    assert out[1000] and out[1001] and not out[1002] and not out[1003]


def test_identical_rows_with_colliding_digests(spark, monkeypatch):
    from roomledger.operators import staging
    rows = [(i, "ab"[i % 2] if i < 8 else f"x{i}", None if i == 9 else 1.5) for i in range(14)]
    df = spark.createDataFrame(rows, "id long, k string, v double")
    want = {i: i < 8 for i in range(14)}
    monkeypatch.setattr(staging.F, "xxhash64", lambda *a: F.lit(7).cast("long"))
    got = {r.id: r.twin for r in flag_identical_rows(df, ["k", "v"], "twin").collect()}
    assert got == want
    monkeypatch.undo()
    assert {r.id: r.twin for r in flag_identical_rows(df, ["k", "v"], "twin").collect()} == want
    assert flag_identical_rows(df.limit(0), ["k", "v"], "twin").count() == 0


def test_identical_rows_are_flagged_in_one_read_of_the_sources(spark):
    from roomledger.operators.staging import stage_bookings
    from roomledger.sources.fixtures import load_raw_bookings
    out = stage_bookings(load_raw_bookings(spark, SF_SMALL))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    leaves = out._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    assert "o_orderkey" not in plan and "c_custkey" not in plan and leaves == 3


def test_one_pass_drivers_equal_the_union_form(spark):
    fct = facts(spark, SF_SMALL)
    a = marts.cancellation_drivers(fct)
    b = marts.cancellation_drivers_union(fct)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_staging_keeps_every_row_and_fct_drops_only_flagged(spark):
    from roomledger.plans.warehouse import staging
    from roomledger.sources.fixtures import load_raw_bookings
    raw = load_raw_bookings(spark, SF_SMALL)
    stg = staging(spark, SF_SMALL)
    assert raw.count() == stg.count()
    flagged = stg.filter(F.col("dq_negative_adr") | F.col("dq_adr_outlier") | F.col("dq_zero_guests")).count()
    assert marts.fct_bookings(stg).count() == stg.count() - flagged


def test_rows_without_a_twin_are_not_shuffled(spark, monkeypatch):
    from roomledger.operators import joins
    rows = [(i, "ab"[i % 2] if i % 5 else None, i // 4 if i % 3 else None) for i in range(60)] + [(100, None, None), (101, "a", 700)]
    df = spark.createDataFrame(rows, "id long, k string, v long")
    twins = {r[0]: sum(r[1:] == o[1:] for o in rows) > 1 for r in rows}
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")  # as for tables too large for Spark's own estimate
    try:
        flagged = flag_identical_rows(df, ["k", "v"], "twin")
        assert "SortMergeJoin" not in flagged._jdf.queryExecution().executedPlan().toString()
        assert {r.id: r.twin for r in flagged.collect()} == twins
        monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", -1)  # too many repeated digests: joins of all rows
        assert {r.id: r.twin for r in flag_identical_rows(df, ["k", "v"], "twin").collect()} == twins
    finally:
        spark.conf.set(threshold, before)


def test_a_model_is_written_when_asked_for(spark, tmp_path):
    from roomledger.plans.warehouse import StoredWarehouse
    from roomledger.sources.fixtures import load_raw_bookings
    wh = StoredWarehouse(load_raw_bookings(spark, SF_SMALL), str(tmp_path))
    assert wh.fct.count() > 0 and {p.name for p in tmp_path.iterdir()} == {"stg_bookings", "fct_bookings"}
    assert wh.all().nights.count() > 0 and len(list(tmp_path.iterdir())) == 6


def test_keys_of_repeated_digests_move_once_by_digest(spark, monkeypatch):
    """No window over the keys and no wide partial aggregate in front of their shuffle, unless a digest is hot."""
    from pyspark.sql.classic.dataframe import DataFrame

    from roomledger.operators import staging
    rows = [(i, "ab"[i % 2] if i % 5 else None, i // 4 if i % 3 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, k string, v long")
    twins = {r[0]: sum(r[1:] == o[1:] for o in rows) > 1 for r in rows}
    plans, checkpoint = [], DataFrame.checkpoint

    def watched(self, eager=True):
        plans.append(self._jdf.queryExecution().optimizedPlan().toString())
        return checkpoint(self, eager)

    monkeypatch.setattr(DataFrame, "checkpoint", watched)
    for hot in (staging.HOT_ROWS, 2):
        monkeypatch.setattr(staging, "HOT_ROWS", hot)
        plans.clear()
        assert {r.id: r.twin for r in flag_identical_rows(df, ["k", "v"], "twin").collect()} == twins
        assert not any("Window" in p for p in plans) and any("RepartitionByExpression" in p for p in plans)

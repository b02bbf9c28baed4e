"""Data-quality rules find exactly the planted faults; a clean run has 27 passes and 1 warning."""

from pyspark.sql import functions as F

from roomledger.operators import quality as dq
from roomledger.plans.warehouse import build_warehouse, staging
from roomledger.sources.fixtures import FIRST_ARRIVAL, LAST_ARRIVAL, load_raw_bookings, raw_bookings

from .conftest import SF_SMALL


def _orders(spark):
    return spark.read.parquet(f"{SF_SMALL}/orders.parquet")


def test_planted_faults_are_found_exactly(spark):
    stg = staging(spark, SF_SMALL, faulty=True)
    orders = _orders(spark)
    canceled_planted = (raw_bookings(orders, spark.read.parquet(f"{SF_SMALL}/customer.parquet"))
                        .filter("reservation_status = 'Canceled'")
                        .filter(F.col("booking_id") % 2 == 0).filter((F.col("booking_id") / 2) % 613 == 0)
                        .filter((F.col("booking_id") / 2) % 809 != 0))  # no arrival date: comparison is null
    assert dq.cancellations_after_arrival(stg).count() == canceled_planted.count()
    keys = [r.o_orderkey for r in orders.select("o_orderkey").collect()]
    assert dq.not_null(stg, "arrival_date").count() == sum(1 for k in keys if k % 809 == 0) + sum(
        1 for k in keys if k % 809 == 0 and k % 100 == 0)
    hostel = dq.accepted_values(stg, "hotel", dq.HOTELS).collect()
    assert [r.value for r in hostel] == (["Hostel"] if any(k % 701 == 0 for k in keys) else [])
    assert dq.unique(stg, "booking_id").count() == sum(1 for k in keys if k % 100 == 0)


def test_clean_run_summary(spark):
    wh = build_warehouse(spark, load_raw_bookings(spark, SF_SMALL))
    res = dq.rule_results(dq.warehouse_rules(wh, FIRST_ARRIVAL, LAST_ARRIVAL))
    summary = dq.run_summary(res, 6).first()
    assert summary.tests == 28 and summary.failed == 0
    warned = dq.run_warnings(res).collect()
    assert all(r.test == "assert_checkout_matches_stay_length" for r in warned)


def test_null_flag_is_caught_by_the_exclusion_reconciliation(spark):
    stg = staging(spark, SF_SMALL)
    broken = stg.withColumn("dq_zero_guests", F.when(F.col("booking_id") % 7 == 0, F.lit(None)).otherwise(F.col("dq_zero_guests")))
    from roomledger.operators.marts import fct_bookings
    check = dq.exclusions_check(broken, fct_bookings(broken)).first()
    assert not check.ok
    assert dq.failing(dq.exclusions_check(broken, fct_bookings(broken))).count() == 1


def test_relationships_and_unique_combination(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (5,)], "booking_id long")
    parent = spark.createDataFrame([(1,), (2,)], "booking_id long")
    assert [r.booking_id for r in dq.relationships(child, "booking_id", parent, "booking_id").collect()] == [5]
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "x string, y int")
    got = dq.unique_combination(df, ["x", "y"]).collect()
    assert len(got) == 1 and got[0].x == "a" and got[0].n == 2


def test_fused_run_equals_per_rule_run(spark):
    from roomledger.plans.warehouse import materialized
    for faulty in (False, True):
        wh = materialized(spark, SF_SMALL, faulty=faulty)
        a = dq.rule_results(dq.warehouse_rules(wh, FIRST_ARRIVAL, LAST_ARRIVAL))
        b = dq.fused_rule_results(wh, FIRST_ARRIVAL, LAST_ARRIVAL)
        ra = sorted(tuple(r) for r in a.select("test", "severity", "failures", "status").collect())
        rb = sorted(tuple(r) for r in b.select("test", "severity", "failures", "status").collect())
        assert ra == rb and len(ra) == 28

"""Scorer and leakage count against plain-Python brute force on small frames."""

import datetime as dt

from pyspark.sql import functions as F

from roomledger.operators.scoring import prior_rate_scores
from roomledger.operators.splits import twin_leak_count


def test_prior_rate_uses_strictly_earlier_months_only(spark):
    rows = []
    for i in range(60):
        month = dt.date(2016, 1 + i % 5, 1)
        rows.append((i, "A" if i % 3 else "B", month, i % 4 == 0))
    df = spark.createDataFrame(rows, "booking_id long, market_segment string, arrival_month date, is_canceled boolean")
    got = {r.booking_id: r.p_cancel for r in prior_rate_scores(df).collect()}
    for bid, seg, month, _ in rows:
        earlier = [c for _, s, m, c in rows if s == seg and m < month]
        assert got[bid] == (sum(earlier) + 1) / (len(earlier) + 2)


def test_twin_leak_count_matches_pairwise_check(spark):
    rows = [(i, i % 4, None if i % 5 == 0 else i % 3, i % 7 == 0) for i in range(80)]
    df = spark.createDataFrame(rows, "booking_id long, a int, b int, hold boolean")
    r = twin_leak_count(df, ["a", "b"], F.col("hold")).first()
    train = {(a, b) for _, a, b, h in rows if not h}
    assert r.holdout_rows == sum(1 for *_, h in rows if h)
    assert r.holdout_rows_with_train_twin == sum(1 for _, a, b, h in rows if h and (a, b) in train)


def test_backoff_scores_equal_a_plain_recursion(spark):
    from roomledger.operators.scoring import backoff_scores
    rows = [(i, "AB"[i % 2], None if i % 5 == 0 else "xyz"[i % 3], dt.date(2016, 1 + (i * 7) % 6, 1), i % 4 == 0) for i in range(150)]
    df = spark.createDataFrame(rows, "booking_id long, a string, b string, arrival_month date, is_canceled boolean")
    got = {r.booking_id: r.p_cancel for r in backoff_scores(df, ("a", "b"), 3.0).collect()}
    assert len(got) == len(rows)
    for bid, a, b, month, _ in rows:
        before = [r for r in rows if r[3] < month]
        p = (sum(r[4] for r in before) + 1) / (len(before) + 2)
        for level in ([r for r in before if r[1] == a], [r for r in before if r[1] == a and r[2] == b]):
            p = (sum(r[4] for r in level) + 3.0 * p) / (len(level) + 3.0)
        assert abs(got[bid] - p) < 1e-12
    assert backoff_scores(df.limit(0), ("a", "b")).count() == 0


def test_backoff_scores_are_many_distinct_values(spark):
    from roomledger.plans.registry import backoff_scored, scored
    sf = "/root/testdata/sf0.01"
    assert backoff_scored(spark, sf).select("p_cancel").distinct().count() >= 1000
    assert set(backoff_scored(spark, sf).columns) == set(scored(spark, sf).columns)

"""Shuffled split, null scores, bins for many levels, early stopping, month bounds, text rounding, shared folder."""

import pytest
from pyspark.sql import functions as F

from roomledger.functions.exprs import as_int
from roomledger.operators import gbt, metrics, splits


def test_hold_out_is_fair_for_neighbours(spark):
    held = [r.h for r in spark.range(40_000).select(splits.shuffled_holdout("id").alias("h"), "id").orderBy("id").collect()]
    assert sum(held) / len(held) == pytest.approx(1 / 4, abs=0.01)
    pairs = [a and b for a, b in zip(held[::2], held[1::2], strict=True)]
    assert sum(pairs) / len(pairs) == pytest.approx(1 / 16, abs=0.01)


def test_null_scores_have_no_rank_at_any_size(spark, monkeypatch):
    rows = [(i % 3 == 0, None if i % 20 == 7 else (i * 37 % 41) / 41) for i in range(42)]
    df = spark.createDataFrame(rows, "is_canceled boolean, p_cancel double")
    whole = metrics.roc_auc(df).first().roc_auc
    monkeypatch.setattr(metrics, "ROWS_PER_RANGE", 7)
    assert metrics.roc_auc(df).first().roc_auc == whole
    scored = [(y, p) for y, p in rows if p is not None]
    wins = [1.0 if a > b else 0.5 if a == b else 0.0 for y, a in scored if y for z, b in scored if not z]
    assert whole == pytest.approx(sum(wins) / len(wins), abs=1e-4)


def test_more_levels_than_bins(spark):
    frame = spark.range(400).select((F.col("id") % 177).cast("string").alias("c"), (F.col("id") % 7).cast("double").alias("x"),
                                    (F.col("id") % 2).cast("double").alias("label"))
    model = gbt.fit_pipeline(frame, ["c"], ["x"], 2, gbt.LearnerSettings(max_depth=2, min_rows_per_leaf=1))
    assert model.stages[-1].getMaxBins() == 178


def test_probe_doubles_until_patience_passes(spark, monkeypatch):
    tried = []

    class Trees:
        def __init__(self, n):
            self.n = n

        def evaluateEachIteration(self, _):
            return [abs(i - 33) for i in range(1, self.n + 1)]  # the 33rd is best

    class Model:
        def __init__(self, n):
            self.stages = [Trees(n)]

    def fit_model(fit, variant, rounds, s, vocab=None):
        tried.append(rounds)
        return Model(rounds), None, [], []

    class Chain:
        def __init__(self, stages):
            pass

        def transform(self, frame):
            return frame

    monkeypatch.setattr(gbt, "fit_model", fit_model)
    monkeypatch.setattr(gbt, "PipelineModel", Chain)
    monkeypatch.setattr(gbt, "_frame", lambda *a, **k: None)
    monkeypatch.setattr(gbt, "arrival_window", lambda *a, **k: None)
    s = gbt.LearnerSettings(first_probe=10, patience=8)
    assert gbt.choose_rounds(None, "a", "b", s=s) == 33
    assert tried == [10, 20, 40, 80]


def test_month_bound_leaves_out_the_scored_month(spark):
    df = spark.createDataFrame([("2001-02-27", "2001-02-01"), ("2001-03-01", "2001-03-01")], "d string, m string").select(
        F.col("d").cast("date").alias("arrival_date"), F.col("m").cast("date").alias("arrival_month"))
    plan = splits.arrival_window(df, end="2001-03-01")
    assert plan.count() == 1
    assert splits.arrival_window(df, end="2001-03-02").count() == 2


def test_fractional_text_is_rounded(spark):
    rows = spark.createDataFrame([("40.5",), ("40.4",), ("-0.5",), ("41.5",), (None,)], "t string")
    kind = rows.schema["t"].dataType
    assert [r.n for r in rows.select(as_int("t", kind).alias("n")).collect()] == [41, 40, -1, 42, None]

"""Walk-forward scoring (F03, L02 shape) with a deterministic scorer, and the scored table (A05 columns).

``prior_rate_scores`` is a transparent stand-in for the boosted model (``roomledger.operators.gbt``):
every booking of segment ``s`` arriving in month ``m`` is scored with the smoothed cancellation rate of
segment ``s`` over all arrivals *before* ``m`` -- exactly the information a model retrained at the start
of month ``m`` would have. Being pure SQL, its scores can be checked by an oracle, and the evaluation
and policy operators downstream are then checked end to end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomledger.operators.joins import checked_broadcast, lookup_join
from roomledger.operators.splits import arrival_window, split_label

# Fixed value: the columns of the scored file.
SCORED_COLUMNS = ["booking_id", "split", "hotel", "arrival_date", "deposit_type", "nights", "adr_eur",
                  "room_revenue_eur", "is_canceled", "p_cancel"]


def prior_rate_scores(fct: DataFrame, key: str = "market_segment", prior_weight: float = 2.0) -> DataFrame:
    """Add ``p_cancel`` = (cancellations + 1) / (bookings + 2) of ``key`` over strictly earlier months.

    The expanding window runs over the (key, month) aggregate, whose size is bounded by
    distinct keys x months, never over bookings; that table is joined back by ``lookup_join``.
    """
    monthly = fct.groupBy(key, "arrival_month").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_canceled")).alias("c"))
    earlier = Window.partitionBy(key).orderBy("arrival_month").rowsBetween(Window.unboundedPreceding, -1)
    prior = monthly.select(
        key, "arrival_month",
        ((F.coalesce(F.sum("c").over(earlier), F.lit(0)) + 1).cast("double")
         / (F.coalesce(F.sum("n").over(earlier), F.lit(0)) + prior_weight).cast("double")).alias("p_cancel"),
    )
    return lookup_join(fct, prior, [key, "arrival_month"])


# Segment keys of the back-off scorer, from the broadest; each level adds one.
BACKOFF_KEYS = ("market_segment", "customer_type", "lead_time_band", "country_code", "hotel", "meal_plan")
BACKOFF_WEIGHT = 10.0


def backoff_scores(fct: DataFrame, keys: tuple[str, ...] = BACKOFF_KEYS, weight: float = BACKOFF_WEIGHT) -> DataFrame:
    """Add ``p_cancel``: the cancellation rate of nested segments over strictly earlier months, each level shrunk to the
    level above it, ``(c + weight * parent) / (n + weight)``; the root is ``(c + 1) / (n + 2)`` over all bookings.

    Bookings are read for one aggregate to (all keys, month) cells; every level is a roll-up of these cells with an
    expanding window over its months. A segment without earlier bookings has its parent's score. Null keys form a
    segment of their own. The cells are joined back to the bookings, broadcast only when measured small.
    """
    cells = fct.groupBy(*keys, "arrival_month").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_canceled")).alias("c"))
    parent = None
    for depth in range(len(keys) + 1):
        own = list(keys[:depth])
        monthly = (cells.groupBy(*own, "arrival_month").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
                   if depth < len(keys) else cells)
        # at the root one row per month; below it at most the cells of one segment go to a task
        earlier = Window.partitionBy(*own).orderBy("arrival_month").rowsBetween(Window.unboundedPreceding, -1)
        sums = monthly.select(*own, "arrival_month", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("double").alias("n"),
                              F.coalesce(F.sum("c").over(earlier), F.lit(0)).cast("double").alias("c"))
        if parent is None:
            parent = sums.select("arrival_month", ((F.col("c") + 1) / (F.col("n") + 2)).alias("p_cancel"))
            continue
        joined = _null_safe_join(sums, parent, [*own[:-1], "arrival_month"])
        parent = joined.select(*own, "arrival_month", ((F.col("c") + F.lit(weight) * F.col("p_cancel"))
                                                       / (F.col("n") + F.lit(weight))).alias("p_cancel"))
    return _null_safe_join(fct, checked_broadcast(parent), [*keys, "arrival_month"])


def _null_safe_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """``left`` with the columns of ``right`` that are not in ``on``; nulls in ``on`` are equal."""
    renamed = right.select(*[F.col(c).alias(f"__on_{n}") for n, c in enumerate(on)], *[c for c in right.columns if c not in on])
    condition = [left[c].eqNullSafe(renamed[f"__on_{n}"]) for n, c in enumerate(on)]
    return left.join(renamed, condition, "left").drop(*[f"__on_{n}" for n in range(len(on))])


def scored_bookings(fct: DataFrame, valid_start: str, test_start: str, scorer=prior_rate_scores) -> DataFrame:
    """Valid and test rows with their score, in the scored-table layout."""
    scored = arrival_window(scorer(fct), start=valid_start)
    return scored.select(*[split_label(valid_start, test_start).alias("split") if c == "split" else F.col(c)
                           for c in SCORED_COLUMNS])

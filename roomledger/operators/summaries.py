"""Dashboard summaries over the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.functions import bool_to_int


def booking_totals(fct: DataFrame) -> DataFrame:
    """One row: bookings, cancellation rate, both revenues, first and last arrival."""
    return fct.agg(
        F.count(F.lit(1)).alias("bookings"),
        F.avg(bool_to_int("is_canceled")).alias("cancellation_rate"),
        F.sum("cancelled_revenue_eur").alias("cancelled_revenue"),
        F.sum("realized_revenue_eur").alias("realized_revenue"),
        F.min("arrival_date").alias("first_arrival"),
        F.max("arrival_date").alias("last_arrival"),
    )


def quality_counters(stg: DataFrame) -> DataFrame:
    """One row of staging counters: rows, each exclusion flag, excluded, identical rows, unknown country."""
    excluded = F.col("dq_negative_adr") | F.col("dq_adr_outlier") | F.col("dq_zero_guests")
    return stg.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.sum(bool_to_int("dq_negative_adr")).alias("negative_adr"),
        F.sum(bool_to_int("dq_adr_outlier")).alias("adr_outlier"),
        F.sum(bool_to_int("dq_zero_guests")).alias("zero_guests"),
        F.sum(bool_to_int(excluded)).alias("excluded"),
        F.sum(bool_to_int("dq_identical_to_another_row")).alias("identical_rows"),
        F.sum(bool_to_int(F.col("country_code") == "UNK")).alias("unknown_country"),
    )


def cancel_timing(fct: DataFrame) -> DataFrame:
    """Per hotel, over cancelled (not no-show) bookings: exact median of days before arrival and the
    share cancelled within the last week. ``percentile`` is exact (interpolated) and keeps a value ->
    count map per group, bounded by the number of distinct day counts."""
    d = F.col("cancelled_days_before_arrival")
    return (fct.filter(F.col("reservation_status") == "Canceled").groupBy("hotel")
            .agg(F.percentile(d, 0.5).alias("median_days"),
                 F.avg(bool_to_int(d <= 7)).alias("share_last_week")))

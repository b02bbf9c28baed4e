"""Fact tables and marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.functions import bool_to_int, lead_time_band, month_floor, month_label, safe_div, sum_if, weekday_name, yes_no_label

FCT_COLUMNS = [
    "booking_id", "hotel", "booking_date", "arrival_date", "arrival_month", "arrival_weekday",
    "lead_time_days", "lead_time_band", "nights", "weekend_nights", "week_nights", "adults", "children",
    "babies", "guests", "meal_plan", "country_code", "market_segment", "distribution_channel",
    "customer_type", "deposit_type", "is_repeated_guest", "previous_cancellations",
    "previous_bookings_not_canceled", "reserved_room_type", "assigned_room_type", "booking_changes",
    "agent_id", "company_id", "days_in_waiting_list", "parking_spaces", "special_requests", "adr_eur",
    "room_revenue_eur", "is_canceled", "is_no_show", "reservation_status", "cancellation_date",
    "cancelled_days_before_arrival", "realized_revenue_eur", "cancelled_revenue_eur",
    "dq_identical_to_another_row",
]


def exclusion_filter(stg: DataFrame) -> Column:
    """Rows kept for analysis: none of the three exclusion flags holds (a null flag drops the row)."""
    return ~F.col("dq_negative_adr") & ~F.col("dq_adr_outlier") & ~F.col("dq_zero_guests")


def kept_bookings(stg: DataFrame) -> DataFrame:
    """Staging minus impossible-price and no-guest rows, with the month by which the facts are stored."""
    return stg.filter(exclusion_filter(stg)).withColumn("arrival_month", month_floor("arrival_date"))


def fct_columns(kept: DataFrame) -> DataFrame:
    """Booking grain of kept rows: weekday, band and money split (narrow; after a shuffle, so they do not move)."""
    c = F.col("is_canceled")
    rev = F.col("room_revenue_eur")
    derived = {
        "arrival_weekday": weekday_name("arrival_date"),
        "lead_time_band": lead_time_band("lead_time_days"),
        "realized_revenue_eur": F.when(c, F.lit(0.0)).otherwise(rev),
        "cancelled_revenue_eur": F.when(c, rev).otherwise(F.lit(0.0)),
    }
    return kept.select(*[derived[n].alias(n) if n in derived else F.col(n) for n in FCT_COLUMNS])


def fct_bookings(stg: DataFrame) -> DataFrame:
    """Booking grain: staging minus impossible-price and no-guest rows, plus month, weekday, band, money split."""
    return fct_columns(kept_bookings(stg))


def room_nights(fct: DataFrame) -> DataFrame:
    """Night grain: one row per booked night (narrow ``explode``; no shuffle).

    The ``nights > 0`` filter is required, not an optimisation: ``sequence(d, d - 1)`` counts down and
    would give two rows for a day-use booking.
    """
    night = F.explode(F.sequence(F.col("arrival_date"), F.date_add(F.col("arrival_date"), F.col("nights") - 1)))
    return fct.filter(F.col("nights") > 0).select(
        "booking_id", "hotel", night.alias("stay_date"), "is_canceled", "adr_eur"
    )


def daily_occupancy(nights: DataFrame) -> DataFrame:
    """Rooms sold / cancelled / booked and revenue per hotel and night."""
    c = F.col("is_canceled")
    return nights.groupBy("hotel", "stay_date").agg(
        F.count_if(~c).alias("rooms_sold"),
        F.count_if(c).alias("rooms_cancelled"),
        F.count(F.lit(1)).alias("rooms_booked"),
        F.coalesce(sum_if(~c, F.col("adr_eur")), F.lit(0.0)).alias("realized_revenue_eur"),
        F.coalesce(sum_if(c, F.col("adr_eur")), F.lit(0.0)).alias("cancelled_revenue_eur"),
    )


def monthly_kpis(fct: DataFrame) -> DataFrame:
    """KPIs per hotel and arrival month; realised ADR is guarded against months with nothing sold."""
    c = F.col("is_canceled")
    sold_nights = sum_if(~c, F.col("nights"))
    return fct.groupBy("hotel", "arrival_month").agg(
        F.count(F.lit(1)).alias("bookings"),
        F.count_if(c).alias("cancellations"),
        F.count_if(F.col("is_no_show")).alias("no_shows"),
        F.avg(bool_to_int(c)).alias("cancellation_rate"),
        sold_nights.alias("room_nights_sold"),
        F.sum("realized_revenue_eur").alias("realized_revenue_eur"),
        F.sum("cancelled_revenue_eur").alias("cancelled_revenue_eur"),
        safe_div(F.sum("realized_revenue_eur"), sold_nights).alias("realized_adr_eur"),
    )


def driver_dimensions() -> dict[str, Column]:
    """Booking-time attributes the cancellation drivers are sliced by (name -> label expression)."""
    return {
        "hotel": F.col("hotel"),
        "market_segment": F.col("market_segment"),
        "distribution_channel": F.col("distribution_channel"),
        "deposit_type": F.col("deposit_type"),
        "customer_type": F.col("customer_type"),
        "lead_time_band": F.col("lead_time_band"),
        "repeat_guest": yes_no_label(F.col("is_repeated_guest"), "Repeat guest", "First stay"),
        "previous_cancellations": yes_no_label(F.col("previous_cancellations") == 0, "None", "1 or more"),
        "special_requests": yes_no_label(F.col("special_requests") == 0, "None", "1 or more"),
        "arrival_month": month_label("arrival_date"),
    }


def _driver_measures() -> list[Column]:
    c = F.col("is_canceled")
    return [
        F.count(F.lit(1)).alias("bookings"),
        F.count_if(c).alias("cancellations"),
        F.avg(bool_to_int(c)).alias("cancellation_rate"),
        F.sum("cancelled_revenue_eur").alias("cancelled_revenue_eur"),
    ]


def cancellation_drivers(fct: DataFrame, dims: dict[str, Column] | None = None) -> DataFrame:
    """Long-format drivers (dimension, value) in ONE scan.

    Each row is fanned out to one (dimension, value) pair per dimension by a narrow ``explode`` and
    aggregated once; the partial aggregate runs in the same stage, so the shuffle carries one row per
    (dimension, value) per task instead of ten scans of the fact table.
    """
    dims = dims or driver_dimensions()
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("dimension"), expr.cast("string").alias("value"))
        for name, expr in dims.items()
    ]))
    fanned = fct.select(pairs.alias("d"), "is_canceled", "cancelled_revenue_eur")
    return (fanned.groupBy(F.col("d.dimension").alias("dimension"), F.col("d.value").alias("value"))
            .agg(*_driver_measures()))


def cancellation_drivers_union(fct: DataFrame, dims: dict[str, Column] | None = None) -> DataFrame:
    """Literal form: one grouped select per dimension, ``union all`` (H01). Same rows as the one-pass form."""
    dims = dims or driver_dimensions()
    parts = [
        fct.groupBy(F.lit(name).alias("dimension"), expr.cast("string").alias("value")).agg(*_driver_measures())
        for name, expr in dims.items()
    ]
    return reduce(DataFrame.unionByName, parts)

"""Raw bookings derived from the driver tables (``orders`` joined to ``customer``).

The reference reads one CSV of bookings; that file is not available, so a booking table with the same
raw columns is derived from the TPC-H-like tables by integer arithmetic on the keys. Every rule below
is also written as DuckDB SQL in ``roomledger.oracle.sql`` so both engines see identical rows.

``k = o_orderkey``, ``u = o_custkey``. Rows with ``k % 100 = 0`` appear twice (planted identical
rows); ``booking_id`` is ``2k`` for the first copy and ``2k + 1`` for the second. The copy is made by a
narrow ``explode`` inside the scan stage, not by a second scan and a union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.session import table_path

# Fixed values of the fixture (FIXTURES.md §3), in order of the code they are picked by.
MEALS = ["BB", "HB", "FB", "SC", "Undefined"]
CUSTOMER_TYPES = ["Transient", "Contract", "Group", "Transient-Party"]
ROOM_LETTERS = "ABCDEFGH"
# Split dates of the fixture (its arrivals run 1995-01-01 .. 2001-08-01).
VALID_START = "2000-09-01"
TEST_START = "2001-01-01"
FIRST_ARRIVAL = "1995-01-01"
LAST_ARRIVAL = "2001-08-31"


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def raw_bookings(orders: DataFrame, customer: DataFrame, faulty: bool = False) -> DataFrame:
    """Raw booking rows with the source column names; ``faulty=True`` plants data-quality faults.

    Faults (each found by exactly one rule): the second copy of a twin keeps id ``2k`` (duplicate key);
    ``hotel = 'Hostel'`` when ``k % 701 = 0``; no arrival date parts when ``k % 809 = 0``; a cancelled
    booking with ``k % 613 = 0`` gets a status date one day after arrival.
    """
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")

    k = F.col("o_orderkey")
    u = F.col("o_custkey")
    copy = F.explode(F.when(k % 100 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    # Quantities used by several columns are computed once, as named columns, so the final projection
    # refers to them instead of repeating their expressions.
    lead_time = (k * 37) % 400
    deposit = (F.when(k % 8 == 0, F.lit("Non Refund"))
               .when(k % 50 == 1, F.lit("Refundable"))
               .otherwise(F.lit("No Deposit")))
    j = j.select("*", copy.alias("copy_no"), lead_time.alias("__lead"), deposit.alias("__deposit"),
                 F.col("o_orderdate").cast("date").alias("__arrival"))
    j = j.select("*", ((F.col("o_orderstatus") == "F")
                       | ((F.col("__lead") > 250) & (F.col("__deposit") == "Non Refund"))).alias("__canceled"))
    j = j.select("*", F.when(~F.col("__canceled"), F.lit("Check-Out"))
                 .when(k % 20 == 1, F.lit("No-Show")).otherwise(F.lit("Canceled")).alias("__status"))

    lead_time, deposit, canceled = F.col("__lead"), F.col("__deposit"), F.col("__canceled")
    arrival, status = F.col("__arrival"), F.col("__status")
    weekend = k % 3
    week = (k * 7) % 5
    nights = weekend + week
    status_date = (F.when(status == "Check-Out",
                          F.date_add(arrival, (nights + F.when(k % 499 == 0, 1).otherwise(0)).cast("int")))
                   .when(status == "No-Show", arrival)
                   .otherwise(F.date_sub(arrival, (k % (lead_time + 1)).cast("int"))))
    adr = (F.when(k % 997 == 0, F.lit(-1.0))
           .when(k % 991 == 0, F.lit(5400.0))
           .otherwise((k % 4000) / 8.0))

    booking_id = 2 * k + F.col("copy_no")
    hotel = F.when(u % 3 == 0, F.lit("Resort Hotel")).otherwise(F.lit("City Hotel"))
    year = F.year(arrival)
    month = F.date_format(arrival, "MMMM")
    day = F.dayofmonth(arrival)
    if faulty:
        booking_id = 2 * k
        hotel = F.when(k % 701 == 0, F.lit("Hostel")).otherwise(hotel)
        missing = k % 809 == 0
        year = F.when(~missing, year)
        month = F.when(~missing, month)
        day = F.when(~missing, day)
        status_date = F.when((status == "Canceled") & (k % 613 == 0), F.date_add(arrival, 1)).otherwise(status_date)

    return j.select(
        booking_id.alias("booking_id"),
        hotel.alias("hotel"),
        canceled.cast("int").alias("is_canceled"),
        lead_time.cast("int").alias("lead_time"),
        year.alias("arrival_date_year"),
        month.alias("arrival_date_month"),
        day.alias("arrival_date_day_of_month"),
        weekend.cast("int").alias("stays_in_weekend_nights"),
        week.cast("int").alias("stays_in_week_nights"),
        ((u * 11) % 4).cast("int").alias("adults"),
        F.when(k % 10 != 0, k % 2).cast("int").alias("children"),
        F.when(k % 50 == 0, 1).otherwise(0).alias("babies"),
        _pick(k % 5, MEALS).alias("meal"),
        F.when(u % 97 != 0, F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).alias("country"),
        F.col("c_mktsegment").alias("market_segment"),
        F.col("o_orderpriority").alias("distribution_channel"),
        (u % 10 == 0).cast("int").alias("is_repeated_guest"),
        F.when(u % 7 == 0, k % 3).otherwise(0).cast("int").alias("previous_cancellations"),
        (u % 4).cast("int").alias("previous_bookings_not_canceled"),
        F.substring(F.lit(ROOM_LETTERS), ((k % 7) + 1).cast("int"), 1).alias("reserved_room_type"),
        F.substring(F.lit(ROOM_LETTERS), ((k % 7) + 1 + F.when(k % 11 == 0, 1).otherwise(0)).cast("int"), 1)
        .alias("assigned_room_type"),
        F.when(k % 4 == 0, 1).otherwise(0).alias("booking_changes"),
        deposit.alias("deposit_type"),
        F.when(u % 6 != 0, u % 60).cast("int").alias("agent"),
        F.when(u % 25 == 0, u % 40).cast("int").alias("company"),
        F.when(k % 30 == 0, k % 90).otherwise(0).cast("int").alias("days_in_waiting_list"),
        _pick(u % 4, CUSTOMER_TYPES).alias("customer_type"),
        adr.alias("adr"),
        F.when(~canceled & (k % 12 == 0), 1).otherwise(0).alias("required_car_parking_spaces"),
        (k % 6).cast("int").alias("total_of_special_requests"),
        status.alias("reservation_status"),
        status_date.alias("reservation_status_date"),
    )


def load_raw_bookings(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    orders = spark.read.parquet(table_path(sf_dir, "orders"))
    customer = spark.read.parquet(table_path(sf_dir, "customer"))
    return raw_bookings(orders, customer, faulty=faulty)

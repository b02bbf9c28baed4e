"""Staging: raw rows -> typed, renamed, derived and flagged rows; same row count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.functions import as_int, parse_month_name_date
from roomledger.operators.joins import is_small, measured_broadcast
from roomledger.operators.rowid import with_row_id
from roomledger.session import checkpoint_root, scratch_path

DEFAULT_ADR_CEILING = 1000.0
HOT_ROWS = 100_000  # rows of one digest from which its keys are folded per task before they move
DIGEST = ["__digest_a", "__digest_b"]  # of the twin key, stored with each row while twins are looked for

# Columns that make two staged rows "identical" (everything but the surrogate key and derived columns).
TWIN_KEY = [
    "hotel", "is_canceled", "lead_time_days", "arrival_date", "weekend_nights", "week_nights",
    "adults", "children", "babies", "meal_plan", "country_code", "market_segment", "distribution_channel",
    "is_repeated_guest", "previous_cancellations", "previous_bookings_not_canceled",
    "reserved_room_type", "assigned_room_type", "booking_changes", "deposit_type", "agent_id",
    "company_id", "days_in_waiting_list", "customer_type", "adr_eur", "parking_spaces",
    "special_requests", "reservation_status", "reservation_status_date",
]


def _typed(raw: DataFrame) -> DataFrame:
    types = {f.name: f.dataType for f in raw.schema.fields}

    def i(name: str) -> Column:
        return as_int(F.col(name), types.get(name))

    def flag(name: str) -> Column:
        return i(name) == 1

    return raw.select(
        F.col("booking_id").cast("long").alias("booking_id"),
        F.col("hotel"),
        flag("is_canceled").alias("is_canceled"),
        (F.col("reservation_status") == "No-Show").alias("is_no_show"),
        i("lead_time").alias("lead_time_days"),
        parse_month_name_date(i("arrival_date_year"), F.col("arrival_date_month"),
                              i("arrival_date_day_of_month")).alias("arrival_date"),
        i("stays_in_weekend_nights").alias("weekend_nights"),
        i("stays_in_week_nights").alias("week_nights"),
        i("adults").alias("adults"),
        F.coalesce(i("children"), F.lit(0)).alias("children"),
        i("babies").alias("babies"),
        F.when(F.col("meal") == "Undefined", F.lit("SC")).otherwise(F.col("meal")).alias("meal_plan"),
        F.coalesce(F.col("country"), F.lit("UNK")).alias("country_code"),
        F.col("market_segment"),
        F.col("distribution_channel"),
        flag("is_repeated_guest").alias("is_repeated_guest"),
        i("previous_cancellations").alias("previous_cancellations"),
        i("previous_bookings_not_canceled").alias("previous_bookings_not_canceled"),
        F.col("reserved_room_type"),
        F.col("assigned_room_type"),
        i("booking_changes").alias("booking_changes"),
        F.col("deposit_type"),
        i("agent").alias("agent_id"),
        i("company").alias("company_id"),
        i("days_in_waiting_list").alias("days_in_waiting_list"),
        F.col("customer_type"),
        F.col("adr").cast("double").alias("adr_eur"),
        i("required_car_parking_spaces").alias("parking_spaces"),
        i("total_of_special_requests").alias("special_requests"),
        F.col("reservation_status"),
        F.col("reservation_status_date").cast("date").alias("reservation_status_date"),
    )


def stage_bookings(raw: DataFrame, adr_ceiling: float = DEFAULT_ADR_CEILING) -> DataFrame:
    """``stg_bookings``: one row per raw row, typed, with derived dates, revenue and DQ flags."""
    if "booking_id" not in raw.columns:
        raw = with_row_id(raw, "booking_id")
    t = flag_identical_rows(_typed(raw), TWIN_KEY)  # before the derived columns, which it would only store and move
    flag = t.columns[-1]
    nights = F.col("weekend_nights") + F.col("week_nights")
    guests = F.col("adults") + F.col("children") + F.col("babies")
    return t.select(
        *t.columns[:-1],
        F.date_sub(F.col("arrival_date"), F.col("lead_time_days")).alias("booking_date"),
        nights.alias("nights"),
        guests.alias("guests"),
        (F.col("adr_eur") * nights).alias("room_revenue_eur"),
        F.when(F.col("is_canceled"), F.col("reservation_status_date")).alias("cancellation_date"),
        F.when(F.col("is_canceled"), F.datediff(F.col("arrival_date"), F.col("reservation_status_date")))
        .alias("cancelled_days_before_arrival"),
        (F.col("adr_eur") < 0).alias("dq_negative_adr"),
        (F.col("adr_eur") > F.lit(float(adr_ceiling))).alias("dq_adr_outlier"),
        (guests == 0).alias("dq_zero_guests"),
        flag,
    )


def flag_identical_rows(df: DataFrame, key: list[str], flag: str = "dq_identical_to_another_row") -> DataFrame:
    """``count(*) over (partition by key) > 1`` in one read of ``df`` and without putting a whole hot group into one task.

    The rows are written once to the shared folder with a 128-bit digest of ``key`` (null-safe). Counting then reads and
    shuffles 16 bytes a row instead of the key columns. Only rows of repeated digests are compared on the key columns
    themselves. While the table of repeated digests measures small it is broadcast and no row without a twin is shuffled
    or sorted (:func:`_flag_in_place`). Else all rows move once, by digest, and are counted where they arrive; rows of a
    digest of over ``HOT_ROWS`` rows stay in place, as there are few such digests at any size.
    """
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in key])
    path = scratch_path(df.sparkSession, "rows-with-digest")
    digested = df.select("*", F.xxhash64(nulls, *key).alias(DIGEST[0]), F.xxhash64(*reversed(key), nulls).alias(DIGEST[1]))
    digested.write.parquet(path)
    rows = df.sparkSession.read.schema(digested.schema).parquet(path)
    checkpoint_root(df.sparkSession)
    repeated = rows.groupBy(*DIGEST).count().filter(F.col("count") > 1).checkpoint(eager=True)
    if is_small(repeated):
        return _flag_in_place(rows, repeated, key, flag)
    hot = repeated.filter(F.col("count") > HOT_ROWS)
    if hot.isEmpty():
        return _flag_moved(rows, key, flag)
    few = measured_broadcast(hot.select(*DIGEST))
    return (_flag_moved(rows.join(few, DIGEST, "left_anti"), key, flag)
            .unionByName(_flag_in_place(rows.join(few, DIGEST, "left_semi"), hot, key, flag)))


def _flag_moved(rows: DataFrame, key: list[str], flag: str) -> DataFrame:
    """``rows`` in partitions by digest, each flagged by the count of its digest and key: one shuffle, no join."""
    same = Window.partitionBy(*DIGEST, *key)
    moved = rows.repartition(*DIGEST)
    return moved.withColumn(flag, F.count(F.lit(1)).over(same) > 1).drop(*DIGEST)


def _flag_in_place(rows: DataFrame, repeated: DataFrame, key: list[str], flag: str) -> DataFrame:
    """``rows`` flagged by joins with tables of ``repeated`` digests; only keys of rows with such a digest move.

    They move to partitions by digest, so a task's keys are those of its partition and counting the keys of a digest moves
    nothing; a digest of over ``HOT_ROWS`` rows is folded to one row per task and key before it moves. A digest with a
    single key flags its rows by digest alone, of digests that collide the repeated keys are joined back, null-safe on
    every column like ``partition by``.
    """
    def keys_of(digests: DataFrame, by_digest: bool) -> DataFrame:
        found = rows.select(*DIGEST, *key).join(measured_broadcast(digests.select(*DIGEST)), DIGEST, "left_semi")
        if by_digest:
            found = found.repartition(*DIGEST)
        return found.groupBy(*DIGEST, *key).agg(F.count(F.lit(1)).alias("__n"))

    def digest_keys(digests: DataFrame, by_digest: bool) -> DataFrame:
        return keys_of(digests, by_digest).groupBy(*DIGEST).agg(F.count(F.lit(1)).alias("__keys"))

    digests = (digest_keys(repeated.filter(F.col("count") <= HOT_ROWS), True)
               .unionByName(digest_keys(repeated.filter(F.col("count") > HOT_ROWS), False)).checkpoint(eager=True))
    alone = digests.filter(F.col("__keys") == 1).select(*[F.col(c).alias(f"__of{c}") for c in DIGEST], F.lit(True).alias("__twin"))
    shared = (keys_of(digests.filter(F.col("__keys") > 1), False).filter(F.col("__n") > 1)
              .select(*[F.col(c).alias(f"__twin_{n}") for n, c in enumerate([*DIGEST, *key])], F.lit(True).alias("__twin_hit"))
              .checkpoint(eager=True))
    same_digest = [rows[c] == alone[f"__of{c}"] for c in DIGEST]
    same_key = ([rows[c] == shared[f"__twin_{n}"] for n, c in enumerate(DIGEST)]
                + [rows[c].eqNullSafe(shared[f"__twin_{n}"]) for n, c in enumerate(key, len(DIGEST))])
    joined = rows.join(measured_broadcast(alone), same_digest, "left").join(measured_broadcast(shared), same_key, "left")
    return joined.select(*[rows[c] for c in rows.columns if c not in DIGEST],
                         F.coalesce(F.col("__twin"), F.col("__twin_hit"), F.lit(False)).alias(flag))

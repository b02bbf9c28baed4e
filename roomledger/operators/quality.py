"""Data-quality rules (J01-J17). Each rule returns the offending rows: an empty result is a pass.

Reconciliations (J09, J12-J16) also have a ``*_check`` form returning one row with both sides and an
``ok`` flag, so a passing check is visible; the rule form is that row filtered to ``not ok``. Scalars
from a second table are attached with ``DataFrame.scalar()`` (a scalar subquery), not a cross join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.functions import bool_to_int
from roomledger.functions.exprs import LEAD_TIME_BANDS, LEAD_TIME_TOP_BAND
from roomledger.session import checkpoint_root

# ---- generic column rules ---------------------------------------------------------------------------


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` seen more than once (nulls ignored), with their count ``n``."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Distinct values outside ``values`` with their row count; nulls pass."""
    c = F.col(column)
    return (df.filter(c.isNotNull() & ~c.isin(values)).groupBy(c.alias("value"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null key has no parent row (left anti join)."""
    keys = parent.select(F.col(field).alias("__parent_key")).filter(F.col("__parent_key").isNotNull())
    return child.filter(F.col(column).isNotNull()).join(
        keys, F.col(column) == F.col("__parent_key"), "left_anti")


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0)


def between_zero_and_one(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~F.col(column).between(0, 1))


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations seen more than once (null keys group together), with count ``n``."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


# ---- singular rules ---------------------------------------------------------------------------------


def arrivals_outside_window(stg: DataFrame, first: str, last: str) -> DataFrame:
    d = F.col("arrival_date")
    return stg.filter(~d.between(F.lit(first).cast("date"), F.lit(last).cast("date"))).select("booking_id", "arrival_date")


def cancellations_after_arrival(stg: DataFrame) -> DataFrame:
    return (stg.filter((F.col("reservation_status") == "Canceled") & (F.col("cancellation_date") > F.col("arrival_date")))
            .select("booking_id", "arrival_date", "cancellation_date"))


def checkout_mismatch(stg: DataFrame) -> DataFrame:
    """Checked-out bookings not leaving on arrival + nights (a warning in the reference run)."""
    expected = F.date_add(F.col("arrival_date"), F.col("nights"))
    return (stg.filter((F.col("reservation_status") == "Check-Out") & (F.col("reservation_status_date") != expected))
            .select("booking_id", "arrival_date", "nights", "reservation_status_date"))


def _count(df: DataFrame) -> Column:
    return df.select(F.count(F.lit(1))).scalar()


def row_conservation_check(source: DataFrame, stg: DataFrame) -> DataFrame:
    out = source.agg(F.count(F.lit(1)).alias("source_rows")).withColumn("staging_rows", _count(stg))
    return out.withColumn("ok", F.col("source_rows") == F.col("staging_rows"))


def exclusions_check(stg: DataFrame, fct: DataFrame) -> DataFrame:
    """staged = kept + excluded, with staged and excluded from one conditional aggregate over staging."""
    excluded = F.col("dq_negative_adr") | F.col("dq_adr_outlier") | F.col("dq_zero_guests")
    out = (stg.agg(F.count(F.lit(1)).alias("staged"), F.count_if(excluded).alias("excluded"))
           .withColumn("kept", _count(fct)))
    return out.select("staged", "kept", "excluded",
                      (F.col("staged") == F.col("kept") + F.col("excluded")).alias("ok"))


def driver_slices_check(drivers: DataFrame, fct: DataFrame) -> DataFrame:
    """Per dimension: bookings summed over its values against all bookings."""
    out = (drivers.groupBy("dimension").agg(F.sum("bookings").alias("bookings"))
           .withColumn("expected", _count(fct)))
    return out.withColumn("ok", F.col("bookings") == F.col("expected"))


def monthly_reconcile_check(fct: DataFrame, monthly: DataFrame) -> DataFrame:
    m = monthly.agg(F.sum("bookings").alias("b"), F.sum("cancellations").alias("c"),
                    F.sum("realized_revenue_eur").alias("r"))
    out = fct.agg(
        F.count(F.lit(1)).alias("fct_bookings"),
        F.sum(bool_to_int("is_canceled")).alias("fct_cancellations"),
        F.sum("realized_revenue_eur").alias("fct_revenue"),
    ).select("*", m.select("b").scalar().alias("mart_bookings"), m.select("c").scalar().alias("mart_cancellations"),
             m.select("r").scalar().alias("mart_revenue"))
    ok = ((F.col("fct_bookings") == F.col("mart_bookings")) & (F.col("fct_cancellations") == F.col("mart_cancellations"))
          & (F.abs(F.col("fct_revenue") - F.col("mart_revenue")) <= 0.01))
    return out.withColumn("ok", ok)


def night_revenue_check(fct: DataFrame, occupancy: DataFrame) -> DataFrame:
    n = occupancy.agg(F.sum("realized_revenue_eur").alias("r"), F.sum("cancelled_revenue_eur").alias("c"))
    out = fct.agg(F.sum("realized_revenue_eur").alias("booking_realized"),
                  F.sum("cancelled_revenue_eur").alias("booking_cancelled")).select(
        "*", n.select("r").scalar().alias("night_realized"), n.select("c").scalar().alias("night_cancelled"))
    ok = ((F.abs(F.col("booking_realized") - F.col("night_realized")) <= 0.01)
          & (F.abs(F.col("booking_cancelled") - F.col("night_cancelled")) <= 0.01))
    return out.withColumn("ok", ok)


def night_count_check(fct: DataFrame, nights: DataFrame) -> DataFrame:
    out = fct.agg(F.sum("nights").alias("expected")).withColumn("actual", _count(nights))
    return out.withColumn("ok", F.col("expected") == F.col("actual"))


def failing(check: DataFrame) -> DataFrame:
    """Rule form of a ``*_check``: the rows that do not reconcile."""
    return check.filter(~F.col("ok")).drop("ok")


# ---- the rule set of one warehouse run, and its summary (J17) ----------------------------------------

# Fixed values (must equal the reference): accepted value domains of the staged and fact columns.
HOTELS = ["City Hotel", "Resort Hotel"]
DEPOSIT_TYPES = ["No Deposit", "Non Refund", "Refundable"]
RESERVATION_STATUSES = ["Check-Out", "Canceled", "No-Show"]
MEAL_PLANS = ["BB", "HB", "FB", "SC"]
LEAD_TIME_BAND_LABELS = [label for _, label in LEAD_TIME_BANDS] + [LEAD_TIME_TOP_BAND]


@dataclass(frozen=True)
class Rule:
    name: str
    failures: DataFrame
    severity: str = "error"


def warehouse_rules(wh, first_arrival: str, last_arrival: str) -> list[Rule]:
    """The 28 tests of one run (19 column tests + 9 singular), each as a DataFrame of failing rows."""
    stg, fct, nights, occ, monthly, drivers, raw = wh.stg, wh.fct, wh.nights, wh.occupancy, wh.monthly, wh.drivers, wh.raw
    return [
        Rule("unique_stg_bookings_booking_id", unique(stg, "booking_id")),
        Rule("not_null_stg_bookings_booking_id", not_null(stg, "booking_id")),
        Rule("accepted_values_stg_bookings_hotel", accepted_values(stg, "hotel", HOTELS)),
        Rule("not_null_stg_bookings_arrival_date", not_null(stg, "arrival_date")),
        Rule("accepted_values_stg_bookings_deposit_type", accepted_values(stg, "deposit_type", DEPOSIT_TYPES)),
        Rule("accepted_values_stg_bookings_reservation_status",
             accepted_values(stg, "reservation_status", RESERVATION_STATUSES)),
        Rule("accepted_values_stg_bookings_meal_plan", accepted_values(stg, "meal_plan", MEAL_PLANS)),
        Rule("unique_fct_bookings_booking_id", unique(fct, "booking_id")),
        Rule("not_null_fct_bookings_booking_id", not_null(fct, "booking_id")),
        Rule("not_null_fct_bookings_arrival_date", not_null(fct, "arrival_date")),
        Rule("non_negative_fct_bookings_nights", non_negative(fct, "nights")),
        Rule("non_negative_fct_bookings_adr_eur", non_negative(fct, "adr_eur")),
        Rule("accepted_values_fct_bookings_lead_time_band",
             accepted_values(fct, "lead_time_band", LEAD_TIME_BAND_LABELS)),
        Rule("relationships_fct_room_nights_booking_id", relationships(nights, "booking_id", fct, "booking_id")),
        Rule("unique_combination_mart_daily_occupancy", unique_combination(occ, ["hotel", "stay_date"])),
        Rule("unique_combination_mart_monthly_kpis", unique_combination(monthly, ["hotel", "arrival_month"])),
        Rule("between_zero_and_one_mart_monthly_kpis_cancellation_rate",
             between_zero_and_one(monthly, "cancellation_rate")),
        Rule("unique_combination_mart_cancellation_drivers", unique_combination(drivers, ["dimension", "value"])),
        Rule("between_zero_and_one_mart_cancellation_drivers_cancellation_rate",
             between_zero_and_one(drivers, "cancellation_rate")),
        Rule("assert_arrivals_inside_published_window", arrivals_outside_window(stg, first_arrival, last_arrival)),
        Rule("assert_cancellations_happen_before_arrival", cancellations_after_arrival(stg)),
        Rule("assert_checkout_matches_stay_length", checkout_mismatch(stg), severity="warn"),
        Rule("assert_driver_slices_cover_every_booking", failing(driver_slices_check(drivers, fct))),
        Rule("assert_exclusions_account_for_every_row", failing(exclusions_check(stg, fct))),
        Rule("assert_monthly_kpis_reconcile", failing(monthly_reconcile_check(fct, monthly))),
        Rule("assert_room_night_revenue_reconciles", failing(night_revenue_check(fct, occ))),
        Rule("assert_room_nights_match_stay_lengths", failing(night_count_check(fct, nights))),
        Rule("assert_staging_keeps_every_source_row", failing(row_conservation_check(raw, stg))),
    ]


def rule_results(rules: list[Rule]) -> DataFrame:
    """One row per rule: ``test``, ``severity``, ``failures``, ``status`` (pass / warn / fail).

    Built as one plan (a union of per-rule counts), so a single job evaluates all rules.
    """
    parts = [r.failures.agg(F.count(F.lit(1)).alias("failures"))
             .select(F.lit(r.name).alias("test"), F.lit(r.severity).alias("severity"), "failures")
             for r in rules]
    res = reduce(DataFrame.unionByName, parts)
    status = (F.when(F.col("failures") == 0, F.lit("pass"))
              .when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail")))
    return res.withColumn("status", status)


def run_summary(results: DataFrame, models: int) -> DataFrame:
    """Counts by status (J17): tests, passed, warned, failed (errors count as failed), models."""
    s = F.col("status")
    return results.agg(
        F.count(F.lit(1)).alias("tests"),
        F.count_if(s == "pass").alias("passed"),
        F.count_if(s == "warn").alias("warned"),
        F.count_if(s.isin("fail", "error")).alias("failed"),
    ).withColumn("models", F.lit(models).cast("long"))


def run_warnings(results: DataFrame) -> DataFrame:
    """The warnings list of the summary: test name and failure count."""
    return results.filter(F.col("status") == "warn").select("test", "failures")


# ---- run log (the runner's JSON record of a run) and its summary ------------------------------------

WAREHOUSE_MODEL_NAMES = ["stg_bookings", "fct_bookings", "fct_room_nights", "mart_daily_occupancy",
                         "mart_monthly_kpis", "mart_cancellation_drivers"]


def run_log(results: DataFrame, project: str = "warehouse", models: list[str] | None = None) -> DataFrame:
    """One-row run-log document: ``results`` = array of (unique_id, status, failures) for every test
    (``test.<project>.<name>``) and every built model (``model.<project>.<name>``, status ``success``).
    The array holds one entry per rule and model of the run (a few dozen)."""
    models = WAREHOUSE_MODEL_NAMES if models is None else models
    entry = "struct<unique_id:string,status:string,failures:bigint>"
    tests = results.select(F.struct(
        F.concat(F.lit(f"test.{project}."), F.col("test")).alias("unique_id"),
        F.col("status"), F.col("failures").cast("long").alias("failures")).alias("r"))
    built = F.array(*[F.struct(F.lit(f"model.{project}.{m}").alias("unique_id"), F.lit("success").alias("status"),
                               F.lit(None).cast("long").alias("failures")) for m in models]).cast(f"array<{entry}>")
    return tests.agg(F.concat(F.sort_array(F.collect_list("r")), built).alias("results"))


def summary_from_run_log(log: DataFrame) -> DataFrame:
    """J17 from a run log: tests, passed, warned, failed (fail + error), models."""
    r = log.select(F.explode("results").alias("r")).select("r.*")
    is_test = F.col("unique_id").startswith("test.")
    s = F.col("status")
    return r.agg(
        F.count_if(is_test).alias("tests"),
        F.count_if(is_test & (s == "pass")).alias("passed"),
        F.count_if(is_test & (s == "warn")).alias("warned"),
        F.count_if(is_test & s.isin("fail", "error")).alias("failed"),
        F.count_if(F.col("unique_id").startswith("model.")).alias("models"),
    )


def warnings_from_run_log(log: DataFrame) -> DataFrame:
    """The warning entries of a run log: test name (third dotted part) and failure count."""
    r = log.select(F.explode("results").alias("r")).select("r.*")
    return (r.filter(F.col("unique_id").startswith("test.") & (F.col("status") == "warn"))
            .select(F.element_at(F.split("unique_id", r"\."), 3).alias("test"), "failures"))


# ---- the same 28 tests with fewer passes over the big tables ------------------------------------------

def _unpivot(one_row: DataFrame, names: list[str]) -> DataFrame:
    """One-row frame of counts -> (test, failures) rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("test"), F.col(n).cast("long").alias("failures"))
                                for n in names]))
    return one_row.select(pairs.alias("p")).select("p.test", "p.failures")


def _offending_values(col: str, values: list) -> Column:
    c = F.col(col)
    return F.count_distinct(F.when(c.isNotNull() & ~c.isin(values), c))


def fused_rule_results(wh, first_arrival: str, last_arrival: str) -> DataFrame:
    """``rule_results(warehouse_rules(...))`` computed with one conditional aggregate per large table.

    Staging is read twice (one aggregate of counts of offending rows, distinct offending values and the
    sums the reconciliations need, plus one group-by for key uniqueness) and the facts three times (the
    same two, plus the parent side of the orphan check). The two one-row aggregates are checkpointed
    and every reconciliation reads them. The nights are read by the anti join and a count; the marts
    are small and keep the per-rule form. Same rows as the per-rule run (``tests/test_quality.py``).
    """
    stg, fct, nights, raw = wh.stg, wh.fct, wh.nights, wh.raw
    d = F.col("arrival_date")
    excluded = F.col("dq_negative_adr") | F.col("dq_adr_outlier") | F.col("dq_zero_guests")
    s = stg.agg(
        F.count_if(F.col("booking_id").isNull()).alias("not_null_stg_bookings_booking_id"),
        _offending_values("hotel", HOTELS).alias("accepted_values_stg_bookings_hotel"),
        F.count_if(d.isNull()).alias("not_null_stg_bookings_arrival_date"),
        _offending_values("deposit_type", DEPOSIT_TYPES).alias("accepted_values_stg_bookings_deposit_type"),
        _offending_values("reservation_status", RESERVATION_STATUSES)
        .alias("accepted_values_stg_bookings_reservation_status"),
        _offending_values("meal_plan", MEAL_PLANS).alias("accepted_values_stg_bookings_meal_plan"),
        F.count_if(~d.between(F.lit(first_arrival).cast("date"), F.lit(last_arrival).cast("date")))
        .alias("assert_arrivals_inside_published_window"),
        F.count_if((F.col("reservation_status") == "Canceled") & (F.col("cancellation_date") > d))
        .alias("assert_cancellations_happen_before_arrival"),
        F.count_if((F.col("reservation_status") == "Check-Out")
                   & (F.col("reservation_status_date") != F.date_add(d, F.col("nights"))))
        .alias("assert_checkout_matches_stay_length"),
        F.count(F.lit(1)).alias("__staged"), F.count_if(excluded).alias("__excluded"),
    )
    f = fct.agg(
        F.count_if(F.col("booking_id").isNull()).alias("not_null_fct_bookings_booking_id"),
        F.count_if(d.isNull()).alias("not_null_fct_bookings_arrival_date"),
        F.count_if(F.col("nights") < 0).alias("non_negative_fct_bookings_nights"),
        F.count_if(F.col("adr_eur") < 0).alias("non_negative_fct_bookings_adr_eur"),
        _offending_values("lead_time_band", LEAD_TIME_BAND_LABELS).alias("accepted_values_fct_bookings_lead_time_band"),
        F.count(F.lit(1)).alias("__kept"), F.sum(bool_to_int("is_canceled")).alias("__cancellations"),
        F.sum("realized_revenue_eur").alias("__realized"), F.sum("cancelled_revenue_eur").alias("__cancelled"),
        F.sum("nights").alias("__nights"),
    )
    # both one-row results feed several checks: computed once, kept in the shared checkpoint folder
    checkpoint_root(stg.sparkSession)
    s, f = s.checkpoint(eager=True), f.checkpoint(eager=True)
    kept = f.select("__kept").scalar()
    m = wh.monthly.agg(F.sum("bookings").alias("b"), F.sum("cancellations").alias("c"),
                       F.sum("realized_revenue_eur").alias("r"))
    o = wh.occupancy.agg(F.sum("realized_revenue_eur").alias("r"), F.sum("cancelled_revenue_eur").alias("c"))
    recon = f.select(
        F.when((F.col("__kept") != m.select("b").scalar()) | (F.col("__cancellations") != m.select("c").scalar())
               | (F.abs(F.col("__realized") - m.select("r").scalar()) > 0.01), 1).otherwise(0)
        .alias("assert_monthly_kpis_reconcile"),
        F.when((F.abs(F.col("__realized") - o.select("r").scalar()) > 0.01)
               | (F.abs(F.col("__cancelled") - o.select("c").scalar()) > 0.01), 1).otherwise(0)
        .alias("assert_room_night_revenue_reconciles"),
        F.when(F.col("__nights") != nights.select(F.count(F.lit(1))).scalar(), 1).otherwise(0)
        .alias("assert_room_nights_match_stay_lengths"),
    )
    s_recon = s.select(
        F.when(F.col("__staged") != kept + F.col("__excluded"), 1).otherwise(0)
        .alias("assert_exclusions_account_for_every_row"),
        F.when(F.col("__staged") != raw.select(F.count(F.lit(1))).scalar(), 1).otherwise(0)
        .alias("assert_staging_keeps_every_source_row"),
    )
    slices = (wh.drivers.groupBy("dimension").agg(F.sum("bookings").alias("b"))
              .agg(F.count_if(F.col("b") != kept).alias("assert_driver_slices_cover_every_booking")))
    per_rule = {r.name: r for r in warehouse_rules(wh, first_arrival, last_arrival)}
    counted = [
        _unpivot(s, [c for c in s.columns if not c.startswith("__")]),
        _unpivot(f, [c for c in f.columns if not c.startswith("__")]),
        _unpivot(recon, recon.columns),
        _unpivot(s_recon, s_recon.columns),
        _unpivot(slices, slices.columns),
    ]
    separate = ["unique_stg_bookings_booking_id", "unique_fct_bookings_booking_id",
                "relationships_fct_room_nights_booking_id", "unique_combination_mart_daily_occupancy",
                "unique_combination_mart_monthly_kpis", "between_zero_and_one_mart_monthly_kpis_cancellation_rate",
                "unique_combination_mart_cancellation_drivers",
                "between_zero_and_one_mart_cancellation_drivers_cancellation_rate"]
    counted += [per_rule[n].failures.agg(F.count(F.lit(1)).cast("long").alias("failures"))
                .select(F.lit(n).alias("test"), "failures") for n in separate]
    severity = F.create_map(*[x for r in per_rule.values() for x in (F.lit(r.name), F.lit(r.severity))])
    res = reduce(DataFrame.unionByName, counted).select("test", severity[F.col("test")].alias("severity"), "failures")
    status = (F.when(F.col("failures") == 0, F.lit("pass"))
              .when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail")))
    return res.withColumn("status", status)

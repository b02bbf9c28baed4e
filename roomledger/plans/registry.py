"""Registered queries (Spark) and their oracle SQL (DuckDB), keyed by the same names.

Every query derives its input from the driver tables under ``sf_dir`` (the booking fixture is built
from ``orders`` and ``customer``), so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roomledger.operators import marts
from roomledger.oracle import sql as osql
from roomledger.plans.warehouse import facts, staging

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# ---- warehouse models -------------------------------------------------------------------------------

@register("stg_bookings", osql.warehouse(upto="stg") + "SELECT * FROM stg")
def q_stg_bookings(spark, sf_dir):
    """Staging computed from the raw rows (not the session's stored copy)."""
    from roomledger.operators.staging import stage_bookings
    return stage_bookings(load_raw_bookings(spark, sf_dir))


@register("fct_bookings", osql.warehouse(upto="fct") + "SELECT * FROM fct")
def q_fct_bookings(spark, sf_dir):
    return facts(spark, sf_dir)


@register("room_nights", osql.warehouse(upto="nights") + "SELECT * FROM nights")
def q_room_nights(spark, sf_dir):
    return marts.room_nights(facts(spark, sf_dir))


@register("daily_occupancy", osql.warehouse(upto="occupancy") + "SELECT * FROM occupancy")
def q_daily_occupancy(spark, sf_dir):
    return marts.daily_occupancy(marts.room_nights(facts(spark, sf_dir)))


@register("monthly_kpis", osql.warehouse(upto="monthly") + "SELECT * FROM monthly")
def q_monthly_kpis(spark, sf_dir):
    return marts.monthly_kpis(facts(spark, sf_dir))


@register("cancellation_drivers", osql.warehouse(upto="drivers") + "SELECT * FROM drivers")
def q_cancellation_drivers(spark, sf_dir):
    return marts.cancellation_drivers(facts(spark, sf_dir))


@register("cancellation_drivers_union", osql.warehouse(upto="drivers") + "SELECT * FROM drivers")
def q_cancellation_drivers_union(spark, sf_dir):
    return marts.cancellation_drivers_union(facts(spark, sf_dir))


# ---- data-quality rules -----------------------------------------------------------------------------
# Column rules run on the fixture with planted faults (FIXTURES.md §3), so their result is not empty.

from roomledger.operators import quality as dq  # noqa: E402
from roomledger.operators import summaries  # noqa: E402
from roomledger.operators.staging import TWIN_KEY  # noqa: E402
from roomledger.plans.warehouse import materialized  # noqa: E402
from roomledger.sources.fixtures import FIRST_ARRIVAL, LAST_ARRIVAL, load_raw_bookings  # noqa: E402

NARROW_WINDOW = ("1996-01-01", "2000-12-31")  # narrower than the fixture's arrivals, so rows fall outside
STG = osql.warehouse(upto="stg")
STG_FAULTY = osql.warehouse(faulty=True, upto="stg")
FCT = osql.warehouse(upto="fct")


@register("dq_unique", STG_FAULTY + "SELECT booking_id, count(*) AS n FROM stg WHERE booking_id IS NOT NULL "
                                    "GROUP BY booking_id HAVING count(*) > 1")
def q_dq_unique(spark, sf_dir):
    return dq.unique(staging(spark, sf_dir, faulty=True), "booking_id")


@register("dq_not_null", STG_FAULTY + "SELECT * FROM stg WHERE arrival_date IS NULL")
def q_dq_not_null(spark, sf_dir):
    return dq.not_null(staging(spark, sf_dir, faulty=True), "arrival_date")


@register("dq_accepted_values", STG_FAULTY + "SELECT hotel AS value, count(*) AS n_records FROM stg "
                                             "WHERE hotel IS NOT NULL AND hotel NOT IN ('City Hotel', 'Resort Hotel') "
                                             "GROUP BY hotel")
def q_dq_accepted_values(spark, sf_dir):
    return dq.accepted_values(staging(spark, sf_dir, faulty=True), "hotel", dq.HOTELS)


@register("dq_relationships", osql.warehouse(upto="fct", extra=(osql.nights_cte(src="stg", name="stg_nights"),))
          + "SELECT n.* FROM stg_nights n WHERE n.booking_id IS NOT NULL AND NOT EXISTS "
            "(SELECT 1 FROM fct f WHERE f.booking_id = n.booking_id)")
def q_dq_relationships(spark, sf_dir):
    """Nights expanded from *staging* against ``fct_bookings``: nights of excluded bookings are orphans."""
    stg = staging(spark, sf_dir)
    return dq.relationships(marts.room_nights(stg), "booking_id", marts.fct_bookings(stg), "booking_id")


@register("dq_non_negative", STG + "SELECT * FROM stg WHERE adr_eur < 0")
def q_dq_non_negative(spark, sf_dir):
    return dq.non_negative(staging(spark, sf_dir), "adr_eur")


@register("dq_unit_interval", osql.warehouse(upto="monthly") + "SELECT * FROM monthly WHERE cancellation_rate NOT BETWEEN 0 AND 1")
def q_dq_unit_interval(spark, sf_dir):
    return dq.between_zero_and_one(marts.monthly_kpis(facts(spark, sf_dir)), "cancellation_rate")


@register("dq_unique_combination", STG + f"SELECT {osql.TWIN_COLS}, count(*) AS n FROM stg "
                                         f"GROUP BY {osql.TWIN_COLS} HAVING count(*) > 1")
def q_dq_unique_combination(spark, sf_dir):
    """Groups of identical staged rows (the twin key), with their size."""
    return dq.unique_combination(staging(spark, sf_dir), TWIN_KEY)


@register("dq_arrival_window", STG + f"SELECT booking_id, arrival_date FROM stg WHERE arrival_date NOT BETWEEN "
                                     f"DATE '{NARROW_WINDOW[0]}' AND DATE '{NARROW_WINDOW[1]}'")
def q_dq_arrival_window(spark, sf_dir):
    return dq.arrivals_outside_window(staging(spark, sf_dir), *NARROW_WINDOW)


@register("dq_cancel_before_arrival", STG_FAULTY + "SELECT booking_id, arrival_date, cancellation_date FROM stg "
                                                   "WHERE reservation_status = 'Canceled' AND cancellation_date > arrival_date")
def q_dq_cancel_before_arrival(spark, sf_dir):
    return dq.cancellations_after_arrival(staging(spark, sf_dir, faulty=True))


@register("dq_checkout_matches_stay", STG + "SELECT booking_id, arrival_date, nights, reservation_status_date FROM stg "
                                            "WHERE reservation_status = 'Check-Out' "
                                            "AND reservation_status_date <> arrival_date + nights")
def q_dq_checkout_matches_stay(spark, sf_dir):
    return dq.checkout_mismatch(staging(spark, sf_dir))


@register("dq_row_conservation", STG + "SELECT s.n AS source_rows, g.n AS staging_rows, s.n = g.n AS ok "
                                       "FROM (SELECT count(*) AS n FROM raw) s, (SELECT count(*) AS n FROM stg) g")
def q_dq_row_conservation(spark, sf_dir):
    return dq.row_conservation_check(load_raw_bookings(spark, sf_dir), staging(spark, sf_dir))


@register("dq_exclusions", FCT + "SELECT staged, kept, excluded, staged = kept + excluded AS ok FROM (SELECT "
                                 "(SELECT count(*) FROM stg) AS staged, (SELECT count(*) FROM fct) AS kept, "
                                 "(SELECT count(*) FROM stg WHERE dq_negative_adr OR dq_adr_outlier OR dq_zero_guests) "
                                 "AS excluded)")
def q_dq_exclusions(spark, sf_dir):
    stg = staging(spark, sf_dir)
    return dq.exclusions_check(stg, marts.fct_bookings(stg))


@register("dq_driver_slices", osql.warehouse(upto="drivers")
          + "SELECT d.dimension, d.bookings, f.bookings AS expected, d.bookings = f.bookings AS ok "
            "FROM (SELECT dimension, CAST(sum(bookings) AS BIGINT) AS bookings FROM drivers GROUP BY 1) d, "
            "(SELECT count(*) AS bookings FROM fct) f")
def q_dq_driver_slices(spark, sf_dir):
    fct = facts(spark, sf_dir)
    return dq.driver_slices_check(marts.cancellation_drivers(fct), fct)


@register("dq_monthly_reconcile", osql.warehouse(upto="monthly")
          + "SELECT f.b AS fct_bookings, f.c AS fct_cancellations, f.r AS fct_revenue, m.b AS mart_bookings, "
            "m.c AS mart_cancellations, m.r AS mart_revenue, "
            "(f.b = m.b AND f.c = m.c AND abs(f.r - m.r) <= 0.01) AS ok "
            "FROM (SELECT count(*) AS b, CAST(sum(is_canceled::INTEGER) AS BIGINT) AS c, sum(realized_revenue_eur) AS r FROM fct) f, "
            "(SELECT CAST(sum(bookings) AS BIGINT) AS b, CAST(sum(cancellations) AS BIGINT) AS c, sum(realized_revenue_eur) AS r FROM monthly) m")
def q_dq_monthly_reconcile(spark, sf_dir):
    fct = facts(spark, sf_dir)
    return dq.monthly_reconcile_check(fct, marts.monthly_kpis(fct))


@register("dq_night_revenue", osql.warehouse(upto="occupancy")
          + "SELECT b.r AS booking_realized, b.c AS booking_cancelled, n.r AS night_realized, n.c AS night_cancelled, "
            "(abs(b.r - n.r) <= 0.01 AND abs(b.c - n.c) <= 0.01) AS ok "
            "FROM (SELECT sum(realized_revenue_eur) AS r, sum(cancelled_revenue_eur) AS c FROM fct) b, "
            "(SELECT sum(realized_revenue_eur) AS r, sum(cancelled_revenue_eur) AS c FROM occupancy) n")
def q_dq_night_revenue(spark, sf_dir):
    fct = facts(spark, sf_dir)
    return dq.night_revenue_check(fct, marts.daily_occupancy(marts.room_nights(fct)))


@register("dq_night_count", osql.warehouse(upto="nights")
          + "SELECT e.e AS expected, a.a AS actual, e.e = a.a AS ok "
            "FROM (SELECT CAST(sum(nights) AS BIGINT) AS e FROM fct) e, (SELECT count(*) AS a FROM nights) a")
def q_dq_night_count(spark, sf_dir):
    fct = facts(spark, sf_dir)
    return dq.night_count_check(fct, marts.room_nights(fct))


WAREHOUSE_MODELS = 6  # stg_bookings, fct_bookings, fct_room_nights and the three marts


def _rule_results(spark, sf_dir, faulty=False):
    """The 28 tests of a run over the session's stored warehouse, one pass per large table."""
    wh = materialized(spark, sf_dir, faulty=faulty)
    return dq.fused_rule_results(wh, FIRST_ARRIVAL, LAST_ARRIVAL)


@register("dq_rule_results", osql.warehouse(upto="all", extra=(osql.rule_results_sql(FIRST_ARRIVAL, LAST_ARRIVAL),))
          + "SELECT * FROM results")
def q_dq_rule_results(spark, sf_dir):
    """All 28 tests of a warehouse run over the clean fixture, one row each."""
    return _rule_results(spark, sf_dir)


@register("dq_rule_results_faulty",
          osql.warehouse(faulty=True, upto="all", extra=(osql.rule_results_sql(FIRST_ARRIVAL, LAST_ARRIVAL),))
          + "SELECT * FROM results")
def q_dq_rule_results_faulty(spark, sf_dir):
    """The same 28 tests over the fixture with planted faults: the planted rules fail."""
    return _rule_results(spark, sf_dir, faulty=True)


@register("dq_run_summary", osql.warehouse(upto="all", extra=(osql.rule_results_sql(FIRST_ARRIVAL, LAST_ARRIVAL),))
          + "SELECT count(*) AS tests, count(*) FILTER (WHERE status = 'pass') AS passed, "
            "count(*) FILTER (WHERE status = 'warn') AS warned, "
            f"count(*) FILTER (WHERE status IN ('fail', 'error')) AS failed, CAST({WAREHOUSE_MODELS} AS BIGINT) AS models "
            "FROM results")
def q_dq_run_summary(spark, sf_dir):
    return dq.run_summary(_rule_results(spark, sf_dir), WAREHOUSE_MODELS)


@register("dq_run_warnings", osql.warehouse(upto="all", extra=(osql.rule_results_sql(FIRST_ARRIVAL, LAST_ARRIVAL),))
          + "SELECT test, failures FROM results WHERE status = 'warn'")
def q_dq_run_warnings(spark, sf_dir):
    return dq.run_warnings(_rule_results(spark, sf_dir))


# ---- dashboard summaries ------------------------------------------------------------------------------

@register("booking_totals", FCT + "SELECT count(*) AS bookings, avg(is_canceled::INTEGER) AS cancellation_rate, "
                                  "sum(cancelled_revenue_eur) AS cancelled_revenue, "
                                  "sum(realized_revenue_eur) AS realized_revenue, min(arrival_date) AS first_arrival, "
                                  "max(arrival_date) AS last_arrival FROM fct")
def q_booking_totals(spark, sf_dir):
    return summaries.booking_totals(facts(spark, sf_dir))


@register("quality_counters", STG + "SELECT count(*) AS source_rows, CAST(sum(dq_negative_adr::INTEGER) AS BIGINT) AS negative_adr, "
                                    "CAST(sum(dq_adr_outlier::INTEGER) AS BIGINT) AS adr_outlier, CAST(sum(dq_zero_guests::INTEGER) AS BIGINT) AS zero_guests, "
                                    "CAST(sum((dq_negative_adr OR dq_adr_outlier OR dq_zero_guests)::INTEGER) AS BIGINT) AS excluded, "
                                    "CAST(sum(dq_identical_to_another_row::INTEGER) AS BIGINT) AS identical_rows, "
                                    "CAST(sum((country_code = 'UNK')::INTEGER) AS BIGINT) AS unknown_country FROM stg")
def q_quality_counters(spark, sf_dir):
    return summaries.quality_counters(staging(spark, sf_dir))


@register("cancel_timing", FCT + "SELECT hotel, quantile_cont(cancelled_days_before_arrival, 0.5) AS median_days, "
                                 "avg((cancelled_days_before_arrival <= 7)::INTEGER) AS share_last_week "
                                 "FROM fct WHERE reservation_status = 'Canceled' GROUP BY hotel")
def q_cancel_timing(spark, sf_dir):
    return summaries.cancel_timing(facts(spark, sf_dir))


# ---- splits, scores, evaluation ----------------------------------------------------------------------

from roomledger.operators import metrics, policy, scoring, splits  # noqa: E402
from roomledger.sources.fixtures import TEST_START, VALID_START  # noqa: E402

SCORED = osql.warehouse(upto="fct", extra=(osql.scored_cte(VALID_START, TEST_START),))


_SCORED: dict = {}


def scored(spark, sf_dir, scorer=scoring.prior_rate_scores):
    """The scored table of the session: written once (partitioned by split, A05) and read back (A06), as
    the scoring run hands it to the backtest."""
    key = (spark.sparkContext.applicationId, sf_dir, scorer.__name__)
    if key not in _SCORED:
        from roomledger.session import scratch_path
        path = scratch_path(spark, "scored-bookings")
        table = scoring.scored_bookings(facts(spark, sf_dir), VALID_START, TEST_START, scorer)
        table.write.mode("overwrite").partitionBy("split").parquet(path)
        _SCORED[key] = spark.read.schema(table.schema).parquet(path).select(*table.columns)
    return _SCORED[key]


def _split(df, name):
    from pyspark.sql import functions as F
    return df.filter(F.col("split") == name)


@register("time_split_sizes", FCT + f"SELECT count(*) FILTER (WHERE arrival_date < DATE '{VALID_START}') AS fit, "
          f"count(*) FILTER (WHERE arrival_date >= DATE '{VALID_START}' AND arrival_date < DATE '{TEST_START}') AS valid, "
          f"count(*) FILTER (WHERE arrival_date < DATE '{TEST_START}') AS train, "
          f"count(*) FILTER (WHERE arrival_date >= DATE '{TEST_START}') AS test FROM fct")
def q_time_split_sizes(spark, sf_dir):
    return splits.split_sizes(facts(spark, sf_dir), VALID_START, TEST_START)


@register("walk_forward_prior_rate", SCORED + "SELECT * FROM scored")
def q_walk_forward_prior_rate(spark, sf_dir):
    """Valid + test bookings scored month by month from strictly earlier arrivals (scored-table layout)."""
    return scored(spark, sf_dir)


@register("classification_scores", SCORED[:-1] + "," + osql.scores_sql("(SELECT * FROM scored WHERE split = 'test')"))
def q_classification_scores(spark, sf_dir):
    return metrics.classification_scores(_split(scored(spark, sf_dir), "test"))


@register("classification_scores_valid",
          SCORED[:-1] + "," + osql.scores_sql("(SELECT * FROM scored WHERE split = 'valid')"))
def q_classification_scores_valid(spark, sf_dir):
    return metrics.classification_scores(_split(scored(spark, sf_dir), "valid"))


# bins written out here on their own: ten right-closed tenths, the lowest closed on both sides
_TENTHS = [0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0]
_TENTH_LABELS = ["(-0.001, 0.1]", "(0.1, 0.2]", "(0.2, 0.3]", "(0.3, 0.4]", "(0.4, 0.5]", "(0.5, 0.6]", "(0.6, 0.7]",
                 "(0.7, 0.8]", "(0.8, 0.9]", "(0.9, 1.0]"]


@register("calibration_table", SCORED[:-1] + "," + osql.calibration_sql(
    "(SELECT * FROM scored WHERE split = 'test')", _TENTHS, _TENTH_LABELS))
def q_calibration_table(spark, sf_dir):
    return metrics.calibration_table(_split(scored(spark, sf_dir), "test"))


WEEKLY = osql.warehouse(upto="fct", extra=(osql.scored_cte(VALID_START, TEST_START),
                                           osql.weekly_cte("(SELECT * FROM scored WHERE split = 'test')")))


@register("weekly_forecast", WEEKLY + "SELECT * FROM weekly")
def q_weekly_forecast(spark, sf_dir):
    return metrics.weekly_forecast(_split(scored(spark, sf_dir), "test"))


@register("forecast_error", WEEKLY + "SELECT count(*) AS weeks, "
          "round(sum(abs(predicted - actual)) / sum(actual), 4) AS weighted_abs_error, "
          "round(sum(predicted), 1) AS total_predicted, CAST(sum(actual) AS BIGINT) AS total_actual, "
          "round((sum(predicted) - sum(actual)) / sum(actual), 4) AS total_error FROM weekly")
def q_forecast_error(spark, sf_dir):
    return metrics.forecast_error(metrics.weekly_forecast(_split(scored(spark, sf_dir), "test")))


# the same evaluation over the back-off scorer, whose scores are many distinct values

def _backoff_sql(*ctes):
    return osql.warehouse(upto="fct", extra=(
        osql.backoff_cte(VALID_START, TEST_START, ("market_segment", "customer_type", "lead_time_band", "country_code", "hotel",
                                                   "meal_plan"), 10.0), *ctes))


_BACKOFF_TEST = "(SELECT * FROM scored WHERE split = 'test')"


def backoff_scored(spark, sf_dir, split=None):
    table = scored(spark, sf_dir, scoring.backoff_scores)
    return _split(table, split) if split else table


@register("backoff_scored", _backoff_sql() + "SELECT * FROM scored")
def q_backoff_scored(spark, sf_dir):
    """Valid + test bookings scored by nested segment rates of earlier months, each shrunk to its parent."""
    return backoff_scored(spark, sf_dir)


@register("backoff_classification_scores", _backoff_sql()[:-1] + "," + osql.scores_sql(_BACKOFF_TEST))
def q_backoff_classification_scores(spark, sf_dir):
    return metrics.classification_scores(backoff_scored(spark, sf_dir, "test"))


@register("backoff_calibration", _backoff_sql()[:-1] + "," + osql.calibration_sql(_BACKOFF_TEST, _TENTHS, _TENTH_LABELS))
def q_backoff_calibration(spark, sf_dir):
    return metrics.calibration_table(backoff_scored(spark, sf_dir, "test"))


@register("backoff_weekly_forecast", _backoff_sql(osql.weekly_cte(_BACKOFF_TEST)) + "SELECT * FROM weekly")
def q_backoff_weekly_forecast(spark, sf_dir):
    return metrics.weekly_forecast(backoff_scored(spark, sf_dir, "test"))


@register("backoff_policy_curve", _backoff_sql(
    "e_test AS (SELECT * FROM scored WHERE split = 'test' AND deposit_type = 'No Deposit')",
    osql.curve_cte("e_test", "c_test", policy.BASE_WALKAWAY, policy.BASE_RESALE)) + "SELECT * FROM c_test")
def q_backoff_policy_curve(spark, sf_dir):
    return policy.threshold_curve(policy.eligible(backoff_scored(spark, sf_dir, "test")))


_TWIN_FCT = [c for c in TWIN_KEY if c != "reservation_status_date"]
# written out here on its own: the highest quarter of the first 32 bits of md5('split-7:<id>')
_HOLD = "('0x' || substr(md5('split-7:' || CAST(booking_id AS VARCHAR)), 1, 8))::BIGINT >= 3221225472"


@register("twin_leak_count", FCT + f", h AS (SELECT *, {_HOLD} AS hold FROM fct) "
          "SELECT (SELECT count(*) FROM h WHERE hold) AS holdout_rows, "
          "(SELECT count(*) FROM h a WHERE a.hold AND EXISTS (SELECT 1 FROM h b WHERE NOT b.hold AND "
          + " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in _TWIN_FCT)
          + ")) AS holdout_rows_with_train_twin")
def q_twin_leak_count(spark, sf_dir):
    """Shuffled 75/25 split of the fact table: hold-out rows that have an identical twin in training."""
    return splits.twin_leak_count(facts(spark, sf_dir), _TWIN_FCT, splits.shuffled_holdout())


# ---- decision-rule backtest ----------------------------------------------------------------------------

def _eligible(spark, sf_dir, split):
    return policy.eligible(_split(scored(spark, sf_dir), split))


_E = ("e_valid AS (SELECT * FROM scored WHERE split = 'valid' AND deposit_type = 'No Deposit'), "
      "e_test AS (SELECT * FROM scored WHERE split = 'test' AND deposit_type = 'No Deposit')")
_BW, _BR = policy.BASE_WALKAWAY, policy.BASE_RESALE


def _policy_sql(*ctes):
    return osql.warehouse(upto="fct", extra=(osql.scored_cte(VALID_START, TEST_START), _E, *ctes))


@register("policy_outcome", _policy_sql(osql.curve_cte("e_test", "c_test", _BW, _BR))
          + "SELECT * FROM c_test WHERE threshold = 0.5")
def q_policy_outcome(spark, sf_dir):
    """The rule at one threshold (0.5) under the base assumptions, on the test period."""
    return policy.evaluate(_eligible(spark, sf_dir, "test"), 0.5, _BW, _BR)


@register("policy_curve", _policy_sql(osql.curve_cte("e_test", "c_test", _BW, _BR)) + "SELECT * FROM c_test")
def q_policy_curve(spark, sf_dir):
    return policy.threshold_curve(_eligible(spark, sf_dir, "test"))


_BEST = "best AS (SELECT threshold, net_eur FROM c_valid ORDER BY net_eur DESC, threshold ASC LIMIT 1)"


@register("policy_best_threshold", _policy_sql(osql.curve_cte("e_valid", "c_valid", _BW, _BR), _BEST)
          + "SELECT * FROM best")
def q_policy_best_threshold(spark, sf_dir):
    return policy.best_threshold(policy.threshold_curve(_eligible(spark, sf_dir, "valid")))


def _base_threshold(spark, sf_dir):
    return policy.best_threshold(policy.threshold_curve(_eligible(spark, sf_dir, "valid"))).select("threshold").scalar()


@register("policy_base_case", _policy_sql(osql.curve_cte("e_valid", "c_valid", _BW, _BR), _BEST,
                                          osql.curve_cte("e_test", "c_test", _BW, _BR))
          + "SELECT c.* FROM c_test c JOIN best b ON c.threshold = b.threshold "
            "UNION ALL SELECT * FROM c_test WHERE threshold = 0")
def q_policy_base_case(spark, sf_dir):
    """Base case at the threshold chosen on valid, and the blanket deposit (threshold 0), on test."""
    from pyspark.sql import functions as F
    curve = policy.threshold_curve(_eligible(spark, sf_dir, "test"))
    return curve.filter((F.col("threshold") == _base_threshold(spark, sf_dir)) | (F.col("threshold") == 0))


@register("policy_by_hotel", _policy_sql(osql.curve_cte("e_valid", "c_valid", _BW, _BR), _BEST,
                                         osql.curve_cte("e_test", "h_test", _BW, _BR, keys="e.hotel"))
          + "SELECT h.* FROM h_test h JOIN best b ON h.threshold = b.threshold")
def q_policy_by_hotel(spark, sf_dir):
    from pyspark.sql import functions as F
    curve = policy.threshold_curve(_eligible(spark, sf_dir, "test"), keys=["hotel"])
    return curve.filter(F.col("threshold") == _base_threshold(spark, sf_dir))


_CASES = "cases AS (SELECT * FROM (VALUES " + ", ".join(
    f"(CAST({w!r} AS DOUBLE), CAST({r!r} AS DOUBLE))" for w in policy.WALKAWAY_GRID for r in policy.RESALE_GRID
) + ") AS t(walkaway, resale))"


def _case_curve(src, name):
    f = "e.p_cancel >= th.threshold"
    w, r = "CAST(cs.walkaway AS DECIMAL(9,6))", "CAST(cs.resale AS DECIMAL(9,6))"
    gain = (f"coalesce(sum((1 - {w}) * CAST(e.adr_eur AS DECIMAL(18,6)) * least(e.nights, 1)) "
            f"FILTER (WHERE {f} AND e.is_canceled), 0)")
    loss = (f"coalesce(sum({w} * (1 - {r}) * CAST(e.room_revenue_eur AS DECIMAL(18,6))) "
            f"FILTER (WHERE {f} AND NOT e.is_canceled), 0)")
    return (f"{name} AS (SELECT cs.walkaway, cs.resale, th.threshold, CAST(round({gain} - {loss}, 2) AS DOUBLE) AS net_eur "
            f"FROM (SELECT CAST(k AS DOUBLE) / 100 AS threshold FROM range(101) AS g(k)) th, cases cs, {src} e "
            f"GROUP BY cs.walkaway, cs.resale, th.threshold)")


@register("policy_sensitivity", _policy_sql(_CASES, _case_curve("e_valid", "cv"), _case_curve("e_test", "ct"))
          + ", pick AS (SELECT walkaway, resale, arg_max(threshold, (net_eur, -threshold)) AS threshold_from_valid "
            "FROM cv GROUP BY 1, 2) "
            "SELECT p.walkaway, p.resale, p.threshold_from_valid, t.net_eur AS net_eur_test, "
            "z.net_eur AS blanket_deposit_net_eur_test FROM pick p "
            "JOIN ct t ON t.walkaway = p.walkaway AND t.resale = p.resale AND t.threshold = p.threshold_from_valid "
            "JOIN ct z ON z.walkaway = p.walkaway AND z.resale = p.resale AND z.threshold = 0")
def q_policy_sensitivity(spark, sf_dir):
    return policy.sensitivity(_eligible(spark, sf_dir, "valid"), _eligible(spark, sf_dir, "test"))


@register("policy_population", _policy_sql() + "SELECT count(*) AS eligible_bookings, "
          "count(*) FILTER (WHERE is_canceled) AS eligible_cancellations, "
          "CAST(round(coalesce(sum(CAST(room_revenue_eur AS DECIMAL(18,6))) FILTER (WHERE is_canceled), 0), 2) AS DOUBLE) "
          "AS eligible_cancelled_revenue_eur "
          "FROM e_test")
def q_policy_population(spark, sf_dir):
    return policy.population(_eligible(spark, sf_dir, "test"))


# ---- features ---------------------------------------------------------------------------------------------

from roomledger.operators import features as feat  # noqa: E402

_TRAIN = f"arrival_date < DATE '{TEST_START}'"
_VOCAB = (f"vocab AS (SELECT agent_id, count(*) AS count FROM fct WHERE agent_id IS NOT NULL AND {_TRAIN} "
          f"GROUP BY agent_id ORDER BY count DESC, agent_id LIMIT {feat.TOP_AGENTS})")
_POOLED = ("CASE WHEN f.agent_id IS NULL THEN 'none' WHEN v.agent_id IS NOT NULL THEN CAST(f.agent_id AS VARCHAR) "
           "ELSE 'other' END")


def _train_test(spark, sf_dir):
    fct = facts(spark, sf_dir)
    s = splits.time_split(fct, VALID_START, TEST_START)
    return s["train"], s["test"]


@register("top_agents", osql.warehouse(upto="fct", extra=(_VOCAB,)) + "SELECT * FROM vocab")
def q_top_agents(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return feat.top_agents(train)


@register("pooled_category", osql.warehouse(upto="fct", extra=(_VOCAB,))
          + f"SELECT f.booking_id, f.agent_id, {_POOLED} AS agent FROM fct f "
            f"LEFT JOIN vocab v ON f.agent_id = v.agent_id WHERE f.arrival_date >= DATE '{TEST_START}'")
def q_pooled_category(spark, sf_dir):
    """Test rows with their agent pooled against the training vocabulary."""
    train, test = _train_test(spark, sf_dir)
    return feat.pooled_agent(test, feat.top_agents(train)).select("booking_id", "agent_id", "agent")


_FRAME_NUMERIC = {
    "arrival_weekday_num": "CAST(isodow(f.arrival_date) - 1 AS INTEGER)",
    "is_repeated_guest": "CAST(f.is_repeated_guest AS INTEGER)",
    "has_company": "CAST(f.company_id IS NOT NULL AS INTEGER)",
    "agent": _POOLED,
}


@register("feature_frame", osql.warehouse(upto="fct", extra=(_VOCAB,))
          + "SELECT f.booking_id, f.is_canceled, "
          + ", ".join(f"{_FRAME_NUMERIC.get(c, 'f.' + c)} AS {c}" for c in feat.FEATURES)
          + f" FROM fct f LEFT JOIN vocab v ON f.agent_id = v.agent_id WHERE f.arrival_date >= DATE '{TEST_START}'")
def q_feature_frame(spark, sf_dir):
    """Model frame of the test rows (22 allowed features) with the training vocabulary."""
    train, test = _train_test(spark, sf_dir)
    return feat.feature_frame(test, feat.top_agents(train), keep=["booking_id", "is_canceled"])


def _indexed_sql() -> str:
    ctes = [_VOCAB,
            "tr AS (SELECT " + ", ".join(f"{_FRAME_NUMERIC.get(c, 'f.' + c)} AS {c}" for c in feat.CATEGORICAL)
            + f" FROM fct f LEFT JOIN vocab v ON f.agent_id = v.agent_id WHERE f.{_TRAIN})",
            "te AS (SELECT f.booking_id, " + ", ".join(f"{_FRAME_NUMERIC.get(c, 'f.' + c)} AS {c}"
                                                      for c in feat.CATEGORICAL)
            + f" FROM fct f LEFT JOIN vocab v ON f.agent_id = v.agent_id WHERE f.arrival_date >= DATE '{TEST_START}')"]
    for c in feat.CATEGORICAL:
        ctes.append(f"lv_{c} AS (SELECT {c} AS level, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) "
                    f"AS idx FROM tr WHERE {c} IS NOT NULL GROUP BY {c})")
    sel = ", ".join(f"coalesce(l_{c}.idx, CAST((SELECT count(*) FROM lv_{c}) AS DOUBLE)) AS {c}_idx"
                    for c in feat.CATEGORICAL)
    joins = " ".join(f"LEFT JOIN lv_{c} l_{c} ON te.{c} = l_{c}.level" for c in feat.CATEGORICAL)
    return osql.warehouse(upto="fct", extra=tuple(ctes)) + f"SELECT te.booking_id, {sel} FROM te {joins}"


@register("indexed_categories", _indexed_sql())
def q_indexed_categories(spark, sf_dir):
    """Category codes of the test rows with levels fitted on training rows; unseen -> one extra code."""
    from pyspark.ml import Pipeline
    train, test = _train_test(spark, sf_dir)
    vocab = feat.top_agents(train)
    tr = feat.feature_frame(train, vocab)
    te = feat.feature_frame(test, vocab, keep=["booking_id"])
    model = Pipeline(stages=feat.category_indexers(feat.CATEGORICAL)).fit(tr)
    return model.transform(te).select("booking_id", *[f"{c}_idx" for c in feat.CATEGORICAL])


# ---- boosted-tree walk-forward (a whole trained model has no SQL oracle; its first splits do) ------------

from roomledger.operators import gbt  # noqa: E402


def _test_end(fct):
    from pyspark.sql import functions as F
    last = fct.agg(F.max("arrival_date")).first()[0]  # one scalar: the last arrival
    return (last + __import__("datetime").timedelta(days=1)).isoformat()


# Fitted results are reused across the GBT queries of one session: the rounds (an int) and the
# checkpointed walk-forward scores, keyed by session, data folder and variant.
_FITS: dict = {}
_COMPARISONS = (gbt.Variant("without_special_requests", drop=["special_requests"]),
                gbt.Variant("with_leaky_columns", extra=list(feat.LEAKY_DEMO_COLUMNS)))


def _rounds(spark, sf_dir, variant=gbt.Variant()):
    key = ("rounds", spark.sparkContext.applicationId, sf_dir, repr(variant))
    if key not in _FITS:
        run = gbt.probe(facts(spark, sf_dir), VALID_START, TEST_START, variant)
        _keep_rounds(key, run, run.grow_until())
    return _FITS[key]


def _keep_rounds(key, run, rounds):
    _FITS[key] = rounds
    _FITS[("losses", *key[1:])] = run.losses
    run.close()


def _gbt_test(spark, sf_dir, variant=gbt.Variant()):
    key = ("walk", spark.sparkContext.applicationId, sf_dir, repr(variant))
    if key not in _FITS:
        fct = facts(spark, sf_dir)
        known = _FITS.get(("rounds", *key[1:]))  # else the models grow beside the probe that finds them
        probe = gbt.probe(fct, VALID_START, TEST_START, variant) if known is None else None
        scored_rows, model, names = gbt.walk_forward(fct, TEST_START, _test_end(fct), known if probe is None else probe, variant)
        if probe is not None:
            _keep_rounds(("rounds", *key[1:]), probe, len(model.trees[0]))
        _FITS[key] = (scored_rows, model, names, len(model.trees[0]))
    return _FITS[key]


def _gbt_tests(spark, sf_dir, variants):
    """:func:`_gbt_test` of several variants, side by side."""
    facts(spark, sf_dir)  # written once, before the threads read it
    return gbt.side_by_side(spark, [lambda v=v: _gbt_test(spark, sf_dir, v) for v in variants])


def _holdout(spark, sf_dir, variant=gbt.Variant()):
    """Scores of the shuffled split with the probe's rounds, its model grown beside the probe unless they are known."""
    fct, key = facts(spark, sf_dir), ("rounds", spark.sparkContext.applicationId, sf_dir, repr(gbt.Variant()))
    if key in _FITS:
        return gbt.holdout_scores(fct, splits.shuffled_holdout(), _FITS[key], variant)
    probe = gbt.probe(fct, VALID_START, TEST_START)
    found = gbt.holdout_scores(fct, splits.shuffled_holdout(), probe, variant)
    _keep_rounds(key, probe, probe.best_round())
    return found


@register("gbt_rounds")
def q_gbt_rounds(spark, sf_dir):
    """Rounds picked once by early stopping on fit -> valid."""
    from pyspark.sql import functions as F
    fct = facts(spark, sf_dir)
    return fct.agg(F.lit(_rounds(spark, sf_dir)).alias("boosting_rounds"), F.count(F.lit(1)).alias("rows_seen"))


@register("gbt_walk_forward")
def q_gbt_walk_forward(spark, sf_dir):
    """Test arrivals scored month by month by a model trained on all earlier arrivals."""
    from pyspark.sql import functions as F
    scored_rows, _, _, _ = _gbt_test(spark, sf_dir)
    return scored_rows.withColumn("split", F.lit("test"))


_MONTHS = ("months AS (SELECT DISTINCT arrival_month AS m FROM fct WHERE arrival_date >= DATE '" + TEST_START + "') ")


@register("gbt_contract", osql.warehouse(upto="fct", extra=(_MONTHS,))
          + "SELECT m AS arrival_month, (SELECT count(*) FROM fct f WHERE f.arrival_month = m) AS rows_scored, "
            "(SELECT count(DISTINCT f.booking_id) FROM fct f WHERE f.arrival_month = m) AS distinct_ids, "
            "CAST(0 AS BIGINT) AS outside_unit_interval, "
            "(SELECT count(*) FROM fct f WHERE f.arrival_date < m) AS training_rows FROM months")
def q_gbt_contract(spark, sf_dir):
    """What the walk-forward run must keep, per test month: every row scored once, scores in [0, 1], and a model that was
    fitted on all earlier arrivals (rows counted by the fit itself)."""
    from pyspark.sql import functions as F
    scored_rows, model, _, _ = _gbt_test(spark, sf_dir)
    month = F.trunc("arrival_date", "month").alias("arrival_month")
    scores = scored_rows.groupBy(month).agg(
        F.count(F.lit(1)).alias("rows_scored"), F.count_distinct("booking_id").alias("distinct_ids"),
        F.count_if(F.col("p_cancel").isNull() | ~F.col("p_cancel").between(0, 1)).alias("outside_unit_interval"),
        F.max("training_rows").alias("training_rows"))
    return scores


@register("gbt_variant_columns", " UNION ALL ".join(
    f"SELECT '{v}' AS variant, {n} AS position, '{c}' AS feature, (SELECT count(*) FROM orders) > 0 AS has_rows"
    for v, cols in (("base", "lead_time_days weekend_nights week_nights adults children babies previous_cancellations "
                     "previous_bookings_not_canceled days_in_waiting_list adr_eur special_requests arrival_weekday_num "
                     "is_repeated_guest has_company hotel meal_plan market_segment distribution_channel customer_type "
                     "deposit_type reserved_room_type agent"),
                    ("without_special_requests", "lead_time_days weekend_nights week_nights adults children babies "
                     "previous_cancellations previous_bookings_not_canceled days_in_waiting_list adr_eur arrival_weekday_num "
                     "is_repeated_guest has_company hotel meal_plan market_segment distribution_channel customer_type "
                     "deposit_type reserved_room_type agent"),
                    ("with_leaky_columns", "lead_time_days weekend_nights week_nights adults children babies "
                     "previous_cancellations previous_bookings_not_canceled days_in_waiting_list adr_eur special_requests "
                     "arrival_weekday_num is_repeated_guest has_company parking_spaces booking_changes hotel meal_plan "
                     "market_segment distribution_channel customer_type deposit_type reserved_room_type agent "
                     "assigned_room_type country_code"))
    for n, c in enumerate(cols.split())))
def q_gbt_variant_columns(spark, sf_dir):
    """Model columns of each comparison run, in the order the fitted pipelines have them."""
    from pyspark.sql import functions as F
    rows = []
    variants = (gbt.Variant(), *_COMPARISONS)
    for v, (scored_rows, _, names, _) in zip(variants, _gbt_tests(spark, sf_dir, variants)):
        rows.append(scored_rows.agg((F.count(F.lit(1)) > 0).alias("has_rows")).select(
            F.lit(v.name).alias("variant"), F.posexplode(F.array(*[F.lit(c) for c in names])).alias("position", "feature"), "has_rows"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@register("gbt_scores")
def q_gbt_scores(spark, sf_dir):
    scored_rows, _, _, _ = _gbt_test(spark, sf_dir)
    return metrics.classification_scores(scored_rows)


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    """Top 15 features of the last month's model by total gain of their splits."""
    _, model, _, _ = _gbt_test(spark, sf_dir)
    return gbt.feature_importance(model)


@register("gbt_splits")
def q_gbt_splits(spark, sf_dir):
    """Every split of every month's model: model, round, node, feature, gain, rows, side of missing values."""
    _, model, _, _ = _gbt_test(spark, sf_dir)
    return model.split_table()


@register("gbt_validation_loss")
def q_gbt_validation_loss(spark, sf_dir):
    """Log loss on the valid rows after each round of the run that chose the rounds."""
    _rounds(spark, sf_dir)
    losses = _FITS[("losses", spark.sparkContext.applicationId, sf_dir, repr(gbt.Variant()))]
    return spark.createDataFrame([(i + 1, x[0]) for i, x in enumerate(losses)], "round int, valid_log_loss double")


# Columns whose bins are their distinct values, so that SQL finds the same cuts.
_SPLIT_VARIANT = gbt.Variant("without_sketched_columns", drop=["lead_time_days", "adr_eur"])


def _split_gains_sql() -> str:
    nums = [c for c in feat.NUMERIC if c not in _SPLIT_VARIANT.drop]
    cols = [(c, c in nums) for c in (*nums, *feat.CATEGORICAL)]
    frame = ("fr AS (SELECT f.booking_id, CAST(f.is_canceled AS INTEGER) AS y, "
             + ", ".join(f"{_FRAME_NUMERIC.get(c, 'f.' + c)} AS {c}" for c, _ in cols)
             + f" FROM fct f LEFT JOIN vocab v ON f.agent_id = v.agent_id WHERE f.{_TRAIN})")
    long = "lo AS (" + " UNION ALL ".join(
        f"SELECT booking_id, y, {i} AS pos, '{c}' AS feature, CAST({c} AS VARCHAR) AS v, "
        f"{f'CAST({c} AS DOUBLE)' if number else 'CAST(NULL AS DOUBLE)'} AS nv FROM fr" for i, (c, number) in enumerate(cols)) + ")"

    def level(name: str, nodes: str) -> list[str]:
        return [f"{name}_hist AS (SELECT node, pos, feature, v, nv, count(*) AS n, sum(p0 - y) AS g, count(*) * any_value(p0 * (1 - p0)) AS h "
                f"FROM lo JOIN ({nodes}) USING (booking_id), p GROUP BY ALL)",
                f"{name}_cuts AS (SELECT *, row_number() OVER w AS k, sum(n) OVER w AS nl, sum(g) OVER w AS gl, sum(h) OVER w AS hl, "
                f"sum(n) OVER a AS nt, sum(g) OVER a AS gt, sum(h) OVER a AS ht FROM {name}_hist "
                "WINDOW w AS (PARTITION BY node, feature ORDER BY coalesce(nv, g / h), v ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY node, feature))",
                f"{name}_best AS (SELECT *, gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1) AS gain "
                f"FROM {name}_cuts WHERE nl >= 40 AND nt - nl >= 40 QUALIFY row_number() OVER (PARTITION BY node, feature ORDER BY gain DESC, k) = 1)"]

    return osql.warehouse(upto="fct", extra=(
        _VOCAB, frame, long, "p AS (SELECT avg(y) AS p0 FROM fr)", *level("r", "SELECT booking_id, 'root' AS node FROM fr"),
        "top AS (SELECT feature, k FROM r_best ORDER BY gain DESC, pos LIMIT 1)",
        "sides AS (SELECT lo.booking_id, CASE WHEN c.k <= top.k THEN 'left' ELSE 'right' END AS node FROM lo JOIN top USING (feature) "
        "JOIN r_cuts c ON c.feature = lo.feature AND c.v = lo.v)", *level("s", "SELECT booking_id, node FROM sides"))) + (
        "SELECT node, feature, round(gain, 4) AS gain, CAST(least(nl, nt - nl) AS BIGINT) AS n_small, CAST(greatest(nl, nt - nl) AS BIGINT) AS n_large "
        "FROM (SELECT * FROM r_best UNION ALL SELECT * FROM s_best) WHERE gain > 1e-9")


@register("gbt_split_gains", _split_gains_sql())
def q_gbt_split_gains(spark, sf_dir):
    """Best gain of each feature at the root of the first tree and at both children of its best split."""
    from pyspark.sql import functions as F
    found = gbt.first_split_gains(facts(spark, sf_dir), TEST_START, _SPLIT_VARIANT)
    return found.where(F.col("gain") > 1e-9).withColumn("gain", F.round("gain", 4))


@register("ablation_scores")
def q_ablation_scores(spark, sf_dir):
    """Walk-forward test scores without special requests and with the leaky columns (one row each)."""
    from pyspark.sql import functions as F
    rows = []
    for v, (scored_rows, _, _, _) in zip(_COMPARISONS, _gbt_tests(spark, sf_dir, _COMPARISONS)):
        rows.append(metrics.classification_scores(scored_rows).select(F.lit(v.name).alias("variant"), "*"))
    return rows[0].unionByName(rows[1])


@register("random_split_scores")
def q_random_split_scores(spark, sf_dir):
    """Shuffled 75/25 split (hash of the booking id): the inflated comparison score."""
    return metrics.classification_scores(_holdout(spark, sf_dir))


@register("random_split_leaky_scores")
def q_random_split_leaky_scores(spark, sf_dir):
    """The shuffled split with the leaky columns as well."""
    return metrics.classification_scores(_holdout(spark, sf_dir, _COMPARISONS[1]))


# ---- sources and sinks (round trips through files in the shared scratch folder) ----------------------

from roomledger.session import scratch_path, table_path  # noqa: E402
from roomledger.sources import files  # noqa: E402


@register("surrogate_row_id", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_id FROM orders")
def q_surrogate_row_id(spark, sf_dir):
    """Dense 1..n ids in file order on a parquet scan (orders are stored in key order)."""
    from roomledger.operators.rowid import with_row_id
    orders = spark.read.parquet(table_path(sf_dir, "orders")).select("o_orderkey")
    return with_row_id(orders, "row_id")


@register("csv_null_tokens", osql.with_ctes(
    osql.raw_cte(name="raw0"),
    "raw AS (SELECT * EXCLUDE (booking_id), row_number() OVER (ORDER BY booking_id) AS booking_id FROM raw0)",
    osql.stg_cte()) + "SELECT * FROM stg")
def q_csv_null_tokens(spark, sf_dir):
    """Raw rows written as CSV (missing agent / company spelled ``NULL``, other gaps ``NA``), read back
    with both tokens as null and no key, numbered in file order, staged."""
    from roomledger.operators.staging import stage_bookings
    path = scratch_path(spark, "raw-csv")
    files.write_raw_csv(load_raw_bookings(spark, sf_dir), path, order_by="booking_id",
                        null_token_by_column={"agent": "NULL", "company": "NULL"})
    return stage_bookings(files.read_csv_with_null_tokens(spark, path, row_id="booking_id"))


@register("source_fingerprint")
def q_source_fingerprint(spark, sf_dir):
    """SHA-256 of the input files the warehouse is built from."""
    return files.file_fingerprints(spark, [table_path(sf_dir, "orders"), table_path(sf_dir, "customer")])


@register("source_checksum", " UNION ALL ".join(
    f"SELECT '{t}' AS source, count(*) AS n_rows, bit_xor(('0x' || substr(md5({key}), 1, 8))::BIGINT) AS checksum FROM {t}"
    for t, key in (("orders", "CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus || '|' || o_orderpriority"),
                   ("customer", "CAST(c_custkey AS VARCHAR) || '|' || CAST(c_nationkey AS VARCHAR) || '|' || c_mktsegment"))))
def q_source_checksum(spark, sf_dir):
    """Order-free checksum of the columns the warehouse is built from; unlike a file hash it splits over a file's blocks."""
    parts = [files.rows_checksum(spark.read.parquet(table_path(sf_dir, t)), t, cols) for t, cols in (
        ("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]), ("customer", ["c_custkey", "c_nationkey", "c_mktsegment"]))]
    return parts[0].unionByName(parts[1])


_DIGEST_COLUMNS = {"orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
                   "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]}


def _digest_sql(table, columns):
    text = " || ".join(f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)
    a, b = (f"CAST(sum(('0x' || substr(h, {at}, 15))::BIGINT) AS VARCHAR)" for at in (1, 16))
    return f"SELECT '{table}' AS unit, count(*) AS n_rows, {a} AS digest_a, {b} AS digest_b FROM (SELECT md5({text}) AS h FROM {table})"


@register("source_digests", " UNION ALL ".join(_digest_sql(t, c) for t, c in _DIGEST_COLUMNS.items()))
def q_source_digests(spark, sf_dir):
    """Order-free, null-safe digests of all columns of the tables the warehouse is built from."""
    from pyspark.sql import functions as F
    parts = [files.unit_digests(spark.read.parquet(table_path(sf_dir, t)), F.lit(t), cols) for t, cols in _DIGEST_COLUMNS.items()]
    return parts[0].unionByName(parts[1])


_LISTED = "listed AS (SELECT o_orderkey % 8 AS unit, o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders)"
# the planted faults of q_manifest_check, and the check by comparing rows themselves
_MANIFEST_SQL = f"""WITH {_LISTED},
found AS (
    SELECT unit, o_orderkey, o_custkey,
        CASE WHEN o_orderkey % 1000 = 5 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 1000 = 5 THEN o_orderstatus WHEN o_orderkey % 1000 = 1 THEN NULL ELSE o_orderpriority END AS o_orderpriority
    FROM listed WHERE unit <> 4 AND o_orderkey % 1000 <> 2
    UNION ALL SELECT l.* FROM listed l, range(2) WHERE o_orderkey % 1000 = 3
    UNION ALL SELECT 9, o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM listed WHERE o_orderkey % 1000 = 7),
a AS (SELECT unit, count(*) AS n FROM listed GROUP BY 1), b AS (SELECT unit, count(*) AS n FROM found GROUP BY 1),
d AS (SELECT DISTINCT unit FROM ((SELECT * FROM listed EXCEPT ALL SELECT * FROM found) UNION ALL (SELECT * FROM found EXCEPT ALL SELECT * FROM listed)))
SELECT CAST(coalesce(a.unit, b.unit) AS VARCHAR) AS unit, a.n AS rows_listed, b.n AS rows_found,
    CASE WHEN b.n IS NULL THEN 'missing' WHEN a.n IS NULL THEN 'unlisted' WHEN a.n <> b.n THEN 'rows'
         WHEN coalesce(a.unit, b.unit) IN (SELECT unit FROM d) THEN 'changed' ELSE 'ok' END AS status
FROM a FULL JOIN b ON a.unit = b.unit"""


@register("manifest_check", _MANIFEST_SQL)
def q_manifest_check(spark, sf_dir):
    """Orders delivered in eight shards with changed, missing, repeated and misplaced rows, a missing and an unlisted
    shard, checked against the manifest of the clean shards (A02)."""
    from pyspark.sql import functions as F
    nth = F.col("o_orderkey") % 1000
    listed = spark.read.parquet(table_path(sf_dir, "orders")).select(
        (F.col("o_orderkey") % 8).alias("shard"), "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    faulty = listed.where((F.col("shard") != 4) & (nth != 2)).select(
        F.explode(F.array_repeat("shard", F.when(nth == 3, 3).otherwise(1))).alias("shard"), "o_orderkey", "o_custkey",
        F.when(nth != 5, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(nth == 5, F.col("o_orderstatus")).when(nth != 1, F.col("o_orderpriority")).alias("o_orderpriority"))
    extra = listed.where(nth == 7).withColumn("shard", F.lit(9).cast("long"))
    clean, delivered = scratch_path(spark, "manifest-clean"), scratch_path(spark, "manifest-delivered")
    files.write_table(listed, clean, ["shard"])
    files.write_table(faulty.unionByName(extra).repartition("o_custkey"), delivered, ["shard"])
    shard = F.regexp_extract("_metadata.file_path", "/shard=([0-9]+)/", 1)
    return files.check_manifest(files.file_digests(spark, delivered, shard), files.file_digests(spark, clean, shard))


@register("scored_parquet_round_trip", SCORED + "SELECT * FROM scored WHERE split = 'test'")
def q_scored_parquet_round_trip(spark, sf_dir):
    """Scored table written partitioned by split, read back with a partition filter."""
    from pyspark.sql import functions as F
    path = scratch_path(spark, "scored")
    files.write_table(scored(spark, sf_dir), path, partition_by=["split"])
    return spark.read.parquet(path).filter(F.col("split") == "test")


@register("weekly_csv_round_trip", WEEKLY + "SELECT * FROM weekly")
def q_weekly_csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "weekly")
    files.write_csv(metrics.weekly_forecast(_split(scored(spark, sf_dir), "test")), path)
    return files.read_csv(spark, path, "hotel STRING, week DATE, bookings LONG, predicted DOUBLE, actual LONG")


@register("policy_report_round_trip", _policy_sql(osql.curve_cte("e_test", "c_test", _BW, _BR)) + "SELECT * FROM c_test")
def q_policy_report_round_trip(spark, sf_dir):
    """Decision-rule report written as JSON and read back; returns its threshold curve."""
    from pyspark.sql import functions as F
    from roomledger.plans.reports import policy_report
    path = scratch_path(spark, "policy-report")
    files.write_report(policy_report(_eligible(spark, sf_dir, "valid"), _eligible(spark, sf_dir, "test")), path)
    doc = files.read_report(spark, path)
    curve = doc.select(F.explode("threshold_curve_base_case").alias("c")).select("c.*")
    return curve.select(*policy.OUTCOME_COLUMNS)


@register("monthly_records", osql.warehouse(upto="monthly")
          + "SELECT hotel, strftime(arrival_month, '%Y-%m-%d') AS arrival_month, bookings, cancellations, no_shows, "
            "round(cancellation_rate, 4) AS cancellation_rate, room_nights_sold, "
            "round(realized_revenue_eur, 4) AS realized_revenue_eur, round(cancelled_revenue_eur, 4) AS cancelled_revenue_eur, "
            "round(realized_adr_eur, 4) AS realized_adr_eur FROM monthly")
def q_monthly_records(spark, sf_dir):
    """Monthly KPIs as presentation records: dates as text, doubles to 4 digits."""
    return files.records(marts.monthly_kpis(facts(spark, sf_dir)))


# ---- documents --------------------------------------------------------------------------------------------

def _metrics_long_sql() -> str:
    fields = ["roc_auc", "accuracy", "precision", "recall", "brier", "log_loss", "base_rate",
              "majority_class_accuracy", "n"]
    ctes = [osql.scores_ctes(f"(SELECT * FROM scored WHERE split = '{s}')", f"{s}_") for s in ("test", "valid")]
    body = [f"SELECT '{s}' AS section, '{f}' AS metric, CAST({f} AS DOUBLE) AS value FROM {s}_rec"
            for s in ("test", "valid") for f in fields]
    sizes = ("sizes AS (SELECT count(*) FILTER (WHERE arrival_date < DATE '{v}') AS fit, "
             "count(*) FILTER (WHERE arrival_date >= DATE '{v}' AND arrival_date < DATE '{t}') AS valid, "
             "count(*) FILTER (WHERE arrival_date < DATE '{t}') AS train, "
             "count(*) FILTER (WHERE arrival_date >= DATE '{t}') AS test FROM fct)").format(v=VALID_START, t=TEST_START)
    body += [f"SELECT 'split' AS section, '{f}' AS metric, CAST({f} AS DOUBLE) AS value FROM sizes"
             for f in ("fit", "valid", "train", "test")]
    err = ("werr AS (SELECT count(*) AS weeks, round(sum(abs(predicted - actual)) / sum(actual), 4) AS weighted_abs_error, "
           "round(sum(predicted), 1) AS total_predicted, sum(actual) AS total_actual, "
           "round((sum(predicted) - sum(actual)) / sum(actual), 4) AS total_error FROM weekly)")
    body += [f"SELECT 'weekly_forecast' AS section, '{f}' AS metric, CAST({f} AS DOUBLE) AS value FROM werr"
             for f in ("weeks", "weighted_abs_error", "total_predicted", "total_actual", "total_error")]
    return (osql.warehouse(upto="fct", extra=(osql.scored_cte(VALID_START, TEST_START),
                                              osql.weekly_cte("(SELECT * FROM scored WHERE split = 'test')"),
                                              *ctes, sizes, err))
            + "\nUNION ALL\n".join(body))


@register("model_metrics_long", _metrics_long_sql())
def q_model_metrics_long(spark, sf_dir):
    """The metrics document of a scored run as (section, metric, value) rows."""
    from roomledger.plans.model_run import metrics_document
    return metrics_document(facts(spark, sf_dir), scored(spark, sf_dir), VALID_START, TEST_START)


@register("gbt_scored_bookings")
def q_gbt_scored_bookings(spark, sf_dir):
    """Valid + test bookings scored by the monthly retrained boosted trees (input of the backtest)."""
    from roomledger.plans.model_run import gbt_scored_table
    key = ("scored", spark.sparkContext.applicationId, sf_dir)
    if key not in _FITS:
        _FITS[key] = gbt_scored_table(facts(spark, sf_dir), VALID_START, TEST_START)
    return _FITS[key]


@register("gbt_policy_curve")
def q_gbt_policy_curve(spark, sf_dir):
    """The decision-rule curve on the test period with the boosted-tree scores."""
    return policy.threshold_curve(policy.eligible(_split(q_gbt_scored_bookings(spark, sf_dir), "test")))


@register("dq_run_log_summary", osql.warehouse(upto="all", extra=(osql.rule_results_sql(FIRST_ARRIVAL, LAST_ARRIVAL),))
          + "SELECT count(*) AS tests, count(*) FILTER (WHERE status = 'pass') AS passed, "
            "count(*) FILTER (WHERE status = 'warn') AS warned, "
            f"count(*) FILTER (WHERE status IN ('fail', 'error')) AS failed, CAST({WAREHOUSE_MODELS} AS BIGINT) AS models "
            "FROM results")
def q_dq_run_log_summary(spark, sf_dir):
    """The run written as a JSON run log, read back (multiLine JSON scan) and summarised from the log."""
    path = scratch_path(spark, "run-log")
    files.write_report(dq.run_log(_rule_results(spark, sf_dir)), path)
    return dq.summary_from_run_log(files.read_report(spark, path, multiline=True))


@register("dq_run_log_warnings", osql.warehouse(upto="all", extra=(osql.rule_results_sql(FIRST_ARRIVAL, LAST_ARRIVAL),))
          + "SELECT test, failures FROM results WHERE status = 'warn'")
def q_dq_run_log_warnings(spark, sf_dir):
    path = scratch_path(spark, "run-log")
    files.write_report(dq.run_log(_rule_results(spark, sf_dir)), path)
    return dq.warnings_from_run_log(files.read_report(spark, path, multiline=True))


def _document_sql(sections):
    """Rows of a document in SQL: (section, source, order, number fields, text fields) each."""
    out = []
    for name, src, order, numbers, texts in sections:
        place = f"(SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS item FROM {src})"
        out += [f"SELECT '{name}' AS section, CAST(item AS BIGINT) AS item, '{f}' AS field, CAST({f} AS DOUBLE) AS value, "
                f"CAST(NULL AS VARCHAR) AS label FROM {place}" for f in numbers]
        out += [f"SELECT '{name}', CAST(item AS BIGINT), '{f}', CAST(NULL AS DOUBLE), CAST({f} AS VARCHAR) FROM {place}" for f in texts]
    return "\nUNION ALL\n".join(out)


_SCORE_FIELDS = ["roc_auc", "accuracy", "precision", "recall", "brier", "log_loss", "base_rate", "majority_class_accuracy", "n"]
_SPLIT_SIZES = (f"(SELECT count(*) FILTER (WHERE arrival_date < DATE '{VALID_START}') AS fit, "
                f"count(*) FILTER (WHERE arrival_date >= DATE '{VALID_START}' AND arrival_date < DATE '{TEST_START}') AS valid, "
                f"count(*) FILTER (WHERE arrival_date < DATE '{TEST_START}') AS train, "
                f"count(*) FILTER (WHERE arrival_date >= DATE '{TEST_START}') AS test FROM fct)")
_WEEKLY_ERROR = ("(SELECT count(*) AS weeks, round(sum(abs(predicted - actual)) / sum(actual), 4) AS weighted_abs_error, "
                 "round(sum(predicted), 1) AS total_predicted, sum(actual) AS total_actual, "
                 "round((sum(predicted) - sum(actual)) / sum(actual), 4) AS total_error FROM weekly)")


@register("model_report_round_trip", _backoff_sql(
    osql.weekly_cte(_BACKOFF_TEST), *[osql.scores_ctes(f"(SELECT * FROM scored WHERE split = '{x}')", f"{x}_") for x in ("test", "valid")],
    f"cal AS (WITH {osql.calibration_sql(_BACKOFF_TEST, _TENTHS, _TENTH_LABELS)})") + _document_sql([
        ("split", _SPLIT_SIZES, "fit", ["fit", "valid", "train", "test"], []),
        ("test", "test_rec", "n", _SCORE_FIELDS, []), ("valid", "valid_rec", "n", _SCORE_FIELDS, []),
        ("calibration", "cal", "bin_index", ["bin_index", "n", "predicted", "actual"], ["bin"]),
        ("weekly_forecast", _WEEKLY_ERROR, "weeks", ["weeks", "weighted_abs_error", "total_predicted", "total_actual", "total_error"], []),
        ("weekly", "weekly", "hotel, week", ["bookings", "predicted", "actual"], ["hotel", "week"])]))
def q_model_report_round_trip(spark, sf_dir):
    """The whole metrics document of a scored run, written as JSON, read back and laid out in rows."""
    from roomledger.plans.reports import document_rows, model_report
    doc = model_report(facts(spark, sf_dir), backoff_scored(spark, sf_dir), VALID_START, TEST_START)
    path = scratch_path(spark, "model-report")
    files.write_report(doc, path)
    return document_rows(spark.read.schema(doc.schema).json(path))


_R4 = "round({0}, 4) AS {0}".format


@register("dashboard_payload", osql.warehouse(upto="all", extra=(osql.rule_results_sql(FIRST_ARRIVAL, LAST_ARRIVAL),)) + _document_sql([
    ("totals", "(SELECT count(*) AS bookings, round(avg(is_canceled::INTEGER), 4) AS cancellation_rate, "
               "round(sum(cancelled_revenue_eur), 4) AS cancelled_revenue, round(sum(realized_revenue_eur), 4) AS realized_revenue, "
               "min(arrival_date) AS first_arrival, max(arrival_date) AS last_arrival FROM fct)", "bookings",
     ["bookings", "cancellation_rate", "cancelled_revenue", "realized_revenue"], ["first_arrival", "last_arrival"]),
    ("quality", "(" + ORACLE["quality_counters"][len(STG):] + ")", "source_rows",
     ["source_rows", "negative_adr", "adr_outlier", "zero_guests", "excluded", "identical_rows", "unknown_country"], []),
    ("tests", f"(SELECT count(*) AS tests, count(*) FILTER (WHERE status = 'pass') AS passed, count(*) FILTER (WHERE status = 'warn') AS warned, "
              f"count(*) FILTER (WHERE status IN ('fail', 'error')) AS failed, {WAREHOUSE_MODELS} AS models FROM results)", "tests",
     ["tests", "passed", "warned", "failed", "models"], []),
    ("warnings", "(SELECT test, failures FROM results WHERE status = 'warn')", "test", ["failures"], ["test"]),
    ("monthly", f"(SELECT * REPLACE ({_R4('cancellation_rate')}, {_R4('realized_revenue_eur')}, {_R4('cancelled_revenue_eur')}, "
                f"{_R4('realized_adr_eur')}) FROM monthly)", "hotel, arrival_month",
     ["bookings", "cancellations", "no_shows", "cancellation_rate", "room_nights_sold", "realized_revenue_eur", "cancelled_revenue_eur",
      "realized_adr_eur"], ["hotel", "arrival_month"]),
    ("drivers", f"(SELECT * REPLACE ({_R4('cancellation_rate')}, {_R4('cancelled_revenue_eur')}) FROM drivers)", "dimension, value",
     ["bookings", "cancellations", "cancellation_rate", "cancelled_revenue_eur"], ["dimension", "value"]),
    ("cancel_timing", "(SELECT hotel, round(quantile_cont(cancelled_days_before_arrival, 0.5), 4) AS median_days, "
                      "round(avg((cancelled_days_before_arrival <= 7)::INTEGER), 4) AS share_last_week "
                      "FROM fct WHERE reservation_status = 'Canceled' GROUP BY hotel)", "hotel", ["median_days", "share_last_week"], ["hotel"])]))
def q_dashboard_payload(spark, sf_dir):
    """Every section of the page as one JSON document, written, read back and laid out in rows."""
    from roomledger.plans.dashboard import dashboard_sections
    from roomledger.plans.reports import dashboard_document, document_rows
    doc = dashboard_document(dashboard_sections(materialized(spark, sf_dir), _rule_results(spark, sf_dir), WAREHOUSE_MODELS))
    path = scratch_path(spark, "dashboard")
    files.write_report(doc, path)
    return document_rows(spark.read.schema(doc.schema).json(path))

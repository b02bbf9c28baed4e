"""DuckDB SQL for the booking fixture and the warehouse models, written from the models' definitions.

These strings are the oracle: they are run by DuckDB against the same parquet tables and compared with the Spark results.
Each model is written its own way, with other joins and groupings than the Spark form (identical rows by a join on the row's
text, nights by a calendar, bands by a table of bounds, drivers by an unpivot, a direct 101-way scan for the policy
curve), so that the two do not share a shortcut.
"""

from __future__ import annotations

TWIN_COLS = (
    "hotel, is_canceled, lead_time_days, arrival_date, weekend_nights, week_nights, adults, children, "
    "babies, meal_plan, country_code, market_segment, distribution_channel, is_repeated_guest, "
    "previous_cancellations, previous_bookings_not_canceled, reserved_room_type, assigned_room_type, "
    "booking_changes, deposit_type, agent_id, company_id, days_in_waiting_list, customer_type, adr_eur, "
    "parking_spaces, special_requests, reservation_status, reservation_status_date"
)


def raw_cte(faulty: bool = False, name: str = "raw") -> str:
    booking_id = "2 * k" if faulty else "2 * k + copy_no"
    hotel = "CASE WHEN u % 3 = 0 THEN 'Resort Hotel' ELSE 'City Hotel' END"
    if faulty:
        hotel = f"CASE WHEN k % 701 = 0 THEN 'Hostel' ELSE {hotel} END"
    miss = "k % 809 = 0" if faulty else "FALSE"
    status_date = (
        "CASE WHEN status = 'Check-Out' THEN arr + CAST(wkend + wk + CASE WHEN k % 499 = 0 THEN 1 ELSE 0 END AS INTEGER) "
        "WHEN status = 'No-Show' THEN arr ELSE arr - CAST(k % (lead_time + 1) AS INTEGER) END"
    )
    if faulty:
        status_date = f"CASE WHEN status = 'Canceled' AND k % 613 = 0 THEN arr + 1 ELSE {status_date} END"
    return f"""
{name}_j AS (
    SELECT o.o_orderkey AS k, o.o_custkey AS u, o.o_orderstatus, o.o_orderdate, o.o_orderpriority,
           c.c_nationkey, c.c_mktsegment, cp.copy_no
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey,
         unnest(CASE WHEN o.o_orderkey % 100 = 0 THEN [0, 1] ELSE [0] END) AS cp(copy_no)
),
{name}_b AS (
    SELECT *, (k * 37) % 400 AS lead_time,
           CASE WHEN k % 8 = 0 THEN 'Non Refund' WHEN k % 50 = 1 THEN 'Refundable' ELSE 'No Deposit' END AS deposit_type,
           CAST(o_orderdate AS DATE) AS arr, k % 3 AS wkend, (k * 7) % 5 AS wk
    FROM {name}_j
),
{name}_c AS (
    SELECT *, (o_orderstatus = 'F' OR (lead_time > 250 AND deposit_type = 'Non Refund')) AS canc FROM {name}_b
),
{name}_d AS (
    SELECT *, CASE WHEN NOT canc THEN 'Check-Out' WHEN k % 20 = 1 THEN 'No-Show' ELSE 'Canceled' END AS status
    FROM {name}_c
),
{name} AS (
    SELECT
        {booking_id} AS booking_id,
        {hotel} AS hotel,
        CAST(canc AS INTEGER) AS is_canceled,
        CAST(lead_time AS INTEGER) AS lead_time,
        CASE WHEN NOT ({miss}) THEN year(arr) END AS arrival_date_year,
        CASE WHEN NOT ({miss}) THEN strftime(arr, '%B') END AS arrival_date_month,
        CASE WHEN NOT ({miss}) THEN day(arr) END AS arrival_date_day_of_month,
        CAST(wkend AS INTEGER) AS stays_in_weekend_nights,
        CAST(wk AS INTEGER) AS stays_in_week_nights,
        CAST((u * 11) % 4 AS INTEGER) AS adults,
        CASE WHEN k % 10 <> 0 THEN CAST(k % 2 AS INTEGER) END AS children,
        CASE WHEN k % 50 = 0 THEN 1 ELSE 0 END AS babies,
        (['BB', 'HB', 'FB', 'SC', 'Undefined'])[k % 5 + 1] AS meal,
        CASE WHEN u % 97 <> 0 THEN 'N' || CAST(c_nationkey AS VARCHAR) END AS country,
        c_mktsegment AS market_segment,
        o_orderpriority AS distribution_channel,
        CAST(u % 10 = 0 AS INTEGER) AS is_repeated_guest,
        CAST(CASE WHEN u % 7 = 0 THEN k % 3 ELSE 0 END AS INTEGER) AS previous_cancellations,
        CAST(u % 4 AS INTEGER) AS previous_bookings_not_canceled,
        substr('ABCDEFGH', CAST(k % 7 + 1 AS INTEGER), 1) AS reserved_room_type,
        substr('ABCDEFGH', CAST(k % 7 + 1 + CASE WHEN k % 11 = 0 THEN 1 ELSE 0 END AS INTEGER), 1) AS assigned_room_type,
        CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END AS booking_changes,
        deposit_type,
        CAST(CASE WHEN u % 6 <> 0 THEN u % 60 END AS INTEGER) AS agent,
        CAST(CASE WHEN u % 25 = 0 THEN u % 40 END AS INTEGER) AS company,
        CAST(CASE WHEN k % 30 = 0 THEN k % 90 ELSE 0 END AS INTEGER) AS days_in_waiting_list,
        (['Transient', 'Contract', 'Group', 'Transient-Party'])[u % 4 + 1] AS customer_type,
        CASE WHEN k % 997 = 0 THEN CAST(-1 AS DOUBLE) WHEN k % 991 = 0 THEN CAST(5400 AS DOUBLE)
             ELSE CAST(k % 4000 AS DOUBLE) / 8 END AS adr,
        CASE WHEN NOT canc AND k % 12 = 0 THEN 1 ELSE 0 END AS required_car_parking_spaces,
        CAST(k % 6 AS INTEGER) AS total_of_special_requests,
        status AS reservation_status,
        {status_date} AS reservation_status_date
    FROM {name}_d
)"""


# Raw name -> staged name of the whole-number columns.
WHOLE = {
    "lead_time": "lead_time_days", "stays_in_weekend_nights": "weekend_nights", "stays_in_week_nights": "week_nights",
    "adults": "adults", "babies": "babies", "previous_cancellations": "previous_cancellations",
    "previous_bookings_not_canceled": "previous_bookings_not_canceled", "booking_changes": "booking_changes",
    "agent": "agent_id", "company": "company_id", "days_in_waiting_list": "days_in_waiting_list",
    "required_car_parking_spaces": "parking_spaces", "total_of_special_requests": "special_requests",
}
SAME = ("booking_id hotel market_segment distribution_channel reserved_room_type assigned_room_type deposit_type "
        "customer_type reservation_status").split()


def stg_cte(src: str = "raw", name: str = "stg", adr_ceiling: float = 1000.0) -> str:
    """Staged rows in three steps: values, what follows from them, and how often the whole row occurs (its JSON text
    grouped and joined back)."""
    whole = ", ".join(f"CAST({old} AS INTEGER) AS {new}" for old, new in WHOLE.items())
    day = "lpad(CAST(CAST(arrival_date_day_of_month AS INTEGER) AS VARCHAR), 2, '0')"
    key = "CAST(to_json({" + ", ".join(f"'{c.strip()}': {c.strip()}" for c in TWIN_COLS.split(",")) + "}) AS VARCHAR)"
    return f"""
{name}_values AS (
    SELECT {", ".join(SAME)}, {whole},
           CAST(strptime(CAST(CAST(arrival_date_year AS INTEGER) AS VARCHAR) || arrival_date_month || {day}, '%Y%B%d') AS DATE) AS arrival_date,
           CAST(ifnull(children, 0) AS INTEGER) AS children, CAST(adr AS DOUBLE) AS adr_eur,
           ifnull(nullif(meal, 'Undefined'), CASE WHEN meal IS NOT NULL THEN 'SC' END) AS meal_plan, ifnull(country, 'UNK') AS country_code,
           CAST(is_canceled AS BOOLEAN) AS is_canceled, CAST(is_repeated_guest AS BOOLEAN) AS is_repeated_guest,
           reservation_status IN ('No-Show') AS is_no_show, CAST(reservation_status_date AS DATE) AS reservation_status_date
    FROM {src}
),
{name}_follows AS (
    SELECT v.*, weekend_nights + week_nights AS nights, adults + children + babies AS guests,
           CAST(arrival_date - to_days(lead_time_days) AS DATE) AS booking_date,
           if(is_canceled, reservation_status_date, NULL) AS cancellation_date, {key} AS row_text
    FROM {name}_values v
),
{name}_often AS (SELECT row_text, count(*) AS times FROM {name}_follows GROUP BY row_text),
{name} AS (
    SELECT f.* EXCLUDE (row_text), nights * adr_eur AS room_revenue_eur,
           CAST(date_diff('day', cancellation_date, arrival_date) AS INTEGER) AS cancelled_days_before_arrival,
           sign(adr_eur) = -1 AS dq_negative_adr, NOT adr_eur <= {float(adr_ceiling)!r} AS dq_adr_outlier,
           guests IN (0) AS dq_zero_guests, times >= 2 AS dq_identical_to_another_row
    FROM {name}_follows f JOIN {name}_often USING (row_text)
)"""


def fct_cte(src: str = "stg", name: str = "fct") -> str:
    """Kept bookings; bands from a table of bounds, the two revenues by a factor of 0 or 1."""
    return f"""
{name}_bands(at_least, below, lead_time_band) AS (
    VALUES (-2147483648, 8, '0-7 days'), (8, 31, '8-30 days'), (31, 91, '31-90 days'), (91, 181, '91-180 days'),
           (181, 366, '181-365 days'), (366, 2147483647, '365+ days')
),
{name} AS (
    SELECT k.* EXCLUDE (reservation_status_date, dq_negative_adr, dq_adr_outlier, dq_zero_guests),
           make_date(CAST(year(arrival_date) AS INTEGER), CAST(month(arrival_date) AS INTEGER), 1) AS arrival_month,
           strftime(arrival_date, '%A') AS arrival_weekday, d.lead_time_band,
           room_revenue_eur * (1 - CAST(is_canceled AS INTEGER)) AS realized_revenue_eur,
           room_revenue_eur * CAST(is_canceled AS INTEGER) AS cancelled_revenue_eur
    FROM {src} k JOIN {name}_bands d ON lead_time_days >= d.at_least AND lead_time_days < d.below
    WHERE (dq_negative_adr, dq_adr_outlier, dq_zero_guests) = (FALSE, FALSE, FALSE)
)"""


def nights_cte(src: str = "fct", name: str = "nights") -> str:
    """A calendar joined by range: a stay holds the days from its arrival on, before its last day."""
    return f"""
{name}_calendar AS (
    SELECT CAST(unnest(generate_series(min(arrival_date), CAST(max(arrival_date + nights) AS DATE), INTERVAL 1 DAY)) AS DATE) AS stay_date FROM {src}
),
{name} AS (
    SELECT booking_id, hotel, stay_date, is_canceled, adr_eur
    FROM {name}_calendar JOIN {src} s ON stay_date >= s.arrival_date AND stay_date < s.arrival_date + s.nights
)"""


def occupancy_cte(src: str = "nights", name: str = "occupancy") -> str:
    """One row per outcome first, then both outcomes side by side."""
    return f"""
{name}_outcomes AS (SELECT hotel, stay_date, is_canceled AS lost, count(*) AS n, sum(adr_eur) AS eur FROM {src} GROUP BY ALL),
{name}_days AS (SELECT DISTINCT hotel, stay_date FROM {name}_outcomes),
{name} AS (
    SELECT d.hotel, d.stay_date, ifnull(s.n, 0) AS rooms_sold, ifnull(x.n, 0) AS rooms_cancelled, ifnull(s.n, 0) + ifnull(x.n, 0) AS rooms_booked,
           ifnull(s.eur, 0) AS realized_revenue_eur, ifnull(x.eur, 0) AS cancelled_revenue_eur
    FROM {name}_days d
    LEFT JOIN {name}_outcomes s ON s.hotel = d.hotel AND s.stay_date = d.stay_date AND NOT s.lost
    LEFT JOIN {name}_outcomes x ON x.hotel = d.hotel AND x.stay_date = d.stay_date AND x.lost
)"""


def monthly_cte(src: str = "fct", name: str = "monthly") -> str:
    """Sums per hotel, month and outcome, put together from the two outcomes."""
    return f"""
{name}_outcomes AS (
    SELECT hotel, arrival_month, is_canceled AS lost, count(*) AS n, sum(CAST(is_no_show AS BIGINT)) AS away, sum(nights) AS nights,
           sum(room_revenue_eur) AS eur
    FROM {src} GROUP BY ALL
),
{name}_sides AS (
    SELECT hotel, arrival_month, CAST(sum(n) AS BIGINT) AS bookings, CAST(sum(n * CAST(lost AS BIGINT)) AS BIGINT) AS cancellations,
           CAST(sum(away) AS BIGINT) AS no_shows, CAST(max(if(lost, NULL, nights)) AS BIGINT) AS room_nights_sold,
           ifnull(max(if(lost, NULL, eur)), 0) AS realized_revenue_eur, ifnull(max(if(lost, eur, NULL)), 0) AS cancelled_revenue_eur
    FROM {name}_outcomes GROUP BY hotel, arrival_month
),
{name} AS (
    SELECT *, cancellations / CAST(bookings AS DOUBLE) AS cancellation_rate,
           realized_revenue_eur / nullif(room_nights_sold, 0) AS realized_adr_eur
    FROM {name}_sides
)"""


def drivers_cte(src: str = "fct", name: str = "drivers") -> str:
    """All slices as columns of text, turned into rows by one unpivot."""
    return f"""
{name}_wide AS (
    SELECT hotel, market_segment, distribution_channel, deposit_type, customer_type, lead_time_band,
           (['First stay', 'Repeat guest'])[1 + CAST(is_repeated_guest AS INTEGER)] AS repeat_guest,
           (['None', '1 or more'])[1 + least(abs(previous_cancellations), 1)] AS previous_cancellations,
           (['None', '1 or more'])[1 + least(abs(special_requests), 1)] AS special_requests,
           strftime(arrival_date, '%m-%b') AS arrival_month, CAST(is_canceled AS BIGINT) AS lost, cancelled_revenue_eur AS eur
    FROM {src}
),
{name}_long AS (
    SELECT dimension, value, lost, eur FROM {name}_wide UNPIVOT INCLUDE NULLS (value FOR dimension IN (
        hotel, market_segment, distribution_channel, deposit_type, customer_type, lead_time_band, repeat_guest,
        previous_cancellations, special_requests, arrival_month))
),
{name} AS (
    SELECT dimension, value, count(*) AS bookings, CAST(sum(lost) AS BIGINT) AS cancellations,
           sum(lost) / CAST(count(*) AS DOUBLE) AS cancellation_rate, sum(eur) AS cancelled_revenue_eur
    FROM {name}_long GROUP BY dimension, value
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def warehouse(faulty: bool = False, upto: str = "fct", extra: tuple[str, ...] = ()) -> str:
    """``WITH`` prefix defining raw -> stg -> fct (-> nights -> occupancy, monthly, drivers) + ``extra``."""
    ctes = [raw_cte(faulty), stg_cte()]
    order = ["fct", "nights", "occupancy", "monthly", "drivers"]
    makers = {"fct": fct_cte, "nights": nights_cte, "occupancy": occupancy_cte, "monthly": monthly_cte,
              "drivers": drivers_cte}
    if upto in order:
        needed = {"fct": ["fct"], "nights": ["fct", "nights"], "occupancy": ["fct", "nights", "occupancy"],
                  "monthly": ["fct", "monthly"], "drivers": ["fct", "drivers"]}[upto]
        ctes += [makers[n]() for n in needed]
    elif upto == "all":
        ctes += [makers[n]() for n in order]
    return with_ctes(*ctes, *extra)


# ---- data-quality rules ------------------------------------------------------------------------------

def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def rule_sql(first_arrival: str, last_arrival: str) -> list[tuple[str, str, str]]:
    """(test, severity, SQL returning failing rows) for the 28 tests of a run."""
    from roomledger.operators.quality import (
        DEPOSIT_TYPES, HOTELS, LEAD_TIME_BAND_LABELS, MEAL_PLANS, RESERVATION_STATUSES)

    def uniq(t, c):
        return f"SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"

    def nn(t, c):
        return f"SELECT * FROM {t} WHERE {c} IS NULL"

    def acc(t, c, vals):
        return f"SELECT {c} AS value, count(*) AS n FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN ({_in_list(vals)}) GROUP BY {c}"

    def ucomb(t, cols):
        return f"SELECT {cols}, count(*) AS n FROM {t} GROUP BY {cols} HAVING count(*) > 1"

    def unit(t, c):
        return f"SELECT * FROM {t} WHERE {c} NOT BETWEEN 0 AND 1"

    return [
        ("unique_stg_bookings_booking_id", "error", uniq("stg", "booking_id")),
        ("not_null_stg_bookings_booking_id", "error", nn("stg", "booking_id")),
        ("accepted_values_stg_bookings_hotel", "error", acc("stg", "hotel", HOTELS)),
        ("not_null_stg_bookings_arrival_date", "error", nn("stg", "arrival_date")),
        ("accepted_values_stg_bookings_deposit_type", "error", acc("stg", "deposit_type", DEPOSIT_TYPES)),
        ("accepted_values_stg_bookings_reservation_status", "error",
         acc("stg", "reservation_status", RESERVATION_STATUSES)),
        ("accepted_values_stg_bookings_meal_plan", "error", acc("stg", "meal_plan", MEAL_PLANS)),
        ("unique_fct_bookings_booking_id", "error", uniq("fct", "booking_id")),
        ("not_null_fct_bookings_booking_id", "error", nn("fct", "booking_id")),
        ("not_null_fct_bookings_arrival_date", "error", nn("fct", "arrival_date")),
        ("non_negative_fct_bookings_nights", "error", "SELECT * FROM fct WHERE nights < 0"),
        ("non_negative_fct_bookings_adr_eur", "error", "SELECT * FROM fct WHERE adr_eur < 0"),
        ("accepted_values_fct_bookings_lead_time_band", "error", acc("fct", "lead_time_band", LEAD_TIME_BAND_LABELS)),
        ("relationships_fct_room_nights_booking_id", "error",
         "SELECT n.* FROM nights n WHERE n.booking_id IS NOT NULL AND NOT EXISTS "
         "(SELECT 1 FROM fct f WHERE f.booking_id = n.booking_id)"),
        ("unique_combination_mart_daily_occupancy", "error", ucomb("occupancy", "hotel, stay_date")),
        ("unique_combination_mart_monthly_kpis", "error", ucomb("monthly", "hotel, arrival_month")),
        ("between_zero_and_one_mart_monthly_kpis_cancellation_rate", "error", unit("monthly", "cancellation_rate")),
        ("unique_combination_mart_cancellation_drivers", "error", ucomb("drivers", "dimension, value")),
        ("between_zero_and_one_mart_cancellation_drivers_cancellation_rate", "error",
         unit("drivers", "cancellation_rate")),
        ("assert_arrivals_inside_published_window", "error",
         f"SELECT booking_id, arrival_date FROM stg WHERE arrival_date NOT BETWEEN DATE '{first_arrival}' "
         f"AND DATE '{last_arrival}'"),
        ("assert_cancellations_happen_before_arrival", "error",
         "SELECT booking_id FROM stg WHERE reservation_status = 'Canceled' AND cancellation_date > arrival_date"),
        ("assert_checkout_matches_stay_length", "warn",
         "SELECT booking_id FROM stg WHERE reservation_status = 'Check-Out' "
         "AND reservation_status_date <> arrival_date + nights"),
        ("assert_driver_slices_cover_every_booking", "error",
         "SELECT d.dimension FROM (SELECT dimension, sum(bookings) AS bookings FROM drivers GROUP BY 1) d, "
         "(SELECT count(*) AS bookings FROM fct) f WHERE d.bookings <> f.bookings"),
        ("assert_exclusions_account_for_every_row", "error",
         "SELECT * FROM (SELECT (SELECT count(*) FROM stg) AS staged, (SELECT count(*) FROM fct) AS kept, "
         "(SELECT count(*) FROM stg WHERE dq_negative_adr OR dq_adr_outlier OR dq_zero_guests) AS excluded) "
         "WHERE staged <> kept + excluded"),
        ("assert_monthly_kpis_reconcile", "error",
         "SELECT * FROM (SELECT count(*) AS b, sum(is_canceled::INTEGER) AS c, sum(realized_revenue_eur) AS r FROM fct) f, "
         "(SELECT sum(bookings) AS b, sum(cancellations) AS c, sum(realized_revenue_eur) AS r FROM monthly) m "
         "WHERE f.b <> m.b OR f.c <> m.c OR abs(f.r - m.r) > 0.01"),
        ("assert_room_night_revenue_reconciles", "error",
         "SELECT * FROM (SELECT sum(realized_revenue_eur) AS r, sum(cancelled_revenue_eur) AS c FROM fct) b, "
         "(SELECT sum(realized_revenue_eur) AS r, sum(cancelled_revenue_eur) AS c FROM occupancy) n "
         "WHERE abs(b.r - n.r) > 0.01 OR abs(b.c - n.c) > 0.01"),
        ("assert_room_nights_match_stay_lengths", "error",
         "SELECT * FROM (SELECT sum(nights) AS e FROM fct) e, (SELECT count(*) AS a FROM nights) a WHERE e.e <> a.a"),
        ("assert_staging_keeps_every_source_row", "error",
         "SELECT * FROM (SELECT count(*) AS n FROM raw) s, (SELECT count(*) AS n FROM stg) g WHERE s.n <> g.n"),
    ]


def rule_results_sql(first_arrival: str, last_arrival: str) -> str:
    parts = [f"SELECT '{name}' AS test, '{sev}' AS severity, count(*) AS failures FROM ({q}) AS t_{i}"
             for i, (name, sev, q) in enumerate(rule_sql(first_arrival, last_arrival))]
    return (
        "results AS (SELECT test, severity, failures, CASE WHEN failures = 0 THEN 'pass' "
        "WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM (\n    "
        + "\n    UNION ALL\n    ".join(parts) + "\n))"
    )


# ---- scored rows, metrics and the decision rule --------------------------------------------------------

def scored_cte(valid_start: str, test_start: str, name: str = "scored") -> str:
    return f"""
seg AS (
    SELECT market_segment, arrival_month, count(*) AS n, count(*) FILTER (WHERE is_canceled) AS c
    FROM fct GROUP BY 1, 2
),
prior AS (
    SELECT market_segment, arrival_month,
        CAST(coalesce(sum(c) OVER w, 0) + 1 AS DOUBLE) / CAST(coalesce(sum(n) OVER w, 0) + 2 AS DOUBLE) AS p_cancel
    FROM seg
    WINDOW w AS (PARTITION BY market_segment ORDER BY arrival_month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
{name} AS (
    SELECT f.booking_id,
        CASE WHEN f.arrival_date >= DATE '{test_start}' THEN 'test'
             WHEN f.arrival_date >= DATE '{valid_start}' THEN 'valid' END AS split,
        f.hotel, f.arrival_date, f.deposit_type, f.nights, f.adr_eur, f.room_revenue_eur, f.is_canceled, p.p_cancel
    FROM fct f JOIN prior p ON f.market_segment = p.market_segment AND f.arrival_month = p.arrival_month
    WHERE f.arrival_date >= DATE '{valid_start}'
)"""


def backoff_cte(valid_start: str, test_start: str, keys: tuple[str, ...], weight: float, name: str = "scored") -> str:
    """Back-off scores level by level; earlier bookings by a join on the months before, not by windows."""
    out = ["""
l0 AS (
    SELECT m.arrival_month AS mo,
        CAST(count(f.booking_id) FILTER (WHERE f.is_canceled) + 1 AS DOUBLE) / CAST(count(f.booking_id) + 2 AS DOUBLE) AS p
    FROM (SELECT DISTINCT arrival_month FROM fct) m LEFT JOIN fct f ON f.arrival_month < m.arrival_month GROUP BY 1
)"""]
    for d in range(1, len(keys) + 1):
        own, above = keys[:d], keys[:d - 1]
        cols = ", ".join(own)
        same = " AND ".join([f"s.{k} IS NOT DISTINCT FROM b.{k}" for k in own])
        up = " AND ".join(["q.mo = s.mo", *[f"q.{k} IS NOT DISTINCT FROM s.{k}" for k in above]])
        out.append(f"""
s{d} AS (SELECT {cols}, arrival_month AS mo, count(*) AS n, count(*) FILTER (WHERE is_canceled) AS c FROM fct GROUP BY ALL),
e{d} AS (
    SELECT {", ".join(f"s.{k}" for k in own)}, s.mo, CAST(coalesce(sum(b.n), 0) AS DOUBLE) AS n, CAST(coalesce(sum(b.c), 0) AS DOUBLE) AS c
    FROM s{d} s LEFT JOIN s{d} b ON {same} AND b.mo < s.mo GROUP BY ALL
),
l{d} AS (SELECT {", ".join(f"s.{k}" for k in own)}, s.mo, (s.c + {weight!r}::DOUBLE * q.p) / (s.n + {weight!r}::DOUBLE) AS p
    FROM e{d} s JOIN l{d - 1} q ON {up})""")
    on = " AND ".join(["q.mo = f.arrival_month", *[f"q.{k} IS NOT DISTINCT FROM f.{k}" for k in keys]])
    out.append(f"""
{name} AS (
    SELECT f.booking_id,
        CASE WHEN f.arrival_date >= DATE '{test_start}' THEN 'test'
             WHEN f.arrival_date >= DATE '{valid_start}' THEN 'valid' END AS split,
        f.hotel, f.arrival_date, f.deposit_type, f.nights, f.adr_eur, f.room_revenue_eur, f.is_canceled, q.p AS p_cancel
    FROM fct f JOIN l{len(keys)} q ON {on} WHERE f.arrival_date >= DATE '{valid_start}'
)""")
    return ",".join(out)


def scores_ctes(src: str, p: str = "") -> str:
    """CTEs ``{p}t .. {p}rec`` computing the score record over ``src`` (columns is_canceled, p_cancel)."""
    eps = "2.220446049250313e-16"
    pc = f"least(greatest(p, {eps}), 1 - {eps})"
    return f"""
{p}t AS (SELECT CAST(is_canceled AS INTEGER) AS y, p_cancel AS p FROM {src}),
{p}v AS (SELECT p, count(*) AS cnt, sum(y) AS pos FROM {p}t GROUP BY p),
{p}r AS (SELECT p, cnt, pos,
        coalesce(sum(cnt) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM {p}v),
{p}auc AS (
    SELECT CAST(sum(pos * (2 * below + cnt + 1)) - sum(pos) * (sum(pos) + 1) AS DOUBLE)
           / CAST(2 * sum(pos) * (sum(cnt) - sum(pos)) AS DOUBLE) AS roc_auc FROM {p}r
),
{p}m AS (
    SELECT avg(CAST(CAST(p >= 0.5 AS INTEGER) = y AS INTEGER)) AS accuracy,
        coalesce(CAST(count(*) FILTER (WHERE p >= 0.5 AND y = 1) AS DOUBLE)
                 / nullif(count(*) FILTER (WHERE p >= 0.5), 0), 0) AS precision,
        coalesce(CAST(count(*) FILTER (WHERE p >= 0.5 AND y = 1) AS DOUBLE)
                 / nullif(count(*) FILTER (WHERE y = 1), 0), 0) AS recall,
        avg((p - y) * (p - y)) AS brier,
        avg(-(y * ln({pc}) + (1 - y) * ln(1 - {pc}))) AS log_loss,
        avg(y) AS base_rate,
        count(*) AS n
    FROM {p}t
),
{p}rec AS (
    SELECT round(a.roc_auc, 4) AS roc_auc, round(accuracy, 4) AS accuracy, round(precision, 4) AS precision,
           round(recall, 4) AS recall, round(brier, 4) AS brier, round(log_loss, 4) AS log_loss,
           round(base_rate, 4) AS base_rate, round(greatest(base_rate, 1 - base_rate), 4) AS majority_class_accuracy, n
    FROM {p}m, {p}auc AS a
)"""


def scores_sql(src: str) -> str:
    """The score record over ``src``, rounded to 4 (continues a ``WITH`` list)."""
    return scores_ctes(src) + "\nSELECT * FROM rec"


def calibration_sql(src: str, edges: list[float], labels: list[str]) -> str:
    lit = [f"CAST('{e!r}' AS DOUBLE)" for e in edges]
    case = "CASE WHEN p_cancel < " + lit[0] + " THEN NULL " + " ".join(
        f"WHEN p_cancel <= {lit[i + 1]} THEN {i}" for i in range(len(edges) - 1)) + " END"
    label = "CASE bin_index " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(labels)) + " END"
    return f"""
b AS (SELECT {case} AS bin_index, p_cancel, CAST(is_canceled AS INTEGER) AS y FROM {src})
SELECT {label} AS bin, bin_index, count(*) AS n, round(avg(p_cancel), 4) AS predicted, round(avg(y), 4) AS actual
FROM b WHERE bin_index IS NOT NULL GROUP BY bin_index"""


def weekly_cte(src: str, name: str = "weekly") -> str:
    return f"""
{name} AS (
    SELECT hotel, CAST(date_trunc('week', arrival_date) AS DATE) AS week, count(*) AS bookings,
           round(sum(p_cancel), 6) AS predicted, CAST(sum(CAST(is_canceled AS INTEGER)) AS BIGINT) AS actual
    FROM {src} GROUP BY 1, 2
)"""


def curve_cte(src: str, name: str, walkaway: float, resale: float, keys: str = "") -> str:
    """Direct evaluation at each of the 101 thresholds (a threshold x row scan), optionally per keys."""
    kc = f"{keys}, " if keys else ""
    f = "e.p_cancel >= th.threshold"
    w, r = f"CAST({walkaway!r} AS DECIMAL(9,6))", f"CAST({resale!r} AS DECIMAL(9,6))"
    fn = "CAST(e.adr_eur AS DECIMAL(18,6)) * least(e.nights, 1)"
    rev = "CAST(e.room_revenue_eur AS DECIMAL(18,6))"
    gain = f"coalesce(sum((1 - {w}) * {fn}) FILTER (WHERE {f} AND e.is_canceled), 0)"
    loss = f"coalesce(sum({w} * (1 - {r}) * {rev}) FILTER (WHERE {f} AND NOT e.is_canceled), 0)"
    return f"""
{name} AS (
    SELECT {kc}th.threshold,
        count(*) FILTER (WHERE {f}) AS flagged,
        round(avg(CAST({f} AS INTEGER)), 4) AS flagged_share,
        count(*) FILTER (WHERE {f} AND e.is_canceled) AS cancellations_caught,
        round(CAST(count(*) FILTER (WHERE {f} AND e.is_canceled) AS DOUBLE)
              / greatest(count(*) FILTER (WHERE e.is_canceled), 1), 4) AS catch_rate,
        CAST(round({gain}, 2) AS DOUBLE) AS gain_eur,
        CAST(round({loss}, 2) AS DOUBLE) AS loss_eur,
        CAST(round({gain} - {loss}, 2) AS DOUBLE) AS net_eur
    FROM (SELECT CAST(k AS DOUBLE) / 100 AS threshold FROM range(101) AS g(k)) th, {src} e
    GROUP BY {kc}th.threshold
)"""

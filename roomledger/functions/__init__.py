"""Column expressions shared by the operators. Every function returns a ``pyspark.sql.Column`` built
from built-in functions only, so it stays inside whole-stage codegen."""

from roomledger.functions.dates import (
    month_floor,
    month_label,
    parse_month_name_date,
    week_start,
    weekday_name,
    weekday_number,
)
from roomledger.functions.exprs import (
    as_int,
    bool_to_int,
    lead_time_band,
    round_half_up,
    safe_div,
    sum_if,
    yes_no_label,
)

__all__ = [
    "as_int",
    "bool_to_int",
    "lead_time_band",
    "month_floor",
    "month_label",
    "parse_month_name_date",
    "round_half_up",
    "safe_div",
    "sum_if",
    "week_start",
    "weekday_name",
    "weekday_number",
    "yes_no_label",
]

"""Scalar expressions: casts, bands, guarded ratios, conditional sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values (must equal the reference): lead-time bands, upper bounds inclusive, in order.
LEAD_TIME_BANDS = [
    (7, "0-7 days"),
    (30, "8-30 days"),
    (90, "31-90 days"),
    (180, "91-180 days"),
    (365, "181-365 days"),
]
LEAD_TIME_TOP_BAND = "365+ days"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_int(c: Column | str, source_type=None) -> Column:
    """Cast to INT. Text such as ``'40.0'`` goes through DOUBLE first: a direct ANSI cast would raise.
    Fractional text is rounded, halves away from zero."""
    col = _c(c)
    if isinstance(source_type, StringType):
        return F.round(col.cast("double")).cast("int")
    return col.cast("int")


def bool_to_int(c: Column | str) -> Column:
    return _c(c).cast("int")


def lead_time_band(days: Column | str) -> Column:
    """Right-closed bands; ``Bucketizer`` is left-closed, hence the chained ``when``."""
    d = _c(days)
    out = None
    for upper, label in LEAD_TIME_BANDS:
        out = F.when(d <= upper, F.lit(label)) if out is None else out.when(d <= upper, F.lit(label))
    return out.otherwise(F.lit(LEAD_TIME_TOP_BAND))


def safe_div(num: Column, den: Column) -> Column:
    """``num / nullif(den, 0)``: null instead of an ANSI division-by-zero error."""
    return num / F.nullif(den, F.lit(0))


def sum_if(cond: Column, value: Column) -> Column:
    """``sum(value) filter (where cond)``: null when no row qualifies."""
    return F.sum(F.when(cond, value))


def yes_no_label(cond: Column, yes: str, no: str) -> Column:
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def round_half_up(c: Column | str, digits: int) -> Column:
    return F.round(_c(c), digits)

"""The dashboard's data (E08-E11, J17, G01): every section as a DataFrame, ordered only here, at the
sink, where the page needs a stable order."""

from __future__ import annotations

from pyspark.sql import DataFrame

from roomledger.operators import quality, summaries
from roomledger.sources.files import records


def dashboard_sections(wh, rule_results: DataFrame, models: int) -> dict[str, DataFrame]:
    return {
        "totals": records(summaries.booking_totals(wh.fct)),
        "quality": summaries.quality_counters(wh.stg),
        "tests": quality.run_summary(rule_results, models),
        "warnings": quality.run_warnings(rule_results).orderBy("test"),
        "monthly": records(wh.monthly).orderBy("hotel", "arrival_month"),
        "drivers": records(wh.drivers).orderBy("dimension", "value"),
        "cancel_timing": records(summaries.cancel_timing(wh.fct)).orderBy("hotel"),
    }

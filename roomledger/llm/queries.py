"""Queries of the operators, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roomledger.llm.collocations import op13_collocations, op13_sql
from roomledger.llm.cost_packing import op12_cost_packing
from roomledger.llm.fingerprints import op5_fingerprints
from roomledger.llm.infilling import OP11_SQL, op11_fill_in_middle
from roomledger.llm.line_dedup import op9_line_dedup
from roomledger.llm.lm_scoring import op4_lm_scoring
from roomledger.llm.near_duplicates import op8_near_duplicates
from roomledger.llm.packing import op1_best_fit_packing
from roomledger.llm.personal_data import op6_personal_data
from roomledger.llm.pieces import op2_piece_sampling
from roomledger.llm.quality_classifier import op7_quality_classifier
from roomledger.llm.quality_rules import op3_quality_rules
from roomledger.llm.toxicity import op10_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_best_fit_packing, op2_piece_sampling, op3_quality_rules, op4_lm_scoring, op5_fingerprints, op6_personal_data,
    op7_quality_classifier, op8_near_duplicates, op9_line_dedup, op10_toxicity,
    op11_fill_in_middle, op12_cost_packing, op13_collocations)}
ORACLE: dict[str, str] = {"op11_fill_in_middle": OP11_SQL, "op13_collocations": op13_sql()}

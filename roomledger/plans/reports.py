"""Report documents (A09): the decision-rule report as one row of nested structs, built lazily from
the backtest operators (no collect), ready for ``write.json``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.operators import policy


def _rows(df: DataFrame, first: str) -> DataFrame:
    """All rows of a small result as one sorted array of structs (``first`` leads each struct)."""
    cols = [first] + [c for c in df.columns if c != first]
    return df.agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("v")).select("v")


def _one(df: DataFrame) -> DataFrame:
    return df.select(F.struct(*df.columns).alias("v"))


def policy_report(valid: DataFrame, test: DataFrame, walkaway: float = policy.BASE_WALKAWAY,
                  resale: float = policy.BASE_RESALE) -> DataFrame:
    """Eligible population, chosen threshold, base / blanket / per-hotel outcomes, sensitivity grid and the
    threshold curve; ``valid`` and ``test`` are eligible rows.

    The rows of each period are read once: their bucket sums (per hotel, at most 102 rows per hotel)
    are checkpointed to the shared folder, and the population, every curve, the chosen threshold and
    the 12-case grid are derived from those small tables. Every list in the document holds at most 101
    entries.
    """
    from roomledger.session import checkpoint_root

    checkpoint_root(test.sparkSession)
    vb = policy.bucket_sums(valid, ["hotel"]).checkpoint(eager=True)
    tb = policy.bucket_sums(test, ["hotel"]).checkpoint(eager=True)
    curve = policy.curve_from_buckets(tb).select(*policy.outcomes(walkaway, resale))
    valid_curve = policy.curve_from_buckets(vb).select(*policy.outcomes(walkaway, resale))
    chosen = policy.best_threshold(valid_curve).select("threshold").scalar()
    per_hotel = (policy.curve_from_buckets(tb, ["hotel"]).select("hotel", *policy.outcomes(walkaway, resale))
                 .filter(F.col("threshold") == chosen))
    return policy.population_from_buckets(tb).select(
        F.struct(F.lit(walkaway).alias("walkaway"), F.lit(resale).alias("resale")).alias("assumptions_base"),
        "eligible_bookings", "eligible_cancellations", "eligible_cancelled_revenue_eur",
        chosen.alias("chosen_threshold"),
        _one(curve.filter(F.col("threshold") == chosen)).scalar().alias("base_case"),
        _one(curve.filter(F.col("threshold") == 0)).scalar().alias("blanket_deposit_base_case"),
        _rows(per_hotel, "hotel").scalar().alias("per_hotel_base_case"),
        _rows(policy.sensitivity_from_buckets(vb, tb), "walkaway").scalar().alias("sensitivity"),
        _rows(curve, "threshold").scalar().alias("threshold_curve_base_case"),
    )


def model_report(fct: DataFrame, scored: DataFrame, valid_start: str, test_start: str, **tables: DataFrame) -> DataFrame:
    """The model run's whole metrics document (L07): split sizes, both periods' scores, the weekly table with its error and
    the nested calibration table. Further small tables, such as importances or comparison runs, become lists under their names.

    The scored rows are read for the scores, and once more for the weekly and the calibration sums; every list has at
    most one entry per hotel and week, per bin, or per row of ``tables``.
    """
    from roomledger.operators import metrics, splits
    from roomledger.session import checkpoint_root

    checkpoint_root(scored.sparkSession)
    test = scored.filter(F.col("split") == "test")
    weekly = metrics.weekly_forecast(test).checkpoint(eager=True)
    return _one(splits.split_sizes(fct, valid_start, test_start)).select(
        F.col("v").alias("split"),
        _one(metrics.classification_scores(test)).scalar().alias("test"),
        _one(metrics.classification_scores(scored.filter(F.col("split") == "valid"))).scalar().alias("valid"),
        _rows(metrics.calibration_table(test), "bin_index").scalar().alias("calibration"),
        _one(metrics.forecast_error(weekly)).scalar().alias("weekly_forecast"),
        _rows(weekly, "hotel").scalar().alias("weekly"),
        *[_rows(df, df.columns[0]).scalar().alias(name) for name, df in tables.items()])


def dashboard_document(sections: dict[str, DataFrame], single: tuple[str, ...] = ("totals", "quality", "tests")) -> DataFrame:
    """The page payload as one document: ``single`` sections as one record, the others as lists sorted by their columns."""
    first, *rest = [(_one(df) if name in single else _rows(df, df.columns[0]), name) for name, df in sections.items()]
    return first[0].select(F.col("v").alias(first[1]), *[doc.scalar().alias(name) for doc, name in rest])


def document_rows(doc: DataFrame) -> DataFrame:
    """A one-row document of structs and lists of structs as rows (section, item, field, value, label): numbers in
    ``value``, other fields as text in ``label``; ``item`` counts a list's entries from 0."""
    parts = []
    for f in doc.schema.fields:
        listed = hasattr(f.dataType, "elementType")
        entry = f.dataType.elementType if listed else f.dataType
        rows = (doc.select(F.posexplode(f.name).alias("item", "e")) if listed
                else doc.select(F.lit(0).alias("item"), F.col(f.name).alias("e")))
        fields = []
        for g in entry.fields:
            number = g.dataType.simpleString() in ("int", "bigint", "double") or g.dataType.simpleString().startswith("decimal")
            c = F.col("e").getField(g.name)
            fields.append(F.struct(F.lit(g.name).alias("field"), (c.cast("double") if number else F.lit(None).cast("double")).alias("value"),
                                   (F.lit(None).cast("string") if number else c.cast("string")).alias("label")))
        parts.append(rows.select(F.lit(f.name).alias("section"), F.col("item").cast("long").alias("item"), F.inline(F.array(*fields))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

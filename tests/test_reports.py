"""Documents: written as JSON, read back, laid out in rows."""

import datetime as dt

from pyspark.sql import functions as F

from roomledger.plans.reports import dashboard_document, document_rows
from roomledger.session import scratch_path
from roomledger.sources import files


def test_document_keeps_nulls_order_and_empty_lists(spark):
    single = spark.createDataFrame([(3, None, dt.date(2017, 1, 2))], "n long, rate double, day date")
    listed = spark.createDataFrame([("b", 1.5), ("a", None), ("c", 0.1)], "name string, x double")
    doc = dashboard_document({"totals": single, "list": listed, "none": listed.where(F.lit(False))})
    assert doc.count() == 1
    path = scratch_path(spark, "document")
    files.write_report(doc, path)
    got = [tuple(r) for r in document_rows(spark.read.schema(doc.schema).json(path)).collect()]
    assert sorted(got, key=str) == sorted([
        ("totals", 0, "n", 3.0, None), ("totals", 0, "rate", None, None), ("totals", 0, "day", None, "2017-01-02"),
        ("list", 0, "name", None, "a"), ("list", 0, "x", None, None), ("list", 1, "name", None, "b"), ("list", 1, "x", 1.5, None),
        ("list", 2, "name", None, "c"), ("list", 2, "x", 0.1, None)], key=str)


def test_model_report_takes_further_tables(spark):
    from roomledger.plans.registry import backoff_scored
    from roomledger.plans.reports import model_report
    from roomledger.plans.warehouse import facts
    from roomledger.sources.fixtures import TEST_START, VALID_START
    sf = "/root/testdata/sf0.01"
    gains = spark.createDataFrame([("lead_time_days", 12.5), ("adr_eur", 3.0)], "feature string, gain double")
    doc = model_report(facts(spark, sf), backoff_scored(spark, sf), VALID_START, TEST_START, importances=gains).first()
    assert [r.feature for r in doc.importances] == ["adr_eur", "lead_time_days"]
    assert doc.split.test == doc.test.n == sum(r.bookings for r in doc.weekly)
    assert sum(r.n for r in doc.calibration) == doc.test.n

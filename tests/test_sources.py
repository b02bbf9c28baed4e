"""Sources and sinks: fingerprints, null tokens, file-order ids."""

import hashlib

from pyspark.sql import functions as F

from roomledger.operators.rowid import with_row_id
from roomledger.session import scratch_path
from roomledger.sources import files

from .conftest import SF_SMALL


def test_fingerprint_equals_hashlib(spark):
    path = f"{SF_SMALL}/orders.parquet"
    got = files.file_fingerprints(spark, [path]).first()
    with open(path, "rb") as f:
        assert got.sha256 == hashlib.sha256(f.read()).hexdigest()
    expected = spark.createDataFrame([("orders.parquet", "0" * 64)], "file string, sha256 string")
    assert files.verify_fingerprints(files.file_fingerprints(spark, [path]), expected).count() == 1


def test_rows_checksum_ignores_order_and_sees_changes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, v string")
    bits = 0
    for k, v in ((1, "a"), (2, "b")):
        bits ^= int(hashlib.md5(f"{k}|{v}".encode()).hexdigest()[:8], 16)
    sums = [files.rows_checksum(x, "t", ["k", "v"]).first() for x in (df, df.orderBy("v").repartition(3), df.where("k < 3"))]
    assert sums[0] == sums[1] == ("t", 3, bits)
    assert sums[2] == ("t", 2, bits)
    assert files.rows_checksum(df.where("k = 1"), "t", ["k", "v"]).first().checksum != bits


def test_both_null_tokens_read_as_null(spark):
    path = scratch_path(spark, "tokens")
    df = spark.createDataFrame([("x", None, None), ("y", "1", "2")], "a string, b string, c string")
    files.write_raw_csv(df, path, null_token_by_column={"b": "NULL"}, default_null="NA")
    back = {r.a: (r.b, r.c) for r in files.read_csv_with_null_tokens(spark, path).collect()}
    assert back == {"x": (None, None), "y": ("1", "2")}


def test_row_ids_are_dense_and_in_file_order_across_files(spark):
    path = scratch_path(spark, "ordered")
    df = spark.range(0, 5000).selectExpr("id AS k", "CAST(id * 3 AS STRING) AS v").repartition(7)
    files.write_raw_csv(df.selectExpr("CAST(k AS STRING) AS ks", "v", "k"), path, order_by="k")
    back = files.read_csv_with_null_tokens(spark, path, row_id="rid")
    rows = back.selectExpr("CAST(ks AS LONG) AS k", "rid").collect()
    assert sorted(r.rid for r in rows) == list(range(1, 5001))
    assert all(r.rid == r.k + 1 for r in rows)


def test_row_ids_on_parquet_follow_the_stored_order(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    rows = with_row_id(orders, "rid").collect()
    assert all(r.rid == r.o_orderkey + 1 for r in rows)


def test_records_format_dates_and_round_doubles(spark):
    import datetime as dt
    import json
    df = spark.createDataFrame([("a", dt.date(2017, 1, 2), 0.123456, 3)], "k string, d date, x double, n int")
    rec = json.loads(files.records_json(df).first().record)
    assert rec == {"k": "a", "d": "2017-01-02", "x": 0.1235, "n": 3}


def test_read_table_orders_only_when_asked(spark):
    path = scratch_path(spark, "table")
    spark.range(0, 50).selectExpr("49 - id AS k").repartition(3).write.parquet(path)
    assert [r.k for r in files.read_table(spark, path, order_by=["k"]).collect()] == list(range(50))
    assert files.read_table(spark, path).count() == 50


def test_manifest_check_sees_every_planted_fault(spark):
    rows = [(i, None if i % 3 else f"v{i}", f"w{i}" if i % 2 else None, i / 4) for i in range(60)]
    schema = "k long, a string, b string, x double"

    def deliver(name, groups):
        path = scratch_path(spark, name)
        for unit, part in groups.items():
            spark.createDataFrame(part, schema).repartition(2).write.parquet(f"{path}/unit={unit}")
        return files.file_digests(spark, path, F.regexp_extract("_metadata.file_path", "/unit=([a-z_]+)/", 1))

    clean = {u: rows[n * 10:n * 10 + 10] for n, u in enumerate(("same", "changed", "short", "twice", "moved", "gone"))}
    faulty = {
        "same": clean["same"][::-1],
        "changed": [(10, "other", None, 2.5), *clean["changed"][1:]],
        "short": clean["short"][1:],
        "twice": [*clean["twice"][2:], clean["twice"][5], clean["twice"][5]],  # as many rows, one of them three times
        "moved": [(k, b, a, x) for k, a, b, x in clean["moved"]],
        "new": rows[:4]}
    got = {r.unit: (r.rows_listed, r.rows_found, r.status)
           for r in files.check_manifest(deliver("delivered", faulty), deliver("listed", clean)).collect()}
    assert got == {"same": (10, 10, "ok"), "changed": (10, 10, "changed"), "short": (10, 9, "rows"), "twice": (10, 10, "changed"),
                   "moved": (10, 10, "changed"), "gone": (10, None, "missing"), "new": (None, 4, "unlisted")}


def test_file_digests_split_one_file_over_tasks(spark):
    path = f"{SF_SMALL}/orders.parquet"
    whole = files.file_digests(spark, path).collect()
    rows = spark.read.parquet(path)
    assert [r.unit for r in whole] == ["orders.parquet"]
    spread = files.unit_digests(rows.repartition(5), F.lit("orders.parquet"), rows.columns).collect()
    assert whole == spread
    assert files.unit_digests(rows.limit(0), F.lit("x"), rows.columns).count() == 0

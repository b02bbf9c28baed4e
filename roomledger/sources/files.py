"""File sources and sinks (A01-A11): CSV with two null tokens, input fingerprints, parquet / CSV / JSON
tables and report documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Null tokens of the source file.
NULL_TOKENS = ("NULL", "NA")


def read_csv_with_null_tokens(spark: SparkSession, path: str, columns: list[str] | None = None,
                              null_tokens=NULL_TOKENS, row_id: str | None = None) -> DataFrame:
    """CSV scan with a header, every column read as text, and *each* of ``null_tokens`` read as null.

    The CSV reader takes a single ``nullValue``; the tokens are therefore mapped after the scan. The
    schema is explicit (no inference pass over the data); staging casts the text to its types.
    """
    if columns is None:
        columns = [c.strip() for c in spark.read.option("header", True).csv(path).columns]
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    df = (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
          .option("enforceSchema", False).csv(path))
    extra = []
    if row_id:  # numbered on the scan itself, where the file and block of each row are known
        from roomledger.operators.rowid import with_row_id
        df = with_row_id(df, row_id)
        extra = [F.col(row_id)]
    tokens = list(null_tokens)
    return df.select(*extra, *[F.when(~F.col(c).isin(tokens), F.col(c)).alias(c) for c in columns])


def write_raw_csv(raw: DataFrame, path: str, order_by: str | None = None,
                  null_token_by_column: dict[str, str] | None = None, default_null: str = "NA") -> None:
    """Write rows as header CSV text, nulls spelled with a token per column (default ``NA``).

    With ``order_by`` the rows are range-partitioned and sorted first, so part files are in key order and
    a file-order numbering of the output follows the key.
    """
    tokens = null_token_by_column or {}
    text = raw.select(*[F.coalesce(F.col(c).cast("string"), F.lit(tokens.get(c, default_null))).alias(c)
                        for c in raw.columns if c != order_by] + ([F.col(order_by)] if order_by else []))
    if order_by:
        text = text.orderBy(order_by).drop(order_by)
    text.write.mode("overwrite").option("header", True).csv(path)


def file_fingerprints(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SHA-256 and size of every input file (``binaryFile``; one task per file, hashed JVM-side)."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select(F.element_at(F.split(F.col("path"), "/"), -1).alias("file"),
                        F.col("length").alias("bytes"), F.sha2(F.col("content"), 256).alias("sha256"))


def rows_checksum(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """One row: source, n_rows, checksum (exclusive or of 32 bits of each row's MD5). One aggregate over the scan's splits, so
    no file is read as a whole; rows with a null in ``columns`` count in n_rows only."""
    digest = F.md5(F.concat(*[x for c in columns for x in (F.lit("|"), F.col(c).cast("string"))][1:]).cast("binary"))
    bits = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(bits).alias("checksum")).select(
        F.lit(name).alias("source"), "n_rows", "checksum")


def row_digest(columns: list[str]) -> tuple[Column, Column]:
    """Two 60-bit numbers out of a row's MD5. Each value is written with its length and a null by a sign of its own, so
    neither a null nor a value moved to the next column gives an equal text."""
    text = F.concat(*[F.when(F.col(c).isNull(), F.lit("-")).otherwise(
        F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string"))) for c in columns])
    md5 = F.md5(text.cast("binary"))
    return tuple(F.conv(F.substring(md5, at, 15), 16, 10).cast("decimal(20,0)") for at in (1, 16))


def unit_digests(df: DataFrame, unit: Column, columns: list[str] | None = None) -> DataFrame:
    """(unit, n_rows, digest_a, digest_b) per unit of a table: a file, a folder or the table itself.

    The digests are exact decimal sums of the row digests, so they do not depend on row order or on how files are split,
    rows that occur several times count as often, and no file is read as one value: the scan splits files of any size
    and folds each split to one row per unit before the shuffle. A file without rows has no unit.
    """
    a, b = row_digest(columns or df.columns)
    sums = (df.select(unit.alias("unit"), a.alias("a"), b.alias("b")).groupBy("unit")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("a").alias("a"), F.sum("b").alias("b")))
    return sums.select("unit", "n_rows", F.col("a").cast("string").alias("digest_a"), F.col("b").cast("string").alias("digest_b"))


def file_digests(spark: SparkSession, path: str, unit: Column | None = None) -> DataFrame:
    """:func:`unit_digests` of a parquet table by file name (or by ``unit``, made from ``_metadata``)."""
    df = spark.read.parquet(path)
    return unit_digests(df, F.col("_metadata.file_name") if unit is None else unit, df.columns)


def check_manifest(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """(unit, rows_listed, rows_found, status) of every unit of the manifest or the delivery: ``ok``, ``missing``,
    ``unlisted``, ``rows`` (another number of rows) or ``changed`` (as many rows, other contents)."""
    m, f = manifest.alias("m"), found.alias("f")
    status = (F.when(F.col("f.n_rows").isNull(), "missing").when(F.col("m.n_rows").isNull(), "unlisted")
              .when(F.col("m.n_rows") != F.col("f.n_rows"), "rows")
              .when((F.col("m.digest_a") != F.col("f.digest_a")) | (F.col("m.digest_b") != F.col("f.digest_b")), "changed")
              .otherwise("ok"))
    return m.join(f, F.col("m.unit").eqNullSafe(F.col("f.unit")), "full").select(
        F.coalesce("m.unit", "f.unit").alias("unit"), F.col("m.n_rows").alias("rows_listed"),
        F.col("f.n_rows").alias("rows_found"), status.alias("status"))


def verify_fingerprints(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Files whose hash differs from (or is missing in) the pinned manifest ``expected(file, sha256)``."""
    return expected.join(actual.select("file", F.col("sha256").alias("actual")), "file", "left").filter(
        F.col("actual").isNull() | (F.col("actual") != F.col("sha256")))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header CSV with a declared schema (e.g. ``'hotel STRING, week DATE, ...'``)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_report(doc: DataFrame, path: str) -> None:
    """A report document (one row of structs / arrays) as JSON."""
    doc.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return spark.read.option("multiLine", multiline).json(path)


def records(df: DataFrame, digits: int = 4) -> DataFrame:
    """Rows made presentable: dates as ``yyyy-MM-dd`` text, doubles rounded to ``digits``."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if t in ("date", "timestamp", "timestamp_ntz"):
            out.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        elif t in ("double", "float"):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def records_json(df: DataFrame, digits: int = 4) -> DataFrame:
    """Each record as one JSON object (``to_json(struct(*))``)."""
    rec = records(df, digits)
    return rec.select(F.to_json(F.struct(*rec.columns)).alias("record"))


def read_table(spark: SparkSession, path: str, order_by: list[str] | None = None) -> DataFrame:
    """Parquet table scan (A04); ordered only when a caller asks for it (``orderBy`` is a global sort)."""
    df = spark.read.parquet(path)
    return df.orderBy(*order_by) if order_by else df

"""Time split (C03), deterministic shuffled split and twin leakage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLITS = ("fit", "valid", "train", "test")


def arrival_window(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows with ``start <= arrival_date < end`` (either bound optional).

    When the table carries ``arrival_month`` (the partition column of the stored facts) the implied
    month bounds are added too, so the scan reads only the month folders in the window.
    """
    d = F.col("arrival_date")
    has_month = "arrival_month" in df.columns
    if start is not None:
        lo = F.lit(start).cast("date")
        df = df.filter(d >= lo)
        if has_month:
            df = df.filter(F.col("arrival_month") >= F.trunc(lo, "month"))
    if end is not None:
        hi = F.lit(end).cast("date")
        df = df.filter(d < hi)
        if has_month:
            df = df.filter(F.col("arrival_month") < hi)  # a month that starts at the bound holds no row
    return df


def time_split(df: DataFrame, valid_start: str, test_start: str) -> dict[str, DataFrame]:
    """Named, overlapping subsets by arrival date: fit < V <= valid < T, train = fit + valid, test >= T.

    Plain filters on one table; when the table is stored by arrival month they prune partitions.
    """
    return {
        "fit": arrival_window(df, end=valid_start),
        "valid": arrival_window(df, valid_start, test_start),
        "train": arrival_window(df, end=test_start),
        "test": arrival_window(df, start=test_start),
    }


def split_label(valid_start: str, test_start: str):
    """Column naming the split of each row (null before ``valid_start``; fit rows are also train)."""
    d = F.col("arrival_date")
    return (F.when(d >= F.lit(test_start).cast("date"), F.lit("test"))
            .when(d >= F.lit(valid_start).cast("date"), F.lit("valid")))


def split_sizes(df: DataFrame, valid_start: str, test_start: str) -> DataFrame:
    """Row count of each named subset from ONE conditional aggregate (not four scans)."""
    d = F.col("arrival_date")
    v, t = F.lit(valid_start).cast("date"), F.lit(test_start).cast("date")
    return df.agg(
        F.count_if(d < v).alias("fit"),
        F.count_if((d >= v) & (d < t)).alias("valid"),
        F.count_if(d < t).alias("train"),
        F.count_if(d >= t).alias("test"),
    )


# Row hash of the shuffled split: the first 32 bits of the MD5 of a seed text and the key. Neighbouring keys fall
# independently, every engine has MD5, and the hold-out is the same on every run.
SPLIT_SEED = "split-7:"
HASH_WORD = 2 ** 32


def row_hash32(key: str = "booking_id"):
    digest = F.md5(F.concat(F.lit(SPLIT_SEED), F.col(key).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def shuffled_holdout(key: str = "booking_id", buckets: int = 4):
    """True for the 1-in-``buckets`` hold-out of a shuffled split (highest hash range)."""
    return row_hash32(key) >= F.lit(HASH_WORD - HASH_WORD // buckets)


def twin_leak_count(df: DataFrame, twin_key: list[str], holdout) -> DataFrame:
    """Hold-out rows with an identical row (on ``twin_key``, null-safe) in the training part.

    ``left_semi`` join on every key column with ``<=>``; Spark plans it as a hash/sort-merge join on the
    key, so no pairs are emitted. The training keys are de-duplicated first (a partial aggregate folds a
    hot key to one row per task), so a key shared by many rows is one row on the build side and only
    the probe side can be skewed, which AQE splits. Returns one row: hold-out rows, and how many of them
    have a twin in train.
    """
    test = df.filter(holdout)
    train = (df.filter(~holdout).select(*[F.col(c).alias(f"__t_{n}") for n, c in enumerate(twin_key)])
             .dropDuplicates())
    cond = [test[c].eqNullSafe(train[f"__t_{n}"]) for n, c in enumerate(twin_key)]
    leaked = test.join(train, cond, "left_semi")
    return test.agg(F.count(F.lit(1)).alias("holdout_rows")).withColumn(
        "holdout_rows_with_train_twin", leaked.select(F.count(F.lit(1))).scalar())

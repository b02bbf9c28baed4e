"""Dense surrogate key in file order (F01): ``row_number() over ()`` without a one-partition window.

Rows are numbered per file block: the scan records which file and which byte offset each row came
from (``_metadata.file_path``, ``_metadata.file_block_start``) and ``monotonically_increasing_id``,
which is consecutive within a block because a block is read front to back by one task. A small table
with one row per block (count, smallest id) gets running offsets in (path, offset) order; it has one row
per input split (bounded by the number of scan tasks). It is joined back on (64-bit path hash, block
start), so each entry is a few longs, and broadcast after its size is measured (a shuffle join above the
limit). Each row then gets ``offset + (id - smallest id of its block) + 1``.

The numbering is only as stable as the input: both branches re-read the same immutable files with the
same split plan, so a task that is re-run after an executor loss gives the same ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomledger.operators.joins import checked_broadcast


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Append a 1-based dense ``name`` column in file order; ``df`` must be a file scan (or narrow ops on one)."""
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.xxhash64(F.col("_metadata.file_path")).alias("__fh"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__mono"),
    )
    blocks = tagged.groupBy("__file", "__fh", "__block").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__mono").alias("__first")
    )
    # One row per input split: a bounded table, so the ordered window below runs on split counts only.
    order = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "__fh", "__block", "__first",
        F.coalesce(F.sum("__n").over(order), F.lit(0)).alias("__offset"),
    )
    out = tagged.join(checked_broadcast(offsets), ["__fh", "__block"], "inner")
    rid = F.col("__offset") + (F.col("__mono") - F.col("__first")) + 1
    return out.select(*[F.col(c) for c in df.columns], rid.cast("long").alias(name))

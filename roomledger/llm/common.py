"""Pieces shared by the operators: block-wise Arrow maps, word splitting, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.session import scratch_path, table_path

# Text bytes handled at once in a Python worker. A single longer text forms a block of its own.
BLOCK_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again: computed once, lineage cut, safe
    when executors are lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (null id: 0)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def give_back() -> None:
    """Returns memory that Arrow and the allocator of this process hold without using it; called at the end of a task,
    since workers live on and the next stage's tasks would come on top."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def blocks(text: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo, n = 0, len(ends)
    while lo < n:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
        yield lo, hi
        lo = hi


def resolved(df: DataFrame, name: str) -> int:
    """Position of a column by exact name (the first, if names clash)."""
    return df.columns.index(name)


def map_text(df: DataFrame, text_col: str, keep: list[str] | None, fields: list[tuple[str, T.DataType]],
             make: Callable[[], Callable[[pa.Array], list]], max_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Columns computed from whole texts, beside the ``keep`` columns (None: all) of the same row.

    ``make()`` runs once per task and returns a function from an Arrow text array (nulls included) to one
    array per field. Columns are addressed by position, so other columns may have any name.
    """
    at = resolved(df, text_col)
    kept = list(range(len(df.columns))) if keep is None else [resolved(df, c) for c in keep]
    names = [df.columns[i] for i in kept]
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    slim = flat.select(*[F.col(f"c{i}").alias(f"k{j}") for j, i in enumerate(kept)],
                       F.col(f"c{at}").cast("string").alias("t"))
    schema = T.StructType([T.StructField(f"k{j}", slim.schema[f"k{j}"].dataType) for j in range(len(kept))]
                          + [T.StructField(f"n{j}", t) for j, (_, t) in enumerate(fields)])
    width = len(kept)

    def run(batches):
        fn = make()
        for batch in batches:
            text = batch.column(width)
            for lo, hi in blocks(text, max_bytes):
                new = fn(text.slice(lo, hi - lo))
                arrays = [batch.column(j).slice(lo, hi - lo) for j in range(width)]
                arrays += [a if isinstance(a, pa.Array) else pa.array(a) for a in new]
                yield pa.RecordBatch.from_arrays(arrays, [f"k{j}" for j in range(width)]
                                                 + [f"n{j}" for j in range(len(new))])
        give_back()

    out = slim.mapInArrow(run, schema)
    return out.toDF(*names, *[n for n, _ in fields])


class Words:
    """Words (runs of other than ASCII white space) of a block: ``codes`` index ``vocab`` (Arrow strings),
    document d holds codes[starts[d]:starts[d + 1]]."""

    def __init__(self, text: pa.Array, lower: bool = False):
        text = pc.fill_null(text, "")
        if lower:
            text = pc.ascii_lower(text)
        parts = pc.ascii_split_whitespace(text)
        values = parts.flatten()
        bounds = np.concatenate([[0], np.cumsum(parts.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        coded = pc.dictionary_encode(values)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        empty = np.flatnonzero(pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) == 0)
        if len(empty):
            real = codes != empty[0]
            bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
            codes = codes[real]
        self.vocab, self.codes, self.starts = coded.dictionary, codes.astype(np.int32), bounds
        self.counts = np.diff(bounds)
        self.n_docs = len(self.counts)

    def doc(self) -> np.ndarray:
        """Document number of each word."""
        return np.repeat(np.arange(self.n_docs), self.counts)


def doc_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each document's range; empty ranges give 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def flat_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string array without nulls, and the bounds of each value."""
    strings = strings.cast(pa.large_string())
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    return raw[offsets[0]:offsets[-1]], (offsets - offsets[0])


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (two multiply-xorshift rounds), element-wise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def word_hashes(vocab: pa.Array) -> np.ndarray:
    """64-bit hash of each vocabulary entry."""
    import xxhash
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in vocab.cast(pa.binary()).to_pylist()), np.uint64, len(vocab))


def bounded_sample(df: DataFrame, id_col: str, text_col: str, rows: int, max_chars: int) -> DataFrame:
    """At most ``rows`` rows (smallest hash of the id first) whose text has at most ``max_chars`` characters.

    For fitting on a bounded sample only. Ids are chosen first, so that a task hands over ids, not texts.
    """
    chosen = (df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id")).distinct()
              .orderBy(F.xxhash64(F.col("__id").cast("string")), "__id").limit(rows))
    return df.join(F.broadcast(chosen), F.col(id_col) == F.col("__id"), "left_semi").where(
        F.length(text_col) <= max_chars)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, max_chars: int, id_col: str = "doc_id",
                    text_col: str = "text") -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``rows`` documents of each label, smallest hash of the id first (null text: empty).

    For fitting on a bounded sample only. Only documents of at most ``max_chars`` characters that exist are candidates, so
    long or missing ones do not thin the sample out. Of repeated labels the lowest counts; of documents that repeat an id
    further rows may come along, up to twice ``rows`` in all.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).where(F.length("text") <= max_chars)
    marked = labels.groupBy(F.col("doc_id").alias("id")).agg(F.min(label).alias("y"))
    fit_for_use = stored(marked.join(slim.select("id"), "id", "left_semi"), "labelled")  # ids and labels only
    texts, ys = [], []
    for y in (0, 1):
        chosen = bounded_sample(fit_for_use.where(F.col("y") == y), "id", "y", rows, max_chars).select("id")
        found = slim.join(F.broadcast(chosen), "id", "left_semi").orderBy("id", "text").limit(2 * rows).select("text").collect()
        texts += [r[0] for r in found]
        ys += [y] * len(found)
    return texts, ys

"""Best-fit packing of tokenised documents into sequences (operator 1).

Documents become token ids plus an end id. Longer ones are cut into full sequences and a rest. All pieces are
then packed by best-fit decreasing over the whole corpus. The order only depends on piece lengths, so the
plan is made from the histogram of lengths (at most ``capacity`` entries, whatever the corpus size): open
bins with the same remaining capacity form one class, a segment tree over the capacities finds the tightest
class that fits in logarithmic time, and equal pieces are placed many at once, with the same outcome as one
by one. The plan is a list of placements (length, ranks from-to, first bin, pieces per bin, offset), and the
pieces, numbered per length, look up their own.

Number of placements: only opening bins and stopping inside a class start a new run of bins, at most twice a
length, so there are at most 4 x capacity runs, and each holds at most about 90 different lengths. It does not grow
with the corpus beyond that, which bounds both the driver's work and what is sent to the tasks.

Defined results: null text is empty and packs as its end id alone; repeated rows are packed each; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.common import blocks, documents, give_back, resolved, stored
from roomledger.llm.token_ids import CACHE_WORDS, TokenIds

CAPACITY, END_ID = 4096, 1
# Text bytes tokenised at once.
TOKEN_BLOCK_BYTES = 4 << 20


def piece_table(df: DataFrame, id_col: str, text_col: str, tokenizer_path: str, capacity: int = CAPACITY,
                end_id: int = END_ID, with_ids: bool = False, block_bytes: int = TOKEN_BLOCK_BYTES,
                cache_words: int = CACHE_WORDS) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, and the ids themselves if asked for. ``block_bytes`` of text at once
    and ``cache_words`` bound a worker's memory and change no result."""
    id_at, text_at = resolved(df, id_col), resolved(df, text_col)
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    slim = flat.select(F.col(f"c{id_at}").alias("id"), F.col(f"c{text_at}").cast("string").alias("text"))
    fields = [T.StructField("id", slim.schema["id"].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    tail, full = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def run(batches):
        encode = TokenIds(tokenizer_path, cache_words)
        for batch in batches:
            text = pc.fill_null(batch.column(1), "")
            for lo, hi in blocks(text, block_bytes):
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, data in enumerate(encode(text.slice(lo, hi - lo))):
                    data += tail
                    for k in range(0, len(data), full):
                        part = data[k:k + full]
                        row.append(lo + i)
                        piece.append(k // full)
                        start.append(k // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                arrays = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                          pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    arrays.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])
        give_back()

    return slim.mapInArrow(run, T.StructType(fields))


class TightestClass:
    """Segment tree over remaining capacities 0..capacity: marks which occur, finds the smallest marked one
    that is not below a length."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.any = bytearray(2 * self.size)

    def mark(self, capacity: int, on: bool) -> None:
        i = self.size + capacity
        self.any[i] = on
        while i > 1:
            i >>= 1
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def at_least(self, length: int) -> int:
        """Smallest marked capacity >= length, or -1."""
        i = self.size + length
        if self.any[i]:
            return length
        while i > 1:
            if not i & 1 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Best-fit decreasing on a histogram {length: count}. Returns placements with columns (length, first
    rank, first bin, pieces per bin, offset in the bin), sorted by length and rank, and the number of bins.

    Pieces of one length go into the tightest open bin; a bin of remaining capacity c takes floor(c / length)
    of them before the next one becomes tightest, since its capacity only shrinks. Bins of a class are
    consumed in the order of their numbers within its runs.
    """
    tree = TightestClass(capacity)
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # remaining capacity -> [(first bin, bins)]
    plan: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def put(left: int, first: int, count: int) -> None:
        if left and count:
            if not runs[left]:
                tree.mark(left, True)
            runs[left].append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, todo = 0, histogram[length]
        while todo:
            left = tree.at_least(length)
            if left < 0:
                left, first = capacity, bins
                count = -(-todo // (capacity // length))
                bins += count
            else:
                first, count = runs[left].pop()
                if not runs[left]:
                    tree.mark(left, False)
            each = left // length
            filled = min(count, todo // each)
            if filled:
                plan.append((length, rank, first, each, capacity - left))
                put(left - each * length, first, filled)
                rank += filled * each
                todo -= filled * each
                first, count = first + filled, count - filled
            if count and todo:  # fewer than fill a bin remain
                plan.append((length, rank, first, each, capacity - left))
                put(left - todo * length, first, 1)
                first, count, todo = first + 1, count - 1, 0
            put(left, first, count)
    out = np.array(plan, np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))], bins


def pack(pieces: DataFrame, capacity: int = CAPACITY, rows_per_bucket: int = 500_000) -> DataFrame:
    """Adds sequence_id and offset to a stored piece table (columns as of :func:`piece_table`).

    Pieces are numbered within their length by hashed buckets (window per length and bucket, offsets from
    the bucket counts), so that no length, however frequent, is numbered in one task.
    """
    spark = pieces.sparkSession
    counts = [(r.length, r.n) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()]
    plan, _ = best_fit_plan(dict(counts), capacity)
    buckets = max(16, -(-max([n for _, n in counts], default=0) // rows_per_bucket))
    sent = spark.sparkContext.broadcast((plan[:, 0] * (1 << 42) + plan[:, 1], plan))
    keyed = pieces.withColumn("__bucket", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = keyed.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("length", "__bucket", F.coalesce(before, F.lit(0)).alias("__before"))
    ranked = keyed.withColumn("__rank", F.row_number().over(
        Window.partitionBy("length", "__bucket").orderBy("id", "piece", "start", "ids_crc32")) - 1)
    ranked = ranked.join(offsets, ["length", "__bucket"]).withColumn("__rank", F.col("__rank") + F.col("__before"))
    names = pieces.columns
    slim = ranked.select(*names, F.col("__rank").cast("long").alias("__rank"))
    schema = T.StructType(list(slim.schema.fields[:-1])
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches):
        keys, plan = sent.value
        at_length = names.index("length")
        for batch in batches:
            length = batch.column(at_length).to_numpy(zero_copy_only=False)
            rank = batch.column(len(names)).to_numpy(zero_copy_only=False)
            hit = plan[np.searchsorted(keys, length * (1 << 42) + rank, "right") - 1]
            inside = rank - hit[:, 1]
            arrays = [batch.column(i) for i in range(len(names))]
            arrays += [pa.array(hit[:, 2] + inside // hit[:, 3]), pa.array(hit[:, 4] + inside % hit[:, 3] * length)]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return slim.mapInArrow(place, schema)


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
                   capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, block_bytes: int = TOKEN_BLOCK_BYTES,
                   cache_words: int = CACHE_WORDS) -> DataFrame:
    """Tokenises once (the pieces are stored in the shared folder), then packs."""
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    pieces = stored(piece_table(df, id_col, text_col, tokenizer_path, capacity, end_id, with_ids, block_bytes, cache_words), "pieces")
    return pack(pieces, capacity).withColumnRenamed("id", id_col)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return pack_documents(documents(spark, sf_dir)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

"""Cost-balanced packing of tokenised documents (operator 12).

A piece of n tokens costs ``LINEAR * n + n * n``: a part linear in its tokens and a quadratic one for attention within the
piece. Sequences are opened first, exactly as many as the tokens need: full ones, and for the rest one sequence for each
binary digit of it, since a sequence whose length is a power of two needs no padding. Pieces then go, in descending
order of cost, to the lowest-cost sequence with room for them; when no sequence has room for a whole piece, it is cut to
fill the lowest-cost sequence with any room, and what is left of it goes on as a shorter piece. So there is no padding, costs
are level, and cuts fill sequences up.

At scale: the assignment only depends on lengths and ranks, so it is planned from the histogram of lengths (at most
``capacity`` entries, whatever the corpus size). Sequences of equal cost and room form one class, and runs of equal pieces
are assigned to runs of equal sequences at once, with the same outcome as one by one. The plan's size depends on the
lengths that occur, not on the corpus. A piece finds its sequence by (length, rank); ranks come from counts per written
part of the token table, so nothing is sorted and no length, however frequent, is numbered in one task.

The tokens are stored once in the shared folder, pieces of ``capacity`` at most, and read again to be cut and digested.

Defined results: null text is empty and packs as its end id alone; repeated rows are packed each; other columns may have
any name; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.common import blocks, documents, give_back, resolved, stored
from roomledger.llm.token_ids import TokenIds

CAPACITY, END_ID = 4096, 2
# Tokens at which attention costs as much as the linear part: six times a model width of 2048.
LINEAR = 6 * 2048
TOKEN_BLOCK_BYTES = 4 << 20
RANK_BITS = 42


def piece_cost(tokens: int) -> int:
    """Relative cost of a piece of ``tokens`` tokens."""
    return LINEAR * tokens + tokens * tokens


def token_table(df: DataFrame, id_col: str, text_col: str, tokenizer_path: str, capacity: int = CAPACITY,
                end_id: int = END_ID) -> DataFrame:
    """One row per piece of at most ``capacity`` tokens: id, doc_tokens, start, length, ids (little-endian 32 bits), and
    its number ``nth`` among the pieces of that length written by the same task, ``part``."""
    id_at, text_at = resolved(df, id_col), resolved(df, text_col)
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    slim = flat.select(F.col(f"c{id_at}").alias("id"), F.col(f"c{text_at}").cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", slim.schema["id"].dataType), T.StructField("doc_tokens", T.LongType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("part", T.LongType()), T.StructField("nth", T.LongType()),
                           T.StructField("ids", T.BinaryType())])
    tail, full = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def run(batches):
        encode, part = TokenIds(tokenizer_path), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            text = pc.fill_null(batch.column(1), "")
            for lo, hi in blocks(text, TOKEN_BLOCK_BYTES):
                row, total, start, length, nth, ids = [], [], [], [], [], []
                for i, data in enumerate(encode(text.slice(lo, hi - lo)), lo):
                    data += tail
                    for k in range(0, len(data), full):
                        piece = data[k:k + full]
                        n = len(piece) // 4
                        row.append(i)
                        total.append(len(data) // 4)
                        start.append(k // 4)
                        length.append(n)
                        nth.append(seen[n])
                        seen[n] += 1
                        ids.append(piece)
                longs = [pa.array(x, pa.int64()) for x in (total, start, length, [part] * len(row), nth)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *longs,
                                                  pa.array(ids, pa.binary())], schema.names)
        give_back()

    return slim.mapInArrow(run, schema)


def balanced_plan(histogram: dict[int, int], capacity: int = CAPACITY,
                  cost: Callable[[int], int] = piece_cost) -> list[tuple[int, ...]]:
    """Assignments (length, cut, first rank, count, start, taken, first sequence, offset): of the pieces of ``length``
    with ranks first rank to first rank + count - 1, the tokens from ``start`` on, ``taken`` of them, are their ``cut``-th part
    and go, one each, to consecutive sequences.

    Ties: the lowest cost first, then the most room; sequences of equal cost and room are interchangeable.
    """
    total = sum(length * n for length, n in histogram.items())
    full, rest = divmod(total, capacity)
    classes: dict[tuple[int, int], list[tuple[int, int, int]]] = {}  # (cost, room) -> [(first sequence, count, used)]
    ready: list[tuple[int, int]] = []  # (cost, -room) of classes with room for the current length
    short: list[tuple[int, int]] = []  # (-room, cost) of the others
    cheap: list[tuple[int, int]] = []  # (cost, -room) of the others
    groups: dict[int, list[tuple[int, int, int, int, int]]] = defaultdict(list)
    for length, n in histogram.items():
        groups[length].append((length, 0, 0, n, 0))  # length, cut, first rank, count, start
    queue = [-length for length in groups]
    heapq.heapify(queue)
    plan, now = [], capacity

    def put(paid: int, room: int, first: int, count: int, used: int) -> None:
        if not room or not count:
            return
        if (paid, room) not in classes:
            classes[paid, room] = []
            if room >= now:
                heapq.heappush(ready, (paid, -room))
            else:
                heapq.heappush(short, (-room, paid))
                heapq.heappush(cheap, (paid, -room))
        classes[paid, room].append((first, count, used))

    def lowest(heap: list[tuple[int, int]]) -> tuple[int, int] | None:
        while heap:
            key = heap[0][0], -heap[0][1]
            if key in classes:
                return key
            heapq.heappop(heap)
        return None

    put(0, capacity, 0, full, 0)
    for bit in range(rest.bit_length()):
        if rest >> bit & 1:
            put(0, 1 << bit, full, 1, 0)
            full += 1
    while queue:
        now = -heapq.heappop(queue)
        while short and -short[0][0] >= now:
            room, paid = heapq.heappop(short)
            if (paid, -room) in classes:
                heapq.heappush(ready, (paid, room))
        for length, cut, rank, count, start in groups.pop(now, ()):
            while count:
                key = lowest(ready) or lowest(cheap)
                paid, room = key
                first, n, used = classes[key].pop()
                if not classes[key]:
                    del classes[key]
                some, taken = min(n, count), min(room, now)
                plan.append((length, cut, rank, some, start, taken, first, used))
                put(paid, room, first + some, n - some, used)
                put(paid + cost(taken), room - taken, first, some, used + taken)
                if taken < now:
                    if now - taken not in groups:
                        heapq.heappush(queue, taken - now)
                    groups[now - taken].append((length, cut + 1, rank, some, start + taken))
                rank, count = rank + some, count - some
    return plan


def pack_balanced(tokens: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their places, from a stored token table (columns of :func:`token_table`)."""
    spark = tokens.sparkSession
    sizes = stored(tokens.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = np.array(balanced_plan(histogram, capacity), np.int64).reshape(-1, 8)
    plan = plan[np.lexsort((plan[:, 2], plan[:, 0], plan[:, 1]))]
    levels = [plan[plan[:, 1] == c] for c in range(int(plan[:, 1].max()) + 1)] if len(plan) else []
    sent = spark.sparkContext.broadcast([((p[:, 0] << RANK_BITS) + p[:, 2], p) for p in levels])
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranks = sizes.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    # the ranks grow with the corpus: always a shuffle join, the same plan at every size
    slim = tokens.join(ranks.hint("merge"), ["part", "length"]).select(
        "id", "doc_tokens", "start", "length", (F.col("before") + F.col("nth")).alias("rank"), "ids")
    schema = T.StructType([slim.schema["id"]] + [T.StructField(n, T.LongType()) for n in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])

    def place(batches):
        tables = sent.value
        for batch in batches:
            total, start, length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5))
            key = (length << RANK_BITS) + rank
            open_, rows, hits = np.arange(len(key)), [], []
            for keys, table in tables:
                if not len(open_):
                    break
                hit = np.searchsorted(keys, key[open_], "right") - 1
                found = table[np.maximum(hit, 0)]
                ok = (hit >= 0) & (found[:, 0] == length[open_]) & (rank[open_] < found[:, 2] + found[:, 3])
                open_ = open_[ok]
                rows.append(open_)
                hits.append(found[ok])
            if not rows:
                continue
            row, hit = np.concatenate(rows), np.concatenate(hits)
            ids = batch.column(5)
            crc = [zlib.crc32(memoryview(ids[int(i)].as_buffer())[4 * a:4 * b])
                   for i, a, b in zip(row, hit[:, 4], hit[:, 4] + hit[:, 5])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(start[row] + hit[:, 4]), pa.array(hit[:, 5]), pa.array(crc, pa.int64()),
                 pa.array(total[row]), pa.array(hit[:, 6] + rank[row] - hit[:, 2]), pa.array(hit[:, 7])], schema.names)

    return slim.mapInArrow(place, schema)


def pack_by_cost(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenises once (the tokens are stored in the shared folder), then packs."""
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    tokens = stored(token_table(df, id_col, text_col, tokenizer_path, capacity, end_id), "tokens")
    return pack_balanced(tokens, capacity).withColumnRenamed("id", id_col)


def op12_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return pack_by_cost(documents(spark, sf_dir))

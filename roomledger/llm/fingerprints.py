"""Document fingerprints by a quartile bucket digest (operator 5).

Byte triplets of the text (three bytes out of a sliding window of four, first byte always taken) are hashed
into 128 buckets. Each bucket is written as two bits: which quartile of the document's own bucket counts it
lies in. A header holds the logarithm of the length and the two quartile ratios. Two digests compare by a
bounded difference score: bucket differences (0 to 3, opposite quartiles count double), plus length and
ratio differences, all capped; likeness is one minus the share of the bound.

Defined results: null text is empty; an empty text has the digest of all-zero counts; equal texts have equal
digests; repeated ids are ordered by text; null ids come first in the id order; extra columns are ignored; a
table of one document has itself as its next one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.common import blocks, documents, flat_bytes, stored

BUCKETS = 128
DIGEST_BYTES = 4 + BUCKETS // 4
# Difference of two bucket codes; opposite quartiles count double. Header differences are capped.
CODE_DIFF = np.array([[0, 1, 2, 6], [1, 0, 1, 2], [2, 1, 0, 1], [6, 2, 1, 0]], np.int64)
HEADER_CAP = 12
# Scores at and beyond the bound mean no likeness: about what unrelated digests reach.
SCORE_BOUND = 160
# Characters of a text that order rows of one id between partitions of the range shuffle.
KEY_CHARS = 32


def bucket_counts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Triplet counts per text (rows) and bucket (columns)."""
    n = len(bounds) - 1
    total = np.zeros((n, BUCKETS), np.int64)
    if not len(raw):
        return total
    doc = np.repeat(np.arange(n), np.diff(bounds))
    left = bounds[1:][doc] - np.arange(len(raw))  # bytes from here to the text's end
    x = raw.astype(np.uint32)
    for a, b, salt in ((1, 2, 0x9E3779B1), (1, 3, 0x85EBCA77), (2, 3, 0xC2B2AE3D)):
        m = len(raw) - b
        if m <= 0:
            continue
        h = (x[:m] | (x[a:m + a] << np.uint32(8)) | (x[b:m + b] << np.uint32(16))) * np.uint32(salt)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        slot = doc[:m] * BUCKETS + (h >> np.uint32(25)).astype(np.int64)
        total += np.bincount(slot[left[:m] > b], minlength=n * BUCKETS).reshape(n, BUCKETS)
    return total


def digests(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of DIGEST_BYTES bytes per text: length code, two ratio codes, a check byte, bucket codes."""
    counts = bucket_counts(raw, bounds)
    ordered = np.sort(counts, axis=1)
    q1, q2, q3 = (ordered[:, BUCKETS * k // 4 - 1][:, None] for k in (1, 2, 3))
    code = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).astype(np.uint8)
    out = np.zeros((len(counts), DIGEST_BYTES), np.uint8)
    size = np.diff(bounds)
    out[:, 0] = np.minimum(255, np.floor(8 * np.log2(1 + size))).astype(np.uint8)
    top = np.maximum(q3[:, 0], 1)
    out[:, 1] = q1[:, 0] * 15 // top
    out[:, 2] = q2[:, 0] * 15 // top
    out[:, 3] = counts.sum(axis=1) % 251
    out[:, 4:] = code[:, 0::4] | code[:, 1::4] << 2 | code[:, 2::4] << 4 | code[:, 3::4] << 6
    return out


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Difference score of digests row by row, 0 to SCORE_BOUND."""
    head = np.abs(a[:, :3].astype(np.int64) - b[:, :3].astype(np.int64))
    score = np.minimum(head, HEADER_CAP).sum(axis=1) + (a[:, 3] != b[:, 3])
    for shift in (0, 2, 4, 6):
        score += CODE_DIFF[(a[:, 4:] >> shift) & 3, (b[:, 4:] >> shift) & 3].sum(axis=1)
    return np.minimum(score, SCORE_BOUND)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1.0 - difference(a, b) / SCORE_BOUND


def fingerprint_texts(texts: list[str]) -> np.ndarray:
    raw, bounds = flat_bytes(pa.array(texts, pa.string()))
    return digests(raw, bounds)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter (code points, rounded down) replaced by as many first ones of
    ``following``, or all of them."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def _row(texts: list[str], changed: list[str], own: np.ndarray, nxt: np.ndarray) -> list:
    new = fingerprint_texts(changed)
    return [pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            pa.array([bytes(r).hex() for r in own]), pa.array([bytes(r).hex() for r in new]),
            pa.array(likeness(own, new)), pa.array(likeness(own, nxt))]


NEW = [T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
       T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
       T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())]
NAMES = [f.name for f in NEW]


def _walk(batches):
    """Rows of one partition in id order: each is done with the text after it; the first and the last one's
    texts are handed out too, for the neighbouring partitions."""
    part = TaskContext.get().partitionId()
    held = None  # id, text, digest of the row whose next one is not yet seen
    kind = None
    opened = False

    def emit(ids, texts, following):
        own = fingerprint_texts(texts + following[-1:])
        body = _row(texts, [edited(t, f) for t, f in zip(texts, following, strict=True)], own[:-1], own[1:])
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * n, pa.int64()), pa.array(["row"] * n), ids, pa.nulls(n, pa.string()), *body],
            ["part", "kind", "id", "text", *NAMES])

    def edge(what, ids, text):
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([what]), ids, pa.array([text]), pa.nulls(1, pa.int64()),
             *[pa.nulls(1, pa.string())] * 3, *[pa.nulls(1, pa.float64())] * 2], ["part", "kind", "id", "text", *NAMES])

    for batch in batches:
        text = pc.fill_null(batch.column(1), "")
        kind = batch.column(0).type
        for lo, hi in blocks(text):
            ids, texts = batch.column(0).slice(lo, hi - lo), text.slice(lo, hi - lo).to_pylist()
            if not opened:
                yield edge("first", ids.slice(0, 1), texts[0])
                opened = True
            if held is not None:
                ids = pa.concat_arrays([held[0], ids])
                texts = [held[1], *texts]
            if len(texts) > 1:
                yield emit(ids.slice(0, len(texts) - 1), texts[:-1], texts[1:])
            held = (ids.slice(len(texts) - 1, 1), texts[-1])
    if held is not None:
        yield edge("last", held[0].cast(kind), held[1])


def _close(batches):
    """The last rows of the partitions, each beside the text that follows it."""
    for batch in batches:
        texts, following = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        body = _row(texts, [edited(t, f) for t, f in zip(texts, following, strict=True)],
                    fingerprint_texts(texts), fingerprint_texts(following))
        yield pa.RecordBatch.from_arrays([batch.column(0), *body], ["id", *NAMES])


def fingerprint_chain(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of each text and of its edited form, and their likeness, with the next text by id.

    One range shuffle by id. Within a partition the next text is the next row; the first and last texts of
    the partitions (two per partition) are stored and joined with each other.
    """
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Spark sends a sample of the range keys to the driver: of a text only a prefix, which sorts like the text.
    ordered = rows.repartitionByRange(parts, F.col("id"), F.substring("text", 1, KEY_CHARS)).sortWithinPartitions("id", "text")
    id_type = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("kind", T.StringType()),
                           T.StructField("id", id_type), T.StructField("text", T.StringType())] + NEW)
    done = stored(ordered.mapInArrow(_walk, schema), "fingerprints")
    edge = done.where("kind <> 'row'").select("part", "kind", "id", "text")
    firsts = edge.where("kind = 'first'")
    whole = Window.partitionBy()
    # one number per partition of the shuffle goes through the window, the texts are joined to it
    follow = firsts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(whole)).alias("next"))
    lasts = edge.where("kind = 'last'").join(follow, "part").select("next", "id", "text")
    firsts = firsts.select(F.col("part").alias("next"), F.col("text").alias("following"))
    close_schema = T.StructType([T.StructField("id", id_type), *NEW])
    closed = lasts.join(firsts, "next").select("id", "text", "following").mapInArrow(_close, close_schema)
    return (done.where("kind = 'row'").select("id", *NAMES).unionByName(closed)
            .select(F.col("id").alias(id_col), *NAMES))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests and likeness over all documents."""
    return fingerprint_chain(documents(spark, sf_dir))

"""Near-duplicates by fast similarity sketching (operator 8).

A document's set holds the hashes of its distinct shingles of ``shingle`` words (A-Z lower-cased; 3 in op8). Two sets are
linked from a similarity of ``percent`` on (85 in op8). The sketch has COORDINATES bins. In round r every element goes to a hashed bin with a hashed value, and a bin keeps the smallest (round,
value); after COORDINATES rounds the remaining rounds aim at one bin each, so every bin is filled for sure, and
the number of equal bins of two sketches is concentrated around the similarity like that of independent
minima. Bands of some bins are hashed; documents that share a band are candidates. :func:`banding` chooses their
numbers so that two sets at the limit share none with probability 3e-7 at most: 32 bands of 6 at 0.85, 38 of 5 at 0.80.

Equal sets form a class and are handled once. Links among candidates are confirmed on full sets. Not all
pairs of a bucket are formed:
  1. Shingles that no other candidate class holds cannot be shared. With u of them among n, the similarity to
     anything is at most (n - u) / n, and to a set of n' at most c / (n + n' - c), c the smaller of n - u and
     n' - u'. These bounds drop classes and pairs exactly.
  2. In each bucket every class is compared with two leaders: the one with the lowest share of own shingles
     and the one with the most shared shingles. Links are merged into components.
  3. Pairs of a bucket that are still in different components are all compared, unless the first bound or a
     sharper one rules them out: shared shingles are counted in CELLS hashed cells, and two sets share at most
     the sum of their smaller counts.
The components are those of all links. Components come from alternating large-star and small-star steps.

Defined results: null or empty text (or one without words) has the empty set and is linked with nothing; fewer words
than a shingle has are one shingle; repeated rows are equal and both counted as kept when they hold the smallest id; null ids never are a
component's smallest unless all are null; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.common import Words, documents, map_text, mix64, resolved, stored, word_hashes

SHINGLE, PERCENT = 3, 85
ROWS, BANDS = 6, 32
COORDINATES = ROWS * BANDS
CELLS = 64
MULTIPLIERS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def banding(percent: int) -> tuple[int, int]:
    """Rows and bands: the longest bands of which at most 200 bins miss a pair at the limit with probability 3e-7."""
    share = min(percent / 100, 0.99)
    options = [(rows, math.ceil(math.log(3e-7) / math.log1p(-share ** rows))) for rows in range(1, 25)]
    return max([x for x in options if x[0] * x[1] <= 200], default=options[0])


def multiplier(k: int) -> np.uint64:
    """Odd factor of a shingle's k-th word."""
    return MULTIPLIERS[k] if k < len(MULTIPLIERS) else mix64(np.array([k], np.uint64))[0] | np.uint64(1)


def shingle_sets(text: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and each text's bounds."""
    words = Words(text, lower=True)
    h = word_hashes(words.vocab)[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    doc = words.doc()
    n = words.counts
    rest = words.starts[1:][doc] - np.arange(len(h))  # words from here to the end
    first = np.arange(len(h)) == words.starts[:-1][doc]
    start = (rest >= shingle) | (first & (n[doc] < shingle))
    total = h * multiplier(0)
    for k in range(1, shingle):
        there = rest > k
        shifted = np.zeros_like(h)
        shifted[:max(0, len(h) - k)] = h[k:]
        total = total + np.where(there, shifted * multiplier(k), np.uint64(k))
    total, doc = mix64(total[start]), doc[start]
    order = np.lexsort((total, doc))
    total, doc = total[order], doc[order]
    new = np.concatenate([[True], (total[1:] != total[:-1]) | (doc[1:] != doc[:-1])]) if len(total) else np.zeros(0, bool)
    total, doc = total[new], doc[new]
    return total, np.searchsorted(doc, np.arange(words.n_docs + 1))


def sketches(elements: np.ndarray, bounds: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Sketch of each non-empty set (rows of ``coordinates`` values; empty sets keep EMPTY)."""
    sizes = np.diff(bounds)
    out = np.full((len(sizes), coordinates), EMPTY, np.uint64)
    flat = out.reshape(-1)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    x = elements
    for r in range(2 * coordinates):
        if not len(x):
            break
        h = mix64(x + np.uint64((r + 1) * int(MULTIPLIERS[0]) & 0xFFFFFFFFFFFFFFFF))
        if r < coordinates:
            place = ((h >> np.uint64(32)) * np.uint64(coordinates) >> np.uint64(32)).astype(np.int64)
        else:
            place = r - coordinates
        value = np.uint64(r << 40) | ((h * MULTIPLIERS[1]) >> np.uint64(24))
        np.minimum.at(flat, doc * coordinates + place, value)
        open_ = (out == EMPTY).any(axis=1)
        keep = open_[doc]
        x, doc = x[keep], doc[keep]
    return out


def band_hashes(sketch: np.ndarray, rows: int = ROWS, bands: int = BANDS) -> np.ndarray:
    out = np.zeros((len(sketch), bands), np.uint64)
    for b in range(bands):
        acc = np.full(len(sketch), b + 1, np.uint64)
        for j in range(rows):
            acc = mix64(acc * MULTIPLIERS[2] + sketch[:, b * rows + j])
        out[:, b] = acc
    return out


def set_keys(elements: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """128-bit digest of each set; None for the empty one."""
    sizes = np.diff(bounds)
    full = sizes > 0
    sums = []
    for salt in (MULTIPLIERS[1], MULTIPLIERS[2]):
        total = np.zeros(len(sizes), np.uint64)
        if len(elements):
            total[full] = np.add.reduceat(mix64(elements ^ salt), bounds[:-1][full])
        sums.append(mix64(total + sizes.astype(np.uint64)))
    both = np.stack(sums, axis=1).astype("<u8")
    return [both[i].tobytes() if full[i] else None for i in range(len(sizes))]


def _sketch_rows(text: pa.Array, shingle: int, rows: int, bands: int) -> list:
    elements, bounds = shingle_sets(text, shingle)
    n = np.diff(bounds)
    full = n > 0
    hashes = band_hashes(sketches(elements, bounds, rows * bands), rows, bands).astype(np.int64)[full]
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(full * bands)]), pa.int32()), pa.array(hashes.reshape(-1)))
    return [pa.array(n.astype(np.int64)), pa.array(set_keys(elements, bounds), pa.binary()), lists]


def _set_rows(text: pa.Array, shingle: int) -> list:
    elements, bounds = shingle_sets(text, shingle)
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(elements.astype(np.int64)))
    return [pa.array(set_keys(elements, bounds), pa.binary()), lists]


# ---- components ----------------------------------------------------------------------------------------------


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """Columns k, root for all nodes of ``edges`` (columns a, b); root is the smallest node of the component."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(most):
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        now = stored(small.where("u <> v").distinct(), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    return now.select(F.col("u").alias("k"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("k"), F.col("v").alias("root")).distinct())


# ---- links ---------------------------------------------------------------------------------------------------


def possible(n1: str, c1: str, n2: str, c2: str, percent: int):
    """The similarity bound of two sets reaches the limit."""
    c = F.least(F.col(c1), F.col(c2))
    return c * 100 >= (F.col(n1) + F.col(n2) - c) * percent


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets' similarity reaches the limit."""
    left, right = (sets.select(F.col("k").alias(x), F.col("s").alias(f"s{x}")) for x in ("a", "b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return both.where(common * 100 >= union * percent).select("a", "b")


def shared_cells(sets: DataFrame) -> DataFrame:
    """Columns k, n, c (shingles that another candidate class holds too) and cells: these shingles counted in CELLS
    hashed cells. The sum of two classes' smaller counts bounds what they share."""
    schema = T.StructType([sets.schema["k"], T.StructField("n", T.LongType()), T.StructField("c", T.LongType()),
                           T.StructField("cells", T.ArrayType(T.IntegerType()))])

    def counted(column: pa.Array) -> np.ndarray:
        size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        cell = column.flatten().to_numpy(zero_copy_only=False).astype(np.uint64) % np.uint64(CELLS)
        slot = np.repeat(np.arange(len(size)), size) * CELLS + cell.astype(np.int64)
        return np.bincount(slot, minlength=len(size) * CELLS).reshape(len(size), CELLS)

    def run(batches):
        for batch in batches:
            total = counted(batch.column(1))
            cells = total - counted(batch.column(2))
            bounds = pa.array(np.arange(len(cells) + 1) * CELLS, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total.sum(axis=1)), pa.array(cells.sum(axis=1)),
                 pa.ListArray.from_arrays(bounds, pa.array(cells.reshape(-1), pa.int32()))], schema.names)

    return sets.mapInArrow(run, schema)


def class_links(classes: DataFrame, texts, percent: int) -> DataFrame:
    """Columns k, root of the classes that are linked to others. ``classes`` (stored): k, rep, n, bands;
    ``texts(ks)``: the sets (k, s) of some classes."""
    bands = classes.select("k", "n", F.explode("bands").alias("bucket"))
    crowded = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket")
    members = stored(bands.join(crowded, "bucket"), "buckets")
    sets = stored(texts(members.select("k").distinct()), "sets")
    alone = (sets.select("k", F.explode("s").alias("s")).groupBy("s").agg(F.count("*").alias("df"), F.first("k").alias("k"))
             .where("df = 1").groupBy("k").agg(F.collect_list("s").alias("own")))
    alive = stored(shared_cells(sets.join(alone, "k", "left").select("k", "s", "own")).where(
        F.col("c") * 100 >= F.col("n") * percent).drop("n"), "alive")
    members = stored(members.join(alive.select("k", "c"), "k"), "buckets")

    who = F.struct("k", "n", "c")
    leaders = members.groupBy("bucket").agg(
        F.max_by(who, F.struct(F.col("c") / F.col("n"), F.col("k"))).alias("one"),
        F.max_by(who, F.struct(F.col("c"), F.col("k"))).alias("two"), F.count("*").alias("size")).where("size > 1")
    leaders = leaders.select("bucket", F.explode(F.array_distinct(F.array("one", "two"))).alias("lead"))
    star = members.join(leaders, "bucket").select(
        "k", "n", "c", F.col("lead.k").alias("k2"), F.col("lead.n").alias("n2"), F.col("lead.c").alias("c2"))
    star = star.where((F.col("k") != F.col("k2")) & possible("n", "c", "n2", "c2", percent))
    pairs = star.select(F.least("k", "k2").alias("a"), F.greatest("k", "k2").alias("b")).distinct()
    links = stored(confirmed(pairs, sets, percent), "links")
    roots = components(links)

    labelled = stored(members.join(roots, "k", "left").select(
        "bucket", "k", "n", "c", F.coalesce("root", "k").alias("root")), "buckets")
    mixed = labelled.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket")
    open_ = labelled.join(mixed, "bucket").join(alive.select("k", "cells"), "k")
    other = open_.select("bucket", *[F.col(x).alias(x + "2") for x in ("k", "n", "c", "root", "cells")])
    at_most = F.aggregate(F.zip_with("cells", "cells2", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)
    rest = open_.join(other, "bucket").where(
        (F.col("root") < F.col("root2")) & possible("n", "c", "n2", "c2", percent)
        & (at_most * (100 + percent) >= (F.col("n") + F.col("n2")) * percent))
    more = stored(confirmed(rest.select(F.least("k", "k2").alias("a"), F.greatest("k", "k2").alias("b")).distinct(), sets, percent), "links")
    if more.isEmpty():
        return roots
    return components(links.unionByName(more))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """Columns id, n_shingles, component_id (smallest id reachable), kept, text_hash (xxhash64 of the text), component
    (one value per component, whatever its ids; null for the empty set)."""
    band_rows, bands = banding(percent)
    id_at, text_at = resolved(df, id_col), resolved(df, text_col)
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))]).select(
        F.col(f"c{id_at}").alias("id"), F.col(f"c{text_at}").cast("string").alias("text"))
    rows = stored(map_text(flat.withColumn("text_hash", F.xxhash64("text")), "text", ["id", "text_hash"],
                           [("n_shingles", T.LongType()), ("k", T.BinaryType()), ("bands", T.ArrayType(T.LongType()))],
                           lambda: lambda text: _sketch_rows(text, shingle, band_rows, bands)), "sketches")
    classes = stored(rows.where("n_shingles > 0").groupBy("k").agg(
        F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")

    def texts(ks: DataFrame) -> DataFrame:
        reps = classes.join(ks, "k", "left_semi").select(F.col("rep"))
        chosen = flat.join(reps.distinct(), F.col("id").eqNullSafe(F.col("rep")), "left_semi")
        sets = map_text(chosen, "text", ["id"], [("k", T.BinaryType()), ("s", T.ArrayType(T.LongType()))],
                        lambda: lambda text: _set_rows(text, shingle))
        return sets.join(ks, "k", "left_semi").select("k", "s").dropDuplicates(["k"])

    roots = class_links(classes, texts, percent)
    named = classes.join(roots, "k", "left").select("k", "rep", F.coalesce("root", "k").alias("root"))
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "root").select("k", "component_id", "root")
    out = rows.join(named, "k", "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("k").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"), "text_hash",
        F.col("root").alias("component"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents."""
    return near_duplicates(documents(spark, sf_dir), shingle=SHINGLE, percent=PERCENT).select("doc_id", "n_shingles", "component_id", "kept")

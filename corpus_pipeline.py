"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next stage's documents. All but the last return the columns of documents. Stages accept nulls, repeated rows, empty
tables and further columns; texts that a stage changes get a new ``n_chars``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.llm.common import documents, stored
from roomledger.llm.line_dedup import count_words, dedup_lines
from roomledger.llm.near_duplicates import near_duplicates
from roomledger.llm.packing import pack_documents
from roomledger.llm.personal_data import find_personal_data
from roomledger.llm.quality_classifier import THRESHOLD, quality_scores, training_labels

# The near-duplicate stage links word shingles as training-data pipelines do; op8 has a contract of its own (3 words, 85 %).
NEAR_SHINGLE, NEAR_PERCENT = 5, 80
# Packing comes last in executors that the stages before have filled, so its workers take less text and keep fewer words.
PACKING_BLOCK_BYTES, PACKING_CACHE_WORDS = 1 << 20, 100_000


def by_position(stage: Callable) -> Callable:
    """The stage on columns named by position, except the first ``doc_id``, ``text`` and ``n_chars``: further columns may
    have any name, also one that a stage uses itself, holds a dot or differs in case only."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        plain = [n if n in ("doc_id", "text", "n_chars") and names.index(n) == i else f"column_{i}" for i, n in enumerate(names)]
        return stage(spark, docs.toDF(*plain), sf_dir).toDF(*names)

    return run


def resized(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` with n_chars (if there) set to the text's length."""
    if "n_chars" in docs.columns:
        docs = docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return docs.select(*names)


@by_position
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject."""
    labels = training_labels(documents(spark, sf_dir, "labels"))
    scored = quality_scores(docs, labels, None, score="__quality")
    return scored.where(F.col("__quality") >= THRESHOLD).drop("__quality")


@by_position
def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; a document that loses all its words that way goes."""
    deduped = dedup_lines(docs)
    left = deduped.where((F.col("n_deleted") == 0) | (count_words(F.col("text")) > 0))
    changed = left.withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars"))
                              .cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left
    return changed.select(*docs.columns)


@by_position
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (a similarity of NEAR_PERCENT of shingles of NEAR_SHINGLE words): the one
    with the smallest id (null ids last), then the smallest text hash. Rows of equal id and text are one document, also
    when it has no words; if their further columns differ, the smallest hash of these stays."""
    near = near_duplicates(docs, shingle=NEAR_SHINGLE, percent=NEAR_PERCENT)
    keyed = stored(near.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "component").agg(
        F.count("*").alias("__n")), "near-keys")
    best = keyed.where(F.col("component").isNotNull()).groupBy("component").agg(
        F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__hash")).alias("best"))
    best = best.select(F.col("best.__id").alias("id"), F.col("best.__hash").alias("hash"), F.lit(True).alias("best"))
    stays = F.col("component").isNull() | F.col("best").isNotNull()
    marked = stored(keyed.join(best, F.col("__id").eqNullSafe(F.col("id")) & (F.col("__hash") == F.col("hash")), "left").select(
        "__id", "__hash", stays.alias("__stays"), "__n").where(~F.col("__stays") | (F.col("__n") > 1)), "near-marked")
    text_hash = F.xxhash64(F.col("text").cast("string"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (text_hash == F.col("__hash"))
    single = docs.join(marked, same, "left_anti")
    repeated = marked.where("__stays")
    if repeated.isEmpty():
        return single
    further = F.to_json(F.struct(F.lit(0).alias("__0"), *[c for c in docs.columns if c not in ("doc_id", "text")]))
    folded = docs.join(repeated, same, "left_semi").groupBy("doc_id", text_hash.alias("__hash")).agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(further)).alias("__row")).select("__row.*")
    return single.unionByName(folded)


@by_position
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    masked = find_personal_data(docs, None, redacted="__masked")
    return resized(masked.withColumn("text", F.col("__masked")), docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 4096 tokens."""
    packed = pack_documents(docs, block_bytes=PACKING_BLOCK_BYTES, cache_words=PACKING_CACHE_WORDS)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality", good_quality), ("lines", unrepeated_lines), ("near_duplicates", one_of_each_group),
          ("personal_data", without_personal_data), ("packing", packed_sequences)]

# The classifier and the field are trained; SQL cannot express them. tests/llm runs stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

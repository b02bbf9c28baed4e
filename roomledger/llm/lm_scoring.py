"""Language-model scores by a hidden Markov model (operator 4).

Tokens are words (A-Z lower-cased) and one end per document. Words fall into BUCKETS hashed classes (the end
has its own); hidden states emit classes, and a class gives a word by its smoothed share of the class's
training count, so the vocabulary is open and nothing that grows with it leaves the shuffles:

    P(text) = P_hmm(classes) * product of (c(w) + 0.5) / (N_class + 0.5 (V_class + 1))

Every document's chain is exact. It is cut into segments of SEGMENT tokens; a segment's transfer matrix
(product of transition times emission) is computed for all segments side by side, and the scaled forward
recursion runs over a document's matrices. Baum-Welch starts from a bounded sample (INIT_DOCS documents) and then
makes ROUNDS passes over all training documents: tasks emit expected counts, Spark adds them up, and the
driver normalises one table of fixed size.

Counts per word come from all training documents. Documents are stored once as chunks with a local
vocabulary; vocabularies (not tokens) are shuffled by word for the counts and back to their chunks.

Defined results: null text is empty (its end is its only token); repeated rows are scored each; null ids count as
training rows; with no training rows all tokens are unknown; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.common import Words, blocks, bounded_sample, crc_fold, doc_sums, documents, stored

STATES, BUCKETS, SEGMENT = 6, 4096, 64
ROUNDS, INIT_ROUNDS, INIT_DOCS, INIT_CHARS = 2, 15, 500, 20_000
CHUNK_BYTES = 8 << 20


# ---- the model: start (K), transitions (K, K), emissions (BUCKETS + 1, K) ------------------------------------


def random_model(seed: int, freq: np.ndarray) -> dict[str, np.ndarray]:
    """Class frequencies, disturbed state by state."""
    rng = np.random.default_rng(seed)
    emit = (freq + 1.0)[:, None] * rng.uniform(0.2, 1.8, (len(freq), STATES))
    return {"start": np.full(STATES, 1 / STATES), "move": np.full((STATES, STATES), 0.05 / STATES) + 0.95 * np.eye(STATES),
            "emit": emit / emit.sum(axis=0)}


def segments(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of documents (all at least one long) as a padded table of segments, longest first. Returns the
    table, segment lengths, and for documents (longest first) their order and segment row numbers' start in
    ``row`` (row[d, j] is written as first[d] + j before sorting)."""
    per = -(-lengths // SEGMENT)
    first = np.concatenate([[0], np.cumsum(per)])
    total = int(first[-1])
    doc = np.repeat(np.arange(len(lengths)), per)
    size = np.minimum(lengths[doc] - (np.arange(total) - first[:-1][doc]) * SEGMENT, SEGMENT)
    table = np.zeros((total, SEGMENT), np.int32)
    table[np.arange(SEGMENT)[None, :] < size[:, None]] = symbols
    order = np.argsort(-size, kind="stable")
    place = np.empty(total, np.int64)
    place[order] = np.arange(total)
    return table[order], size[order], place, first


def transfers(model: dict, table: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled transfer matrix of each segment and the logarithm of its scale."""
    n = len(table)
    mat = np.broadcast_to(np.eye(STATES), (n, STATES, STATES)).copy()
    log = np.zeros(n)
    for t in range(int(size[0]) if n else 0):
        m = int(np.searchsorted(-size, -t, "left"))  # segments longer than t
        step = mat[:m].reshape(-1, STATES) @ model["move"]
        step = step.reshape(m, STATES, STATES) * model["emit"][table[:m, t]][:, None, :]
        scale = step.max(axis=(1, 2))
        mat[:m] = step / scale[:, None, None]
        log[:m] += np.log(scale)
    return mat, log


def chains(model: dict, mat: np.ndarray, log: np.ndarray, place: np.ndarray, first: np.ndarray,
           backward: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log likelihood per document; state distribution in front of each segment; backward weights behind it."""
    per = np.diff(first)
    alpha = np.empty((len(mat), STATES))
    beta = np.ones((len(mat), STATES))
    order = np.argsort(-per, kind="stable")
    state = np.broadcast_to(model["start"], (len(per), STATES)).copy()
    total = np.zeros(len(per))
    steps = int(per.max()) if len(per) else 0
    for j in range(steps):
        live = order[:int(np.searchsorted(-per[order], -j, "left"))]
        seg = place[first[live] + j]
        alpha[seg] = state[live]
        nxt = np.einsum("nk,nkl->nl", state[live], mat[seg])
        scale = nxt.sum(axis=1)
        state[live] = nxt / scale[:, None]
        total[live] += np.log(scale) + log[seg]
    if backward:
        back = np.ones((len(per), STATES))
        for j in range(steps - 1, -1, -1):
            live = order[:int(np.searchsorted(-per[order], -j, "left"))]
            seg = place[first[live] + j]
            beta[seg] = back[live]
            nxt = np.einsum("nkl,nl->nk", mat[seg], back[live])
            back[live] = nxt / nxt.sum(axis=1)[:, None]
    return total, alpha, beta


def log_likelihood(model: dict, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Exact natural-log likelihood of each document's class sequence."""
    if not len(lengths):
        return np.zeros(0)
    table, size, place, first = segments(symbols, lengths)
    mat, log = transfers(model, table, size)
    return chains(model, mat, log, place, first, False)[0]


def expected_counts(model: dict, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Baum-Welch counts of documents: start, moves, emissions and log likelihood in one vector."""
    width = len(model["emit"])
    if not len(lengths):
        return np.zeros(STATES + STATES * STATES + width * STATES + 1)
    table, size, place, first = segments(symbols, lengths)
    mat, log = transfers(model, table, size)
    total, alpha, beta = chains(model, mat, log, place, first, True)
    move, emit = model["move"], model["emit"]
    longest = int(size[0])
    ahead = np.empty((longest + 1, len(table), STATES))
    ahead[0] = alpha
    live = [int(np.searchsorted(-size, -t, "left")) for t in range(longest)]
    for t in range(longest):
        m = live[t]
        now = (ahead[t, :m] @ move) * emit[table[:m, t]]
        ahead[t + 1, :m] = now / now.sum(axis=1)[:, None]
    moves = np.zeros((STATES, STATES))
    share, seen = [], []
    for t in range(longest - 1, -1, -1):
        m = live[t]
        out = emit[table[:m, t]] * beta[:m]
        before = ahead[t, :m] @ move
        z = (before * out).sum(axis=1)[:, None]
        moves += ahead[t, :m].T @ (out / z)
        share.append(before * out / z)
        seen.append(table[:m, t])
        back = out @ move.T
        beta[:m] = back / back.sum(axis=1)[:, None]
    head = place[first[:-1]]  # beta now stands in front of each segment
    begin = alpha[head] * beta[head]
    begin /= begin.sum(axis=1)[:, None]
    seen, share = np.concatenate(seen), np.concatenate(share)
    emits = np.stack([np.bincount(seen, share[:, k], minlength=width) for k in range(STATES)], axis=1)
    return np.concatenate([begin.sum(axis=0), (moves * move).ravel(), emits.ravel(), [total.sum()]])


def maximise(counts: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """Model of the counts; every class keeps a little of the overall frequency in every state."""
    k = STATES
    start, move = counts[:k] + 0.1, counts[k:k + k * k].reshape(k, k) + 0.1
    emit = counts[k + k * k:k + k * k + width * k].reshape(width, k)
    overall = (emit.sum(axis=1) + 0.5) / (emit.sum() + 0.5 * width)
    emit = emit + 5.0 * overall[:, None] + 1e-6
    return {"start": start / start.sum(), "move": move / move.sum(axis=1)[:, None], "emit": emit / emit.sum(axis=0)}


# ---- Spark jobs ----------------------------------------------------------------------------------------------


def word_classes(vocab: pa.Array) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) % BUCKETS for w in vocab.cast(pa.binary()).to_pylist()), np.int32, len(vocab))


def chunk_table(df: DataFrame, id_col: str, text_col: str, held: Column) -> DataFrame:
    """Documents as stored chunks: tokens index a vocabulary of the chunk."""
    slim = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), held.alias("held"))
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(slim.schema["id"].dataType)),
        T.StructField("held", T.ArrayType(T.BooleanType())), T.StructField("lens", T.BinaryType()),
        T.StructField("tokens", T.BinaryType()), T.StructField("classes", T.BinaryType()),
        T.StructField("words", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])

    def run(batches):
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi in blocks(batch.column(1), CHUNK_BYTES):
                words = Words(batch.column(1).slice(lo, hi - lo), lower=True)
                held = batch.column(2).slice(lo, hi - lo)
                train = ~held.to_numpy(zero_copy_only=False)
                n = len(words.vocab)
                counts = np.bincount(words.codes[train[words.doc()]], minlength=n)
                one = lambda a, kind: pa.array([a], kind)
                yield pa.RecordBatch.from_arrays(
                    [one(chunk, pa.int64()), pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), batch.column(0).slice(lo, hi - lo)),
                     pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), held),
                     one(words.counts.astype("<i4").tobytes(), pa.binary()), one(zlib.compress(words.codes.astype("<i4").tobytes(), 1), pa.binary()),
                     one(word_classes(words.vocab).astype("<u2").tobytes(), pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), words.vocab),
                     pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.array(counts, pa.int32()))], schema.names)
                chunk += 1

    return stored(slim.mapInArrow(run, schema), "lm-chunks")


def unpacked(lens: pa.Scalar, tokens: pa.Scalar, classes: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arrays of a chunk's packed columns."""
    return (np.frombuffer(lens.as_buffer(), "<i4"), np.frombuffer(zlib.decompress(tokens.as_buffer()), "<i4"),
            np.frombuffer(classes.as_buffer(), "<u2").astype(np.int32))


def symbols_of(lens: np.ndarray, tokens: np.ndarray, classes: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class sequences, each closed by the end class, of the picked documents."""
    doc = np.repeat(np.arange(len(lens)), lens)
    out = np.full(len(tokens) + len(lens), BUCKETS, np.int32)
    out[np.arange(len(tokens)) + doc] = classes[tokens]
    keep = np.repeat(pick, lens + 1)
    return out[keep], (lens + 1)[pick].astype(np.int64)


def train(chunks: DataFrame, sample: list[str], seed: int = 11) -> tuple[dict[str, np.ndarray], list[float]]:
    """Baum-Welch; returns the model and the training log likelihood before each full pass."""
    spark, width = chunks.sparkSession, BUCKETS + 1
    words = Words(pa.array(sample, pa.string()), lower=True)
    symbols, lengths = symbols_of(words.counts, words.codes, word_classes(words.vocab), np.ones(len(sample), bool))
    model = random_model(seed, np.bincount(symbols, minlength=width))
    for _ in range(INIT_ROUNDS if len(sample) else 0):
        model = maximise(expected_counts(model, symbols, lengths), width)
    history = []
    schema = T.StructType([T.StructField("v", T.ArrayType(T.DoubleType()))])
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast(model)

        def run(batches, sent=sent):
            total = np.zeros(STATES + STATES * STATES + width * STATES + 1)
            for batch in batches:
                for i in range(batch.num_rows):
                    lens, tokens, classes = unpacked(*(batch.column(j)[i] for j in range(3)))
                    pick = ~batch.column(3)[i].values.to_numpy(zero_copy_only=False)
                    total += expected_counts(sent.value, *symbols_of(lens, tokens, classes, pick))
            yield pa.RecordBatch.from_arrays([pa.array([total])], ["v"])

        parts = chunks.select("lens", "tokens", "classes", "held").mapInArrow(run, schema)
        summed = parts.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
        counts = np.zeros(STATES + STATES * STATES + width * STATES + 1)
        for r in summed:
            counts[r.i] = r.x
        history.append(float(counts[-1]))
        if counts[:STATES].sum() > 0:
            model = maximise(counts, width)
    return model, history


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", held: Column | None = None) -> DataFrame:
    """Columns id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = df.sparkSession
    held = crc_fold(F.col(id_col), 5) == 1 if held is None else held
    chunks = chunk_table(df, id_col, text_col, held)
    sample = [r[0] for r in bounded_sample(df.where(~held).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                                           "id", "text", INIT_DOCS, INIT_CHARS).orderBy("id", "text").select("text").collect()]
    model, _ = train(chunks, sample)
    vocab = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select(
        "chunk", "at", F.col("w.words").alias("word"), F.col("w.counts").cast("long").alias("n"))
    counted = stored(vocab.groupBy("word").agg(F.sum("n").alias("c")).where("c > 0"), "lm-counts")
    by_class = [(r.k, r.n, r.v) for r in counted.groupBy((F.crc32(F.col("word").cast("binary")) % BUCKETS).alias("k"))
                .agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()]
    class_n, class_v = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for k, n, v in by_class:
        class_n[k], class_v[k] = n, v
    end_count = int(chunks.select(F.size(F.filter("held", lambda h: ~h)).alias("n")).agg(F.sum("n")).first()[0] or 0)
    total = int(class_n.sum()) + end_count
    distinct = int(class_v.sum()) + (end_count > 0)
    shared = spark.sparkContext.broadcast((model, class_n, class_v))
    back = (vocab.select("chunk", "at", "word").join(counted, "word").groupBy("chunk")
            .agg(F.collect_list(F.struct(F.col("at").cast("int").alias("at"), "c")).alias("known")))
    joined = chunks.select("chunk", "ids", "held", "lens", "tokens", "classes").join(back, "chunk", "left")
    id_type = chunks.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("held_out", T.BooleanType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                           T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches):
        model, class_n, class_v = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                lens, tokens, classes = unpacked(*(batch.column(j)[i] for j in range(2, 5)))
                count = np.zeros(len(classes))
                if batch.column(5)[i].is_valid:
                    known = batch.column(5)[i].values
                    count[known.field(0).to_numpy()] = known.field(1).to_numpy()
                starts = np.concatenate([[0], np.cumsum(lens)])
                base = np.log10((count + 0.5) / (total + 0.5 * (distinct + 1)))
                within = np.log10((count + 0.5) / (class_n[classes] + 0.5 * (class_v[classes] + 1)))
                end = np.log10((end_count + 0.5) / (total + 0.5 * (distinct + 1)))
                chain = log_likelihood(model, *symbols_of(lens, tokens, classes, np.ones(len(lens), bool)))
                n = len(lens)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i].values, batch.column(1)[i].values, pa.array(lens.astype(np.int64) + 1),
                     pa.array(doc_sums((count > 0)[tokens], starts).astype(np.int64) + (end_count > 0)),
                     pa.array(np.full(n, total, np.int64)), pa.array(doc_sums(base[tokens], starts) + end),
                     pa.array(doc_sums(within[tokens], starts) + chain / np.log(10))], schema.names)

    scored = joined.select("ids", "held", "lens", "tokens", "classes", "known").mapInArrow(run, schema)
    return scored.withColumnRenamed("id", id_col)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; the fold crc32(doc_id) mod 5 = 1 is held out."""
    return score_documents(documents(spark, sf_dir))

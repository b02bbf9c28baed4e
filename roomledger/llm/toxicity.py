"""Toxicity by a bidirectional gated recurrent network with attention pooling (operator 10).

Each word enters as a learnt embedding of its hash (words of MIN_DOCS sample documents or more; the rest share
one), the mean embedding of its hashed character runs (runs and word beginnings), and the strongest log odds
of any of these runs in the sample, so that unseen forms of a known stem are read. Two gated recurrent layers read a window of WINDOW words forwards and backwards; attention pools their states into
the window's logit. Windows start every STRIDE words, so they overlap, and all windows of a text are
scored; the document takes the highest one. Training (plain numpy, Adam) knows document labels only: each
document is represented by its highest windows, found anew every few rounds.

Fitting runs on a bounded sample of labelled rows (SAMPLE_DOCS per class of at most SAMPLE_CHARS characters).
The first coordinate of a word's embedding starts at the log odds of its documents' labels in that sample.

Defined results: null or empty text is a window without words and gets the network's bias score; without rows
of both labels every score is the share of label 1 (0 without any); repeated rows score alike; of repeated labels the
lowest counts; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.common import Words, crc_fold, documents, labelled_sample, map_text

WINDOW, STRIDE = 32, 16
WORD_BINS, WORD_DIM, CHAR_BINS, CHAR_DIM, HIDDEN, ATTENTION = 1 << 15, 8, 1 << 15, 6, 12, 8
BEGINNINGS = (4, 5, 6, 7, 8, 9)  # bytes of a word's beginning, its start mark included
MIN_DOCS, SHRINK = 4, 8.0
SAMPLE_DOCS, SAMPLE_CHARS = 900, 6_000
ROUNDS, EPOCHS, MIN_STEPS, TOP, BATCH, RATE = 2, 5, 80, 4, 128, 0.01
THRESHOLD = 0.7
EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def word_inputs(vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bin per vocabulary entry (signs at the edges taken off), and character run bins with their owners."""
    cores = [b"^" + w.strip(EDGES) + b"$" for w in vocab.cast(pa.binary()).to_pylist()]
    n = len(cores)
    bins = np.fromiter((zlib.crc32(w) % (WORD_BINS - 1) + 1 for w in cores), np.int64, n)
    size = np.fromiter(map(len, cores), np.int64, n)
    x = np.frombuffer(b"".join(cores), np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(n), size)
    inner = owner[:-2] == owner[2:]
    triple = (x[:-2] * 66_049 + x[1:-1] * 257 + x[2:]) * 0x9E3779B1 >> 11
    runs, whose = [(triple % CHAR_BINS)[inner]], [owner[:-2][inner]]
    for k in BEGINNINGS:
        long = np.flatnonzero(size > k)
        runs.append(np.fromiter((zlib.crc32(cores[i][:k], k) % CHAR_BINS for i in long.tolist()), np.int64, len(long)))
        whose.append(long)
    runs, whose = np.concatenate(runs), np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    return bins, runs[order], whose[order]


def windows(counts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and document of all windows (one of length 0 for a text without words)."""
    per = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    doc = np.repeat(np.arange(len(counts)), per)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    return starts[:-1][doc] + k * STRIDE, np.minimum(WINDOW, counts[doc] - k * STRIDE), doc


def init(rng: np.random.Generator) -> dict[str, np.ndarray]:
    dim = WORD_DIM + CHAR_DIM + 1
    m = {"word": rng.normal(0, 0.1, (WORD_BINS, WORD_DIM)), "char": rng.normal(0, 0.3, (CHAR_BINS, CHAR_DIM)),
         "att": rng.normal(0, (2 * HIDDEN) ** -0.5, (2 * HIDDEN, ATTENTION)), "pick": rng.normal(0, ATTENTION ** -0.5, ATTENTION),
         "out": rng.normal(0, (2 * HIDDEN) ** -0.5, 2 * HIDDEN), "bias": np.zeros(1)}
    for side in "fb":
        m["x" + side] = rng.normal(0, dim ** -0.5, (dim, 3 * HIDDEN))
        m["h" + side] = rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 3 * HIDDEN))
        m["o" + side] = np.zeros(3 * HIDDEN)
    return {k: v.astype(np.float32) for k, v in m.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def embed(m: dict, bins: np.ndarray, runs: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Input vector per vocabulary entry: word embedding, mean run embedding, strongest run odds."""
    n = len(bins)
    times = np.maximum(np.bincount(owner, minlength=n), 1)
    chars = np.stack([np.bincount(owner, m["char"][runs, k], minlength=n) for k in range(CHAR_DIM)], axis=1)
    odds = np.zeros(n)
    if len(owner):
        begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        odds[owner[begins]] = np.maximum.reduceat(m["odds"][runs], begins)
    word = m["word"][np.where(m["known"][bins], bins, 0)]
    return np.concatenate([word, chars / times[:, None], odds[:, None]], axis=1).astype(np.float32)


def run_side(m: dict, side: str, gates: np.ndarray, at: np.ndarray, live: list[int], trace: list | None = None) -> np.ndarray:
    """States of one direction. ``gates``: input part per vocabulary entry; ``at[t]``: entry read at step t by
    the windows in use (sorted by falling length, ``live[t]`` of them)."""
    n = live[0] if live else 0
    h = np.zeros((n, HIDDEN), np.float32)
    states = np.zeros((len(live), n, HIDDEN), np.float32)
    for t, k in enumerate(live):
        old = h[:k]
        g, u = gates[at[t][:k]], old @ m["h" + side]
        rz = _sigmoid(g[:, :2 * HIDDEN] + u[:, :2 * HIDDEN])
        r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
        new = np.tanh(g[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
        if trace is not None:
            trace.append((old.copy(), r, z, new, u[:, 2 * HIDDEN:]))
        h[:k] = new + z * (old - new)
        states[t, :k] = h[:k]
    return states


def layout(codes: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple:
    """Order of windows by falling length, windows in use per step, entries read forwards and backwards, and
    for each step the backward step at the same word."""
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    steps = int(size[0]) if len(size) else 0
    live = [int(np.searchsorted(-size, -t, "left")) for t in range(steps)]
    ahead = [codes[first[:k] + t] for t, k in enumerate(live)]
    back = [codes[first[:k] + size[:k] - 1 - t] for t, k in enumerate(live)]
    return order, size, live, ahead, back


def pool(m: dict, size: np.ndarray, states_f: np.ndarray, states_b: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Attention over the words of each window (given by falling length): logits and what training needs."""
    steps, n = len(states_f), len(size)
    if not steps:
        return np.full(n, m["bias"][0], np.float32), ()
    used = states_f.shape[1]
    inside = np.arange(steps)[:, None] < size[None, :used]
    turn = np.maximum(size[None, :used] - 1 - np.arange(steps)[:, None], 0)
    both = np.concatenate([states_f, states_b[turn, np.arange(used)[None, :]]], axis=2) * inside[:, :, None]
    t = np.tanh(both @ m["att"])
    e = np.where(inside, t @ m["pick"], -1e9)
    e = np.exp(e - e.max(axis=0))
    weight = e / e.sum(axis=0)
    pooled = np.einsum("tn,tnk->nk", weight, both)
    logits = np.full(n, m["bias"][0], np.float32)
    logits[:used] += pooled @ m["out"]
    return logits, (inside, turn, both, t, weight, pooled)


def window_logits(m: dict, inputs: np.ndarray, codes: np.ndarray, first: np.ndarray, size: np.ndarray, most: int = 2048) -> np.ndarray:
    """Logit of each window."""
    gates = {s: inputs @ m["x" + s] + m["o" + s] for s in "fb"}
    out = np.empty(len(first), np.float32)
    for k in range(0, len(first), most):
        order, ordered, live, ahead, back = layout(codes, first[k:k + most], size[k:k + most])
        logits, _ = pool(m, ordered, run_side(m, "f", gates["f"], ahead, live), run_side(m, "b", gates["b"], back, live))
        out[k + order] = logits
    return out


def _back_side(m: dict, side: str, trace: list, dstates: np.ndarray, at: list, live: list[int], dgates: np.ndarray) -> np.ndarray:
    """Back-propagation through one direction; adds to ``dgates`` and returns the gradient of the recurrent weights."""
    dh = np.zeros(dstates.shape[1:], np.float32)
    du = np.zeros_like(m["h" + side])
    for t in range(len(live) - 1, -1, -1):
        k = live[t]
        old, r, z, new, un = trace[t]
        d = dh[:k] + dstates[t, :k]
        dnew = d * (1 - z) * (1 - new * new)
        dz = d * (old - new) * z * (1 - z)
        dr = dnew * un * r * (1 - r)
        dg = np.concatenate([dr, dz, dnew], axis=1)
        dupart = np.concatenate([dr, dz, dnew * r], axis=1)
        np.add.at(dgates, at[t][:k], dg)
        du += old.T @ dupart
        dh[:k] = d * z + dupart @ m["h" + side].T
    return du


def gradients(m: dict, inputs: np.ndarray, codes: np.ndarray, first: np.ndarray, size: np.ndarray, delta_of) -> tuple[dict, np.ndarray]:
    """Gradients of network weights and of the input vectors; ``delta_of(logits)`` is the loss derivative."""
    gates = {s: inputs @ m["x" + s] + m["o" + s] for s in "fb"}
    order, ordered, live, ahead, back = layout(codes, first, size)
    traces = {"f": [], "b": []}
    sf = run_side(m, "f", gates["f"], ahead, live, traces["f"])
    sb = run_side(m, "b", gates["b"], back, live, traces["b"])
    sorted_logits, cache = pool(m, ordered, sf, sb)
    logits = np.empty(len(first), np.float32)
    logits[order] = sorted_logits
    delta = delta_of(logits)[order].astype(np.float32)
    g = {"bias": np.array([delta.sum()], np.float32)}
    dinputs = np.zeros_like(inputs)
    if not live:
        return g, dinputs
    inside, turn, both, t, weight, pooled = cache
    used = both.shape[1]
    delta = delta[:used]
    g["out"] = pooled.T @ delta
    dpooled = delta[:, None] * m["out"]
    dweight = np.einsum("tnk,nk->tn", both, dpooled)
    de = weight * (dweight - (weight * dweight).sum(axis=0))
    g["pick"] = np.einsum("tn,tnk->k", de, t)
    dt = de[:, :, None] * m["pick"] * (1 - t * t)
    g["att"] = np.einsum("tnk,tna->ka", both, dt)
    dboth = (weight[:, :, None] * dpooled[None] + dt @ m["att"].T) * inside[:, :, None]
    db = np.zeros_like(sb)
    steps, cols = np.nonzero(inside)
    db[turn[steps, cols], cols] = dboth[steps, cols, HIDDEN:]
    for side, dstates, at in (("f", dboth[:, :, :HIDDEN], ahead), ("b", db, back)):
        dgates = np.zeros_like(gates[side])
        g["h" + side] = _back_side(m, side, traces[side], dstates, at, live, dgates)
        g["x" + side] = inputs.T @ dgates
        g["o" + side] = dgates.sum(axis=0)
        dinputs += dgates @ m["x" + side].T
    return g, dinputs


def fit(texts: list[str], labels: np.ndarray, seed: int = 3) -> dict:
    """Network fitted on documents with labels 0/1."""
    labels = np.asarray(labels, np.float32)
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return {"constant": share}
    words = Words(pa.array(texts, pa.string()), lower=True)
    bins, runs, owner = word_inputs(words.vocab)
    doc = words.doc()
    rng = np.random.default_rng(seed)
    m = init(rng)
    present = np.unique(words.codes * np.int64(len(texts)) + doc)  # (word, document) pairs
    entry, whole = present // len(texts), present % len(texts)

    def log_odds(feature: np.ndarray, document: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        pairs = np.unique(feature * len(texts) + document)
        toxic = np.bincount(pairs // len(texts), labels[pairs % len(texts)], minlength=width)
        clean = np.bincount(pairs // len(texts), 1 - labels[pairs % len(texts)], minlength=width)
        odds = np.log((toxic + 0.5) / (labels.sum() + 1)) - np.log((clean + 0.5) / ((1 - labels).sum() + 1))
        n = toxic + clean
        return np.where(n >= MIN_DOCS, odds * n / (n + SHRINK), 0.0).astype(np.float32), n

    odds, n = log_odds(bins[entry], whole, WORD_BINS)
    m["word"][:, 0], m["known"] = odds, n >= MIN_DOCS
    bounds = np.searchsorted(owner, np.arange(len(bins) + 1))
    some = np.repeat(np.arange(len(entry)), np.diff(bounds)[entry])
    at = np.arange(len(some)) - np.repeat(np.cumsum(np.diff(bounds)[entry]) - np.diff(bounds)[entry], np.diff(bounds)[entry])
    m["odds"] = np.maximum(log_odds(runs[bounds[entry[some]] + at], whole[some], CHAR_BINS)[0], 0)
    strength = embed(m, bins, runs, owner)
    strength = strength[:, 0] + strength[:, -1]
    first, size, home = windows(words.counts, words.starts)
    strongest = np.array([strength[words.codes[a:a + n]].max() if n else 0.0 for a, n in zip(first, size, strict=True)])
    learnt = [k for k in m if k not in ("odds", "known")]
    flat, square = ({k: np.zeros_like(m[k]) for k in learnt} for _ in range(2))
    step = 0
    counts = np.maximum(np.bincount(owner, minlength=len(bins)), 1)
    for round_ in range(ROUNDS):
        if round_:
            strongest = window_logits(m, embed(m, bins, runs, owner), words.codes, first, size)
        order = np.lexsort((-strongest, home))
        rank = np.arange(len(order)) - np.repeat(np.cumsum(np.bincount(home)) - np.bincount(home), np.bincount(home))
        top = order[rank < TOP]
        per_doc = [[] for _ in texts]
        for w in top:
            per_doc[home[w]].append(w)
        batch = int(np.clip(len(texts) // 20, 8, BATCH))
        epochs = max(EPOCHS, -(-MIN_STEPS * batch // len(texts)))  # small samples are gone through more often
        for epoch in range(epochs):
            rate = RATE / (1 + 2 * round_) / (1 + (epoch > epochs // 2))
            mixed = rng.permutation(len(texts))
            for k in range(0, len(mixed), batch):
                docs = mixed[k:k + batch]
                some = np.concatenate([per_doc[d] for d in docs]).astype(np.int64)
                whose = np.repeat(np.arange(len(docs)), [len(per_doc[d]) for d in docs])
                target = labels[docs]

                def delta_of(logits, whose=whose, target=target, n=len(docs)):
                    """Loss of the highest window of each document."""
                    best = np.full(n, -np.inf, np.float32)
                    np.maximum.at(best, whose, logits)
                    lead = logits == best[whose]
                    lead = lead / np.bincount(whose, lead, minlength=n)[whose]
                    weight = np.where(target == 1, 0.5 / share, 0.5 / (1 - share))
                    return lead * ((_sigmoid(best) - target) * weight)[whose] / n

                used, codes = np.unique(np.concatenate([words.codes[first[w]:first[w] + size[w]] for w in some] or [np.zeros(0, int)]),
                                        return_inverse=True)
                local = np.concatenate([[0], np.cumsum(size[some])])[:-1]
                mine = np.isin(owner, used)
                number = np.zeros(len(bins), np.int64)
                number[used] = np.arange(len(used))
                tri, own = runs[mine], number[owner[mine]]
                g, dx = gradients(m, embed(m, bins[used], tri, own), codes, local, size[some], delta_of)
                g["word"], g["char"] = np.zeros_like(m["word"]), np.zeros_like(m["char"])
                np.add.at(g["word"], np.where(m["known"][bins[used]], bins[used], 0), dx[:, :WORD_DIM])
                np.add.at(g["char"], tri, dx[own, WORD_DIM:-1] / counts[used][own][:, None])
                step += 1
                for name, grad in g.items():
                    flat[name] = 0.9 * flat[name] + 0.1 * grad
                    square[name] = 0.999 * square[name] + 0.001 * grad * grad
                    m[name] = m[name] - (rate * (flat[name] / (1 - 0.9 ** step))
                                         / (np.sqrt(square[name] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return m


def score_texts(m: dict, text: pa.Array) -> np.ndarray:
    """Highest window score of each text."""
    if "constant" in m:
        return np.full(len(text), m["constant"])
    words = Words(text, lower=True)
    inputs = embed(m, *word_inputs(words.vocab))
    first, size, home = windows(words.counts, words.starts)
    logits = window_logits(m, inputs, words.codes, first, size)
    begins = np.flatnonzero(np.concatenate([[True], home[1:] != home[:-1]]))
    return _sigmoid(np.maximum.reduceat(logits, begins)).astype(np.float64) if len(text) else np.zeros(0)


def fit_on_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Network fitted on at most SAMPLE_DOCS documents of each label."""
    texts, ys = labelled_sample(docs, labels, label, SAMPLE_DOCS, SAMPLE_CHARS, id_col, text_col)
    return fit(texts, np.array(ys, np.float32))


def toxicity_scores(docs: DataFrame, labels: DataFrame, keep: list[str] | None, text_col: str = "text",
                    score: str = "score") -> DataFrame:
    """The ``keep`` columns (None: all) and a score column, by a network fitted on the ``labels`` rows given."""
    sent = docs.sparkSession.sparkContext.broadcast(fit_on_sample(docs, labels, "toxic", text_col=text_col))
    return map_text(docs, text_col, keep, [(score, T.DoubleType())],
                    lambda: lambda text: [score_texts(sent.value, text)])


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; the fold crc32(doc_id) mod 3 = 1 is held out."""
    held = crc_fold(F.col("doc_id"), 3) == 1
    labels = documents(spark, sf_dir, "labels").where(F.col("doc_id").isNotNull() & ~held)
    scored = toxicity_scores(documents(spark, sf_dir), labels, ["doc_id"])
    return scored.select("doc_id", held.alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))

"""Quality classifier by attention-based multiple-instance learning (operator 7).

A document is a bag of passages (PASSAGE words each, the last one shorter). Each passage is described by
character classes, hashed character pairs and repetition measures, encoded by a tanh layer, and weighed by
gated attention (tanh branch times sigmoid branch); the weighted sum of encodings gives the document's
score. Only document labels are used; attention weights show which passages count.

Fitting runs on a bounded sample of labelled rows (SAMPLE_DOCS per class of at most SAMPLE_CHARS characters);
scoring covers all passages of all documents.

Defined results: null or empty text is one passage of zeros and is scored by the same model; without rows of
both labels every score is the share of label 1 (0.5 without any); repeated rows score alike; of repeated labels the lowest
counts; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.common import Words, crc_fold, documents, flat_bytes, labelled_sample, map_text

PASSAGE, PAIR_BINS, HIDDEN, GATE = 64, 32, 24, 12
SAMPLE_DOCS, SAMPLE_CHARS = 1200, 30_000
EPOCHS, BATCH, RATE = 40, 64, 0.01
THRESHOLD = 0.3
# Text bytes scored at once: a block's passage features stay small beside what the worker holds from other stages.
SCORE_BYTES = 256 << 10
SYMBOLS = b"#*$%&|<>"


def _class_table() -> np.ndarray:
    """Byte -> indicator of upper case, digit, symbol, exclamation mark, other ASCII sign, beyond ASCII."""
    table = np.zeros((256, 6), np.float32)
    for b in range(256):
        c = chr(b)
        kind = (0 if "A" <= c <= "Z" else 1 if c.isdigit() and b < 128 else 2 if b in SYMBOLS else 3 if c == "!"
                else 5 if b > 127 else 4 if not c.isalpha() else None)
        if kind is not None:
            table[b, kind] = 1
    return table


CLASSES = _class_table()
WORD_FEATURES = 6 + 5 + PAIR_BINS
FEATURES = WORD_FEATURES + 4


def word_features(vocab: pa.Array) -> np.ndarray:
    """Features of each vocabulary word: shares of byte classes, length, forms, hashed byte pairs."""
    raw, bounds = flat_bytes(vocab)
    size = np.diff(bounds)
    n = len(size)
    if not len(raw):
        return np.zeros((n, WORD_FEATURES), np.float32)
    begins = np.minimum(bounds[:-1], len(raw) - 1)  # the vocabulary may list the empty word, which no text uses
    long = np.maximum(size, 1)[:, None]
    shares = np.add.reduceat(CLASSES[raw], begins, axis=0) / long
    last = CLASSES[raw[bounds[1:] - 1]]
    first = raw[begins]
    forms = np.stack([np.log1p(size), shares[:, 0] == 1, last[:, 2] + last[:, 3], (size == 1) & (first == ord("|")),
                      CLASSES[first, 0]], axis=1)
    low = raw.astype(np.int64) | 0x20
    word = np.repeat(np.arange(n), size)
    inner = word[:-1] == word[1:]
    pair = ((low[:-1] * 31 + low[1:]) * 40503 >> 7) % PAIR_BINS
    pairs = np.bincount((word[:-1] * PAIR_BINS + pair)[inner], minlength=n * PAIR_BINS).reshape(n, PAIR_BINS) / long
    return np.concatenate([shares, forms, pairs], axis=1).astype(np.float32)


def passage_features(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages and the number of passages of each text (at least one)."""
    words = Words(text)
    per = np.maximum(1, -(-words.counts // PASSAGE))
    first = np.concatenate([[0], np.cumsum(per)])
    out = np.zeros((int(first[-1]), FEATURES), np.float32)
    n = len(words.codes)
    if not n:
        return out, per
    doc = words.doc()
    home = first[:-1][doc] + (np.arange(n) - words.starts[:-1][doc]) // PASSAGE
    begins = np.flatnonzero(np.concatenate([[True], home[1:] != home[:-1]]))
    rows, size = home[begins], np.diff(np.concatenate([begins, [n]]))
    out[rows, :WORD_FEATURES] = np.add.reduceat(word_features(words.vocab)[words.codes], begins, axis=0) / size[:, None]
    v = np.int64(len(words.vocab))
    own = np.unique(home * v + words.codes)
    out[rows, WORD_FEATURES] = np.bincount(own // v, minlength=len(out))[rows] / size
    equal = np.concatenate([[False], (words.codes[1:] == words.codes[:-1]) & (doc[1:] == doc[:-1])])
    out[rows, WORD_FEATURES + 1] = np.add.reduceat(equal.astype(np.float32), begins) / size
    follow = np.concatenate([np.where(doc[1:] == doc[:-1], words.codes[1:], -1), [-1]]).astype(np.int64) + 1
    _, which, times = np.unique((words.codes * (v + 1) + follow) * words.n_docs + doc, return_inverse=True, return_counts=True)
    out[rows, WORD_FEATURES + 2] = np.add.reduceat((times[which] > 1).astype(np.float32), begins) / size
    out[rows, WORD_FEATURES + 3] = np.log1p(size)
    return out, per


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def bag_forward(m: dict, x: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Logit of each bag; ``x`` holds the bags' passages in order."""
    begins = np.cumsum(per) - per
    bag = np.repeat(np.arange(len(per)), per)
    x = (x - m["mean"]) / m["scale"]
    h = np.tanh(x @ m["w"] + m["b"])
    t, s = np.tanh(h @ m["v"]), _sigmoid(h @ m["u"])
    e = (t * s) @ m["a"]
    e = np.exp(e - np.maximum.reduceat(e, begins)[bag])
    weight = e / np.add.reduceat(e, begins)[bag]
    z = np.add.reduceat(weight[:, None] * h, begins, axis=0)
    return z @ m["c"] + m["d"], (x, bag, begins, h, t, s, weight, z)


def bag_gradients(m: dict, cache: tuple, delta: np.ndarray) -> dict:
    """Gradients of the summed loss, given its derivative by the logits."""
    x, bag, begins, h, t, s, weight, z = cache
    dz = delta[:, None] * m["c"]
    dweight = (dz[bag] * h).sum(axis=1)
    de = weight * (dweight - np.add.reduceat(weight * dweight, begins)[bag])
    dt, ds = de[:, None] * s * m["a"] * (1 - t * t), de[:, None] * t * m["a"] * s * (1 - s)
    dh = weight[:, None] * dz[bag] + dt @ m["v"].T + ds @ m["u"].T
    da = dh * (1 - h * h)
    return {"w": x.T @ da, "b": da.sum(axis=0), "v": h.T @ dt, "u": h.T @ ds, "a": ((t * s) * de[:, None]).sum(axis=0),
            "c": z.T @ delta, "d": delta.sum()}


class Adam:
    def __init__(self, names, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, dict.fromkeys(names, 0.0), dict.fromkeys(names, 0.0)

    def step(self, params: dict, grads: dict) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            params[k] = params[k] - self.rate * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)


def fit(texts: list[str], labels: np.ndarray, seed: int = 5) -> dict:
    """Multiple-instance model of documents with labels 0/1; classes weigh alike."""
    labels = np.asarray(labels, float)
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return {"constant": share}
    parts = [passage_features(pa.array([t], pa.string())) for t in texts]
    per = np.array([int(p[1][0]) for p in parts])
    x = np.concatenate([p[0] for p in parts])
    first = np.concatenate([[0], np.cumsum(per)])
    rng = np.random.default_rng(seed)
    m = {"mean": x.mean(axis=0), "scale": x.std(axis=0) + 0.05, "w": rng.normal(0, FEATURES ** -0.5, (FEATURES, HIDDEN)),
         "b": np.zeros(HIDDEN), "v": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)), "u": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
         "a": rng.normal(0, GATE ** -0.5, GATE), "c": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "d": 0.0}
    adam = Adam(["w", "b", "v", "u", "a", "c", "d"], RATE)
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    for epoch in range(EPOCHS):
        if epoch == EPOCHS * 3 // 4:
            adam.rate /= 5
        order = rng.permutation(len(per))
        for k in range(0, len(order), BATCH):
            some = order[k:k + BATCH]
            rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in some])
            logit, cache = bag_forward(m, x[rows], per[some])
            grads = bag_gradients(m, cache, weight[some] * (_sigmoid(logit) - labels[some]) / len(some))
            adam.step(m, {g: v + (1e-4 * m[g] if g not in ("b", "d") else 0) for g, v in grads.items()})
    return {k: np.asarray(v, np.float32) for k, v in m.items()}


def score_texts(model: dict, text: pa.Array) -> np.ndarray:
    if "constant" in model:
        return np.full(len(text), model["constant"])
    x, per = passage_features(text)
    return _sigmoid(bag_forward(model, x, per)[0]).astype(np.float64)


def fit_on_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Model fitted on at most SAMPLE_DOCS documents of each label."""
    texts, ys = labelled_sample(docs, labels, label, SAMPLE_DOCS, SAMPLE_CHARS, id_col, text_col)
    return fit(texts, np.array(ys))


def quality_scores(docs: DataFrame, labels: DataFrame, keep: list[str] | None, text_col: str = "text",
                   score: str = "score") -> DataFrame:
    """The ``keep`` columns (None: all) and a score column, by a model fitted on the ``labels`` rows given."""
    model = fit_on_sample(docs, labels, "quality", text_col=text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return map_text(docs, text_col, keep, [(score, T.DoubleType())],
                    lambda: lambda text: [score_texts(sent.value, text)], SCORE_BYTES)


def training_labels(labels: DataFrame) -> DataFrame:
    """Labelled rows outside the held-out fold crc32(doc_id) mod 5 = 0."""
    return labels.where(F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id"), 5) != 0))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    scored = quality_scores(documents(spark, sf_dir), training_labels(documents(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", (crc_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))

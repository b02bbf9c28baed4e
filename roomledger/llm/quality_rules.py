"""Quality rules by suffix-array repetition (operator 3).

The words of every document form a suffix array, built by prefix doubling; longest-common-prefix values
of neighbouring suffixes give, for every position, the longest repeat that starts there, hence all maximal
repeated substrings of the document. The union of their spans (``covered``) and the longest one are
limited, beside a few plain counts.

Defined results: null or empty text has no words and fails the base rule; repeated rows get equal results;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.common import Words, doc_sums, documents, map_text

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
# Base rule: at least MIN_WORDS words, at most BASE_PERCENT of them in repeated windows of WINDOW words.
MIN_WORDS, WINDOW, BASE_PERCENT = 20, 8, 30
# Method: repeats of MIN_REPEAT words or more cover at most COVER_PERCENT of the words, and the longest has
# at most LONGEST_WORDS words or LONGEST_PERCENT of the document.
MIN_REPEAT, COVER_PERCENT, LONGEST_WORDS, LONGEST_PERCENT = 6, 35, 24, 15


def longest_repeats(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each word position, the length of the longest run starting there that occurs elsewhere in the
    same document (overlaps allowed).

    Suffix array of all documents at once: ranks start as (document, word), so no run crosses documents.
    A rank is the first slot of its group; only groups of two or more are sorted again.
    """
    n = len(codes)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    counts = np.diff(starts)
    doc = np.repeat(np.arange(len(counts)), counts)
    end = np.repeat(starts[1:], counts)
    key = doc * (int(codes.max()) + 1) + codes
    sa = np.argsort(key, kind="stable")
    sorted_key = key[sa]
    first = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[sa] = group
    alone = first & np.concatenate([first[1:], [True]])
    slots = np.flatnonzero(~alone)
    levels = [rank.astype(np.int32)]
    step = 1
    while len(slots):
        at = sa[slots]
        nxt = at + step
        inside = nxt < end[at]
        second = np.where(inside, rank[np.where(inside, nxt, 0)] + 1, 0)
        pair = rank[at] * (n + 1) + second
        order = np.argsort(pair, kind="stable")
        at, pair = at[order], pair[order]
        sa[slots] = at
        first = np.concatenate([[True], pair[1:] != pair[:-1]])
        lead = np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))
        rank[at] = slots[lead]
        levels.append(rank.astype(np.int32))
        slots = slots[~(first & np.concatenate([first[1:], [True]]))]
        step *= 2
    a, b = sa[:-1], sa[1:]
    same = levels[0][a] == levels[0][b]
    a, b = a[same], b[same]
    common = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + common, b + common
        inside = (x < end[a]) & (y < end[b])
        equal = inside & (levels[k][np.where(inside, x, 0)] == levels[k][np.where(inside, y, 0)])
        common += equal.astype(np.int64) << k
    best[b] = common
    best[a] = np.maximum(best[a], common)
    return best


def covered(best: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in a repeat of ``least`` words or more."""
    at = np.arange(len(best))
    reach = np.maximum.accumulate(np.where(best >= least, at + best, 0)) if len(best) else at
    return reach > at


def _rules(text: pa.Array) -> list:
    words = Words(text)
    best = longest_repeats(words.codes, words.starts)
    n = words.counts.astype(np.int64)
    repeat = doc_sums(covered(best, WINDOW), words.starts).astype(np.int64)
    span = doc_sums(covered(best, MIN_REPEAT), words.starts).astype(np.int64)
    longest = np.zeros(len(n), np.int64)
    if len(best):
        longest[n > 0] = np.maximum.reduceat(best, words.starts[:-1][n > 0])
    raw = pc.fill_null(text, "").cast(pa.binary()).to_pylist()
    points = pc.utf8_length(pc.fill_null(text, "")).to_numpy(zero_copy_only=False).astype(np.int64)
    spaces = np.array([len(b) - len(b.translate(None, SPACE)) for b in raw], np.int64)
    symbols = np.array([len(b) - len(b.translate(None, SYMBOLS)) for b in raw], np.int64)
    dup = np.zeros(len(raw), np.int64)
    for i, b in enumerate(raw):
        lines = [x for x in b.split(b"\n") if x.strip()]
        dup[i] = len(lines) - len(set(lines))
    failed = (n < MIN_WORDS) | (100 * repeat > BASE_PERCENT * n)
    fine = (100 * span <= COVER_PERCENT * n) & ((longest <= LONGEST_WORDS) | (100 * longest <= LONGEST_PERCENT * n))
    return [n, points - spaces, symbols, dup, repeat, failed, ~failed & fine, span, longest]


FIELDS = [("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()),
          ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()), ("base_failed", T.BooleanType()),
          ("kept", T.BooleanType()), ("n_covered_words", T.LongType()), ("longest_repeat", T.LongType())]


def quality_rules(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Counts, base rule and verdict beside the ``keep`` columns (None: all) of each row."""
    return map_text(df, text_col, keep, FIELDS, lambda: _rules)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over all documents."""
    out = quality_rules(documents(spark, sf_dir), keep=["doc_id"])
    return out.select(F.col("doc_id"), *[n for n, _ in FIELDS])

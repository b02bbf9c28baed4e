"""Line dedup: word counts, one long document, a crowded filter."""

import random
import re

import pytest
from pyspark.sql import functions as F

from roomledger.llm import line_dedup as L
from tests.llm.test_operators import brute_lines


def test_count_words_equals_the_word_pattern(spark):
    lines = ["", " ", "a", "a b", " a b", "a b ", "a  b", "a\tb", "a\x0bb c", "\r", "a\xa0b c", " x y", "é è", "a \x1f b", "  "]
    rows = spark.createDataFrame([(x,) for x in lines], "line string").select("line", L.count_words(F.col("line")).alias("n")).collect()
    assert {r.line: r.n for r in rows} == {x: len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines}


@pytest.mark.parametrize("words", [1, L.FILTER_WORDS])
def test_long_document_of_few_lines_and_a_crowded_filter(spark, monkeypatch, words):
    monkeypatch.setattr(L, "FILTER_WORDS", words)
    rng = random.Random(words)
    pool = [f"p{i} q{i} r" for i in range(9)]
    part = [rng.choice(pool) for _ in range(60)]
    rows = [(1, "\n".join([rng.choice(pool) for _ in range(120)] + part)), (2, "\n".join(["x y"] + part[5:50])), (3, "none here"), (None, None)]
    gone = brute_lines([r for r in rows if r[1]], 12)
    got = {r.doc_id: (r.n_deleted, r.text) for r in L.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string"), min_words=12).collect()}
    assert sum(len(g) for g in gone.values()) > 40
    for d, t in rows:
        left = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d])
        assert got[d] == (len(gone[d]) if t else 0, left)


def test_filter_holds_every_key(spark):
    keys = spark.range(2000).select(F.xxhash64("id").alias("k"))
    words = L.key_filter(keys, "k").checkpoint()
    assert L.may_hold(keys, words, "k", "there").where("not there").count() == 0
    others = spark.range(10**6, 10**6 + 2000).select(F.xxhash64("id").alias("k"))
    assert L.may_hold(others, words, "k", "there").where("there").count() < 20

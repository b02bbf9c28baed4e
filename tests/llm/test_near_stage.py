"""The near-duplicate stage of the pipeline: its shingles and limit, and one row of each group."""

import random



def shingles(text, n):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def test_bands_miss_few_pairs_at_the_limit():
    from roomledger.llm.near_duplicates import BANDS, ROWS, banding
    assert banding(85) == (ROWS, BANDS)
    for percent in (50, 70, 80, 85, 90, 95, 100):
        rows, bands = banding(percent)
        assert (1 - min(percent / 100, 0.99) ** rows) ** bands <= 3e-7 and rows * bands <= 220


def test_shingles_of_any_length_match_a_plain_split():
    import pyarrow as pa

    from roomledger.llm.near_duplicates import shingle_sets
    rng = random.Random(1)
    for n in (1, 2, 3, 5, 8):
        for size in (0, 1, 2, 3, 4, 20):
            texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, size))) for _ in range(rng.randint(1, 6))]
            elements, bounds = shingle_sets(pa.array(texts), n)
            ours = [frozenset(elements[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            for i, a in enumerate(texts):
                for j, b in enumerate(texts):
                    assert len(ours[i] & ours[j]) == len(shingles(a, n) & shingles(b, n))


def test_the_stage_links_five_word_shingles_from_80_percent(spark):
    import corpus_pipeline
    rng = random.Random(3)
    rows = []
    for g in range(12):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(1000)]
        rows += [(10 * g + 1, " ".join(base)), (10 * g + 2, " ".join([*base, *(f"n{rng.randrange(10 ** 6)}" for _ in range(220))])),
                 (10 * g + 3, " ".join([*base, *(f"m{rng.randrange(10 ** 6)}" for _ in range(300))]))]
    sets = {d: shingles(t, 5) for d, t in rows}
    assert {0.80 <= len(sets[1] & sets[d]) / len(sets[1] | sets[d]) < 0.85 for d in (2,)} == {True}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()}
    want = {d for d in sets if not any(e < d and 100 * len(sets[d] & sets[e]) >= 80 * len(sets[d] | sets[e]) for e in sets)}
    assert got == want and len(want) == 24


def test_one_row_of_each_group_stays(spark):
    import corpus_pipeline
    rng = random.Random(8)

    def near(words, n=1):
        return " ".join([*words, *(f"x{rng.randrange(10 ** 6)}" for _ in range(n))])

    bases = [[f"w{rng.randrange(10 ** 6)}" for _ in range(80)] for _ in range(6)]
    rows = [(5, " ".join(bases[0]))] * 40  # a row repeated
    rows += [(7, near(bases[0])), (9, " ".join(bases[0]))]
    rows += [(3, " ".join(bases[1])), (3, near(bases[1])), (3, near(bases[1], 2))]  # one id, near texts
    rows += [(None, " ".join(bases[2])), (None, near(bases[2])), (None, " ".join(bases[2]))]  # all ids null
    rows += [(None, " ".join(bases[3])), (2, near(bases[3])), (2, near(bases[3], 2))]  # some ids null
    rows += [(None, " ".join(bases[4])), (4, " ".join(bases[5]))]  # alone
    rows += [(30, ""), (30, ""), (31, ""), (32, None), (32, None), (None, " \n"), (None, " \n")]  # no words: linked with nothing
    rows = [(d, t, ("b", "a")[i % 2], len(t or "")) for i, (d, t) in enumerate(rows)]
    sets = [shingles(r[1], 5) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            linked = 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) if sets[i] and sets[j] else rows[i][:2] == rows[j][:2]
            if linked:
                root = [root[j] if x == root[i] else x for x in root]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").repartition(6)
    got = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert got.columns == docs.columns
    found = [tuple(r) for r in got.collect()]
    number = {r: root[i] for i, r in enumerate(rows)}
    assert sorted(number[r] for r in found) == sorted(set(root))  # each group once
    for r in found:
        ids = {rows[i][0] for i in range(len(rows)) if root[i] == number[r]}
        assert r[0] == min((d for d in ids if d is not None), default=None)
    again = corpus_pipeline.one_of_each_group(spark, docs.repartition(3), "").collect()
    assert sorted(map(str, found)) == sorted(str(tuple(r)) for r in again)
    assert corpus_pipeline.one_of_each_group(spark, docs.limit(0), "").count() == 0

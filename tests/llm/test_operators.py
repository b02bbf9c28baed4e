"""Operators against brute force, on small fixtures with nulls, empty and long texts, ties, repeated rows, empty tables
and further columns with clashing names."""

import bisect
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, id string, k string, score double, kept string, n_chars long"


def text_of(rng, n, vocab=None):
    vocab = vocab or ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "été", "groß"]
    return " ".join(rng.choice(vocab) for _ in range(n))


def rows_of(seed=1):
    rng = random.Random(seed)
    rows = [(i, text_of(rng, rng.randint(1, 60), [f"w{j}" for j in range(400)]) + ("\n" if i % 3 else "\nA line. ") + text_of(rng, 9)) for i in range(40)]
    rows += [(40, None), (41, ""), (42, " \n\t "), (43, rows[3][1]), (43, rows[3][1]), (44, rows[3][1] + " extra"), (None, "x y"),
             (45, "loop " * 3000), (46, "mail a.b9@mail1.example.com, +1 (499) 555-6503 97.51.17.173 4808875255130719"), (47, "q" * 20000)]
    return rows


@pytest.fixture(scope="module")
def frames(spark):
    full = [(d, t, "own", "k", 0.5, "x", None) for d, t in rows_of()]
    return spark.createDataFrame(full, SCHEMA), spark.createDataFrame([], SCHEMA)


def distinct_rows(rows):
    return {d: t for d, t in rows}


def test_packing_is_best_fit_decreasing(frames):
    import public_tokenizers
    from tokenizers import Tokenizer

    from roomledger.llm.packing import pack_documents
    df, none = frames
    got = pack_documents(df, capacity=256).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for d, t in rows_of():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 256):
            part = ids[k:k + 256]
            want[(d, k // 256, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    left = []
    for length in sorted((r.length for r in got), reverse=True):  # one piece after the other
        i = bisect.bisect_left(left, length)
        bisect.insort(left, (left.pop(i) if i < len(left) else 256) - length)
    assert len(bins) == len(left)
    assert pack_documents(none).count() == 0


def test_tightest_class_matches_a_scan():
    from roomledger.llm.packing import TightestClass
    rng = random.Random(2)
    tree, marked = TightestClass(50), set()
    for _ in range(500):
        c = rng.randint(0, 50)
        on = rng.random() < 0.5
        tree.mark(c, on)
        (marked.add if on else marked.discard)(c)
        n = rng.randint(0, 50)
        assert tree.at_least(n) == min((x for x in marked if x >= n), default=-1)


def test_pieces_round_trip_and_follow_the_lattice(frames):
    import public_tokenizers

    from roomledger.llm.pieces import Lattice, decode_pieces, sample_pieces
    df, none = frames
    first = sample_pieces(df)
    texts = sorted(((r.doc_id, r.text) for r in decode_pieces(first).collect()), key=str)
    assert texts == sorted(((d, t or "") for d, t in rows_of()), key=str)
    again = sample_pieces(df.repartition(5))
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))
    assert sample_pieces(none).count() == 0
    lattice = Lattice(public_tokenizers.path("piece_bpe_32k.model"))
    n = lattice.numbers(["▁then"] * 20000)
    who, codes, logs = lattice.sample(n, np.arange(20000, dtype=np.uint64), np.zeros(20000, np.int64))
    drawn = collections.Counter()
    total = np.bincount(who, logs)
    for i in range(20000):
        drawn[tuple(codes[who == i]) if i < 300 else round(float(total[i]), 9)] += i >= 300
    for log, count in drawn.items():  # frequencies follow the probabilities
        if isinstance(log, float) and math.exp(log) > 0.02:
            assert count / 19700 == pytest.approx(math.exp(log), rel=0.25)


def brute_rules(text):
    words = WORD.findall(text or "")
    at = collections.defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i:i + 8])].append(i)
    hit = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def test_quality_rules(frames):
    from roomledger.llm.quality_rules import longest_repeats, quality_rules
    df, none = frames
    want = collections.Counter((d, *brute_rules(t)) for d, t in rows_of())
    got = quality_rules(df, keep=["doc_id"]).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert all(not (r.base_failed and r.kept) for r in got)
    assert quality_rules(none).count() == 0
    rng = np.random.default_rng(0)
    codes, starts = rng.integers(0, 3, 60), np.array([0, 0, 25, 60])
    best = longest_repeats(codes, starts)
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        w = codes[a:b].tolist()
        for i in range(len(w)):
            longest = max((next((n for n in range(len(w)) if max(i, j) + n >= len(w) or w[i + n] != w[j + n]), 0) for j in range(len(w)) if j != i), default=0)
            assert best[a + i] == longest


def test_lm_scores_and_counts(frames):
    from roomledger.llm import lm_scoring as L
    df, none = frames
    lower = str.maketrans({i: i + 32 for i in range(65, 91)})
    tokens = [(d, [*WORD.findall((t or "").translate(lower)), None]) for d, t in rows_of()]
    fold = lambda d: 0 if d is None else zlib.crc32(str(d).encode()) % 5
    count = collections.Counter(w for d, ws in tokens if fold(d) != 1 for w in ws)
    total, distinct = sum(count.values()), len(count)
    want = sorted((str(d), fold(d) == 1, len(ws), sum(count[w] > 0 for w in ws), total,
                   round(sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws), 5)) for d, ws in tokens)
    got = L.score_documents(df).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert L.score_documents(none).count() == 0
    rng = np.random.default_rng(1)
    model = L.random_model(3, np.ones(L.BUCKETS + 1))
    symbols, lengths = rng.integers(0, L.BUCKETS, 300).astype(np.int32), np.array([1, 130, 64, 105])
    ends = np.cumsum(lengths)
    for value, e, n in zip(L.log_likelihood(model, symbols, lengths), ends, lengths, strict=True):
        state, log = model["start"], 0.0
        for o in symbols[e - n:e]:
            state = (state @ model["move"]) * model["emit"][o]
            log += math.log(state.sum())
            state = state / state.sum()
        assert value == pytest.approx(log)
    before = L.expected_counts(model, symbols, lengths)
    for _ in range(4):  # the likelihood grows (up to the smoothing)
        model = L.maximise(before, L.BUCKETS + 1)
        after = L.expected_counts(model, symbols, lengths)
        assert after[-1] > before[-1] - 1
        before = after


def test_fingerprints(frames, spark):
    from roomledger.llm.fingerprints import edited, fingerprint_chain, fingerprint_texts, likeness
    df, none = frames
    rows = sorted(((d, t or "") for d, t in rows_of()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = collections.Counter()
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        e = edited(t, nxt)
        own, new, follow = (fingerprint_texts([x]) for x in (t, e, nxt))
        want[(d, len(t), hashlib.sha256(e.encode()).hexdigest(), own[0].tobytes().hex(), new[0].tobytes().hex(),
              round(float(likeness(own, new)[0]), 9), round(float(likeness(own, follow)[0]), 9))] += 1
    got = fingerprint_chain(df).collect()
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint,
                                round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want
    assert fingerprint_chain(none).count() == 0
    one = fingerprint_chain(spark.createDataFrame([(1, "alone here")], "doc_id long, text string")).collect()
    assert one[0].near_next == 1.0


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for i, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(c) * 2, 10)) if k & 1 else int(c) for k, c in enumerate(reversed(digits)))
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 14 <= len(digits) <= 19 and luhn % 10 == 0 or kind == "phone" and 10 <= len(digits) <= 15):
                out.append((m.start(), i, m.end()))
    return [(s, list(PATTERNS)[k], e) for s, k, e in sorted(out)]


def test_personal_data(frames):
    from roomledger.llm import personal_data as P
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice("a@.1 2+-9(b)0\n") for _ in range(rng.randint(0, 60)))
        assert P.base_spans(text) == brute_spans(text), text
    df, none = frames
    got = P.find_personal_data(df, ["doc_id"]).collect()
    for r in got:
        base = brute_spans(dict(rows_of()).get(r.doc_id) or "")
        assert r.base_sha256 == hashlib.sha256(P.joined(base).encode()).hexdigest()
        assert set(filter(None, P.joined(base).split(","))) <= set(r.spans.split(","))
    assert P.find_personal_data(none, ["doc_id"]).count() == 0
    texts = [f"wer {n}.{n}@mail{n % 9}.example.com und +1 ({200 + n}) 555-{1000 + n} the 10.{n}.{n}.7 x" for n in range(150)]
    field = P.Field(P.fit(texts))
    assert [k for _, k, _ in P.all_spans("call (499) 555-6503 now", field)[1]] == ["phone"]
    assert P.all_spans("on 2024-01-01 12:30:00 version 2.0.", field)[1] == []
    assert P.without("a b@c.de f", [(2, "email", 8), (4, "email", 8)]) == "a <EMAIL> f"


def test_near_duplicates(frames, spark):
    from roomledger.llm.near_duplicates import near_duplicates
    rng = random.Random(7)
    base = [[f"v{rng.randrange(10 ** 6)}" for _ in range(rng.randint(40, 90))] for _ in range(6)]
    rows = rows_of()
    for i in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.choice((0, 1, 1, 2, 3, 5))):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10 ** 6)}"
        rows.append((100 + i, " ".join(words)))

    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            smallest[find(i)] = min(d, smallest.get(find(i), d))
    want = collections.Counter((d, len(sets[i]), smallest.get(find(i))) for i, (d, _) in enumerate(rows))
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, k string")
    got = near_duplicates(df).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert near_duplicates(frames[1]).count() == 0


def test_sketch_fills_every_coordinate():
    from roomledger.llm.near_duplicates import COORDINATES, EMPTY, mix64, sketches
    sizes = [1, 2, 50, 1000]
    parts = [mix64(np.arange(n, dtype=np.uint64) + np.uint64(1000 * n)) for n in sizes]
    out = sketches(np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)]))
    assert out.shape == (4, COORDINATES) and not (out == EMPTY).any()


def brute_lines(rows, least):
    gone, first = collections.defaultdict(set), set()
    for d, t in sorted(rows):
        lines = t.split("\n")
        total = [0]
        for line in lines:
            total.append(total[-1] + len(WORD.findall(line)))
        runs = [(i, j) for i in range(len(lines)) for j in range(i, len(lines)) if total[j + 1] - total[i] >= least]
        for i, j in runs:
            key = tuple(lines[i:j + 1])
            if key in first:
                gone[d].update(range(i, j + 1))
            first.add(key)
    return gone


def test_line_dedup_deletes_all_later_repeated_runs(frames, spark):
    from roomledger.llm.line_dedup import dedup_lines
    rng = random.Random(11)
    pool = [text_of(rng, rng.randint(0, 6)) for _ in range(12)]
    rows = []
    for d in range(45):
        lines = []
        while len(lines) < rng.randint(1, 12):
            if rows and rng.random() < 0.3:
                old = rng.choice(rows)[1].split("\n")
                at = rng.randrange(len(old))
                lines += old[at:at + rng.randint(1, 6)]
            else:
                lines.append(rng.choice(pool) if rng.random() < 0.6 else f"u{rng.random()} x")
        rows.append((d, "\n".join(lines)))
    gone = brute_lines(rows, 8)
    got = {r.doc_id: (r.n_deleted, r.text) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_words=8).collect()}
    for d, t in rows:
        left = [x for i, x in enumerate(t.split("\n")) if i not in gone[d]]
        assert got[d] == (len(gone[d]), "\n".join(left))
    odd = dedup_lines(frames[0])
    assert odd.count() == len(rows_of()) and odd.columns[:7] == frames[0].columns
    assert dedup_lines(frames[1]).count() == 0


def test_classifiers_separate_and_degrade(spark):
    from roomledger.llm import quality_classifier as Q
    from roomledger.llm import toxicity as X
    rng = random.Random(3)
    good = [text_of(rng, rng.randint(30, 200), [f"w{i}" for i in range(500)]) for _ in range(60)]
    bad = [" ".join(w.upper() + "!!" for w in text_of(rng, rng.randint(30, 200)).split()) for _ in range(60)]
    model = Q.fit(good[:40] + bad[:40], np.array([1] * 40 + [0] * 40))
    assert Q.score_texts(model, pa.array(good[40:])).min() > 0.7 and Q.score_texts(model, pa.array(bad[40:])).max() < 0.3
    assert np.isfinite(Q.score_texts(model, pa.array([None, "", " ", "x" * 50000]))).all()
    assert Q.fit(["a"], np.array([1]))["constant"] == 1.0
    insult = [t + " " + rng.choice(("stupid", "moron.")) + " " + t for t in good[:40]]
    net = X.fit(good[:40] + insult, np.array([0] * 40 + [1] * 40, np.float32))
    fresh = [t + " moron " + t for t in good[40:]]
    assert (X.score_texts(net, pa.array(fresh)) >= 0.7).mean() > 0.9 and (X.score_texts(net, pa.array(good[40:])) < 0.7).mean() > 0.9
    assert np.isfinite(X.score_texts(net, pa.array([None, "", "y " * 3000]))).all()
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in Q.quality_scores(docs, labels, ["doc_id"]).collect()] == [0.5, 0.5]
    assert [r.score for r in X.toxicity_scores(docs, labels, ["doc_id"]).collect()] == [0.0, 0.0]


def test_gradients_are_those_of_the_loss():
    from roomledger.llm import quality_classifier as Q
    rng = np.random.default_rng(0)
    shapes = {"w": (Q.FEATURES, Q.HIDDEN), "b": (Q.HIDDEN,), "v": (Q.HIDDEN, Q.GATE), "u": (Q.HIDDEN, Q.GATE), "a": (Q.GATE,), "c": (Q.HIDDEN,)}
    m = {k: rng.normal(0, 0.3, s) for k, s in shapes.items()} | {"d": 0.1, "mean": 0.0, "scale": 1.0}
    x, per = rng.normal(size=(9, Q.FEATURES)), np.array([2, 4, 3])
    _, cache = Q.bag_forward(m, x, per)
    grads = Q.bag_gradients(m, cache, np.ones(3))
    for name in shapes:
        at = tuple(0 for _ in shapes[name])
        values = []
        for eps in (1e-5, -1e-5):
            other = dict(m)
            other[name] = m[name].copy()
            other[name][at] += eps
            values.append(Q.bag_forward(other, x, per)[0].sum())
        assert grads[name][at] == pytest.approx((values[0] - values[1]) / 2e-5, rel=1e-4)


def test_pipeline_stages(frames, spark):
    import corpus_pipeline
    from roomledger.llm.common import stored
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = [(d, t, "en", "s", len(t or "")) for d, t in rows_of()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = stored(stage(spark, docs, "/root/testdata/sf0.001"), f"test-{name}")
        if name != "packing":
            assert docs.columns == columns
            assert docs.count() <= before
            before = docs.count()
            assert docs.where("n_chars <> coalesce(length(text), 0)").count() == 0
    assert docs.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 4096


def test_masked_addresses_without_digits_are_found():
    from roomledger.llm import personal_data as P
    texts = [f"wer {w}.{w}@mail{n % 9 or ''}.example.com und +1 ({200 + n}) 555-{1000 + n} the 10.{n}.{n}.7 x"
             for n in range(150) for w in ("ab" * (1 + n % 4),)]
    field = P.Field(P.fit(texts))
    for masked in ("jane.doe(at)example.com", "jane.doe[at]example.com", "jane [at] example.com", "jane9 [at] example.com",
                   "jane (at) mail.example.com", "jane[at] example.com", "jane9[at] example.com", "jane (at)example.com"):
        for text in (masked, f"please write to {masked} for more", f"one\n{masked}\ntwo"):
            spans = P.all_spans(text, field)[1]
            assert [(text[s:e], k) for s, k, e in spans] == [(masked, "email")], text
    for text in ("we met (at noon) there", "see you [at] home", "(at)", "[at] ", " (at)  x", "no sign at all"):
        assert P.all_spans(text, field)[1] == []
    rng = random.Random(5)
    for _ in range(3000):  # every word with a sign, and the words beside a masked one, lie in islands
        text = "".join(rng.choice(("(at)", "[at]", "ab", "c.", "7", "@", " ", " ", "\n", "(at", "]")) for _ in range(rng.randint(0, 25)))
        inside = {i for s, e in P.islands(text) for i in range(s, e)}
        words = [m.span() for m in WORD.finditer(text)]
        want = set()
        for i, (s, e) in enumerate(words):
            if re.search(r"[0-9@]|[(\[]at[)\]]", text[s:e]):
                want |= set(range(s, e))
                if i and re.match(r"[(\[]at[)\]]", text[s:e]) and text[words[i - 1][1]:s] == " ":
                    want |= set(range(*words[i - 1]))
                if i + 1 < len(words) and re.search(r"[(\[]at[)\]]$", text[s:e]) and text[e:words[i + 1][0]] == " ":
                    want |= set(range(*words[i + 1]))
        assert want == {i for i in inside if text[i] not in " \n"}, text

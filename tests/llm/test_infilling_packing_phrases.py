"""Fill-in-middle, cost-balanced packing and collocations against brute force: nulls, empty and long texts, repeated rows,
ties, empty tables, clashing further columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

SCHEMA = "doc_id long, text string, id string, lang string, `a.b` string, n long, n0 long, Text string"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "own", lang, "x", 7, 8, "T") for d, t, lang in rows], SCHEMA)


def some_rows(seed=1):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "été", "groß", "日本", "x9", "😀", "o'clock"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 300))), "en") for i in range(60)]
    return rows + [(60, None, "en"), (61, "", None), (62, "a <P> b", "en"), (63, "x<M>", "en"), (64, rows[3][1], "en"),
                   (64, rows[3][1], "en"), (None, "no id at all", "en"), (65, "long é " * 20000, "en"), (66, "<", "en"), (67, "<S<P", "en")]


def plain_form(doc_id, text):
    text = text or ""
    n, hexes = len(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexes[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("units", [3, 16_384])
def test_fill_in_middle(spark, units):
    from roomledger.llm.infilling import fill_in_middle
    rows = [r for r in some_rows() if units > 3 or r[0] != 65]
    got = fill_in_middle(table(spark, rows), units=units, output="made").collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = collections.Counter()
    for d, t, _ in rows:
        n, form, a, m, out = plain_form(d, t)
        want[(d, n, form, a, m, sha(out), sha(t), out)] += 1
    assert collections.Counter(tuple(r) for r in got) == want
    assert fill_in_middle(table(spark, rows).limit(0)).count() == 0


def test_frames_seek():
    import zstandard

    from roomledger.llm.infilling import Frames, find_marks
    c, d = zstandard.ZstdCompressor().compress, zstandard.ZstdDecompressor()
    text, opened = "".join(chr(97 + i % 26) for i in range(1000)) + "é" * 50, []

    def decompress(frame):
        opened.append(frame)
        return d.decompress(frame)

    store = Frames.of(text, c, 64)
    for lo, hi in [(0, 0), (0, 1050), (63, 65), (128, 192), (1049, 1050), (500, 700)]:
        opened.clear()
        assert b"".join(store.read(lo, hi, decompress)).decode() == text[lo:hi]
        assert len(opened) <= (hi - lo) // 64 + 2 and (hi > lo or not opened)
    parts = "a<<P>b<S" + "<S>" + "<M" + "<M>z"
    for units in (1, 2, 3, 7):
        marks = find_marks(Frames.of(parts, c, units), d.decompress)
        assert marks == {m: parts.find(m) for m in ("<P>", "<S>", "<M>")}


def one_by_one(lengths, capacity, cost):
    """Costs and lengths of all sequences, every piece on its own."""
    full, rest = divmod(sum(lengths), capacity)
    bins = [[0, capacity, 0] for _ in range(full)] + [[0, 1 << i, 0] for i in range(rest.bit_length()) if rest >> i & 1]
    todo = collections.Counter(lengths)
    while todo:
        n = max(todo)
        for _ in range(todo.pop(n)):
            open_ = [b for b in bins if b[1] >= n] or [b for b in bins if b[1]]
            best = min(open_, key=lambda b: (b[0], -b[1]))
            taken = min(n, best[1])
            best[0], best[1], best[2] = best[0] + cost(taken), best[1] - taken, best[2] + taken
            if taken < n:
                todo[n - taken] += 1
    return sorted((b[0], b[2]) for b in bins)


@pytest.mark.parametrize("seed", range(6))
def test_the_plan_equals_one_piece_at_a_time(seed):
    from roomledger.llm.cost_packing import balanced_plan, piece_cost
    rng = random.Random(seed)
    capacity = (64, 64, 256, 100, 8, 256)[seed]
    lengths = [rng.randint(1, capacity) if rng.random() < 0.6 else rng.randint(1, 9) for _ in range((0, 1, 300, 500, 400, 900)[seed])]
    cost = (lambda n: 5 * n + n * n) if seed % 2 else piece_cost
    bins, rooms = collections.defaultdict(list), collections.Counter()
    for _, _, _, count, _, taken, first, offset in balanced_plan(collections.Counter(lengths), capacity, cost):
        for i in range(count):
            bins[first + i].append((offset, taken))
    assert sorted((sum(cost(t) for _, t in b), sum(t for _, t in b)) for b in bins.values()) == one_by_one(lengths, capacity, cost)
    for parts in bins.values():
        at = 0
        for offset, taken in sorted(parts):
            assert offset == at
            at += taken
        rooms[at] += 1
    assert all(n == capacity or n & (n - 1) == 0 for n in rooms)


def test_cost_packing_places_every_token_once(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from roomledger.llm.cost_packing import pack_by_cost
    rows = some_rows(2)
    got = pack_by_cost(table(spark, rows), capacity=256).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = collections.defaultdict(list)
    for d, t, _ in rows:
        ids[d].append(tok.encode(t or "", add_special_tokens=False).ids + [2])
    assert sum(r.length for r in got) == sum(len(x) for docs in ids.values() for x in docs)
    bins, starts = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        doc = next(x for x in ids[r.doc_id] if len(x) == r.doc_tokens)
        assert r.ids_crc32 == zlib.crc32(np.array(doc[r.start:r.start + r.length], "<u4").tobytes())
        bins[r.sequence_id].append((r.offset, r.length))
        starts[r.doc_id].append((r.start, r.length))
    for d, parts in starts.items():
        assert sum(n for _, n in parts) == sum(map(len, ids[d]))
        covered = collections.Counter(i for s, n in parts for i in range(s, s + n))
        assert set(covered.values()) == {len(ids[d])}
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256 and (at == 256 or at & (at - 1) == 0)
    assert pack_by_cost(table(spark, rows).limit(0)).count() == 0


def test_token_ids_equal_the_tokenizer():
    import public_tokenizers

    from roomledger.llm.token_ids import TokenIds
    path = public_tokenizers.path("word_bpe_49k.json")
    for cache in (1, 1000):  # the store of words is given up and filled again
        ids = TokenIds(path, cache_words=cache)
        for seed in range(3):
            texts = [t or "" for _, t, _ in some_rows(seed)]
            want = [np.array(ids.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
            assert ids(pa.array(texts)) == want


def plain_collocations(rows, least, top, longest=4):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                f[lang].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {p[i:i + m] for p, b in cand.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
                if 100 * b >= 80 * cand[p[i:i + m]]}
        best = []
        for p, a in cand.items():
            if p not in gone:
                s, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                best.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, b[2].decode(), -b[1], b[3], b[4], n[lang], -b[0]) for i, b in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def phrase_rows(seed):
    rng = random.Random(seed)
    words = ["a", "B", "ç", "d", "new york", "e", "<x>"]
    rows = [(i, "".join(rng.choice(words) + rng.choice([" "] * 6 + ["\t", "  ", ". ", "\n", "!\r\n", ", "]) for _ in range(rng.randint(0, 80))),
             rng.choice(["en", "de", None])) for i in range(120)]
    return rows + [(200, None, "en"), (201, "", "fr"), (202, " ,. ", "fr"), (203, "Last night was last night", "en"), (7, rows[7][1], rows[7][2])] \
        + [(300 + i, "aaa bbb ccc ddd", "es") for i in range(50)] + [(400, "q " * 5000, "es")]


@pytest.mark.parametrize("one_in, sample_least, bits", [(1, 1, 1 << 20), (4, 2, 1 << 20), (50, 1, 1 << 20), (4, 10**9, 1 << 20), (2, 1, 64)])
def test_collocations_whatever_the_sample_holds(spark, one_in, sample_least, bits):
    """Good, thin and empty samples, and a filter that is full, give the same exact result."""
    from roomledger.llm.collocations import collocations
    rows = phrase_rows(one_in)
    got = collocations(table(spark, rows), least=9, top=25, one_in=one_in, sample_least=sample_least, filter_bits=bits)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows, 9, 25)


def test_border_failures_bring_further_passes(spark):
    from roomledger.llm.collocations import collocations, frequent_phrases
    df = spark.createDataFrame([(t, lang or "und") for _, t, lang in phrase_rows(3)], "text string, lang string")
    assert frequent_phrases(df, 9, one_in=1, sample_least=9, filter_bits=1 << 20)[2] == 1  # the sample is the corpus
    assert frequent_phrases(df, 9, one_in=4, sample_least=10**9, filter_bits=1 << 20)[2] == 2  # nothing was proposed
    assert collocations(table(spark, []), least=9).count() == 0


def test_counts_beyond_64_bits(spark):
    from roomledger.llm.collocations import scored, uncovered
    big = 2**62
    found = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 5), ("en", 1, "c", big),
                                   ("en", 2, "b c", big - 6), ("en", 3, "a b c", big // 5 * 4)], "lang string, k int, phrase string, n long")
    rows = {r.phrase: r for r in scored(found).collect()}
    assert rows["a b"].score == 2_000_000 * (big - 5) // (2 * big + 1)
    a = big // 5 * 4
    score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k, x, y in ((1, big, big - 6), (2, big - 5, big)))
    assert (rows["a b c"].score, rows["a b c"].l, rows["a b c"].r) == (score, left, right)
    kept = {r.phrase for r in uncovered(scored(found), found).collect()}
    assert kept == {p for p, n in (("a b", big - 5), ("b c", big - 6)) if 100 * a < 80 * n} | {"a b c"}


def test_bulk_hashes_tell_words_apart():
    from roomledger.llm.collocations import bulk_hashes
    words = [w * n for w in ("a", "b", "é", "ab") for n in (1, 2, 7, 8, 9, 16, 17, 255, 256, 257, 5000)] + ["", "a\0", "\0a"]
    words = sorted(set(words))
    hashes = bulk_hashes(pa.array(words))
    assert len(set(hashes.tolist())) == len(words)
    assert bulk_hashes(pa.array(words[3:9])).tolist() == hashes[3:9].tolist()
    assert len(bulk_hashes(pa.array([], pa.string()))) == 0

"""Phrase collocations by Toivonen mining (operator 13).

A phrase cannot be more frequent than the phrases inside it. So a sample of the documents (one in ``SAMPLE_ONE_IN`` by a
hash of the row) is mined first, level by level, at a threshold lowered far enough that few frequent phrases are missed;
what it finds is the proposal. One full pass over all documents then counts exactly every proposed phrase together with
the negative border: all words, and every occurring phrase of k words whose two phrases of k - 1 words are proposed
while it is not itself. A border phrase that proves frequent is a failure of the sample. Then an expansion pass counts all
phrases that hold a failure and whose phrases of one word less are proposed, failures or again hold one. This closes the
search: a frequent phrase not counted at first has a part that was not proposed, and so, going on to its parts, holds a
failure, as do all its parts that were not counted at first. The result is exact whatever the sample holds.

Counting passes shuffle one (64-bit hash, count) row per distinct phrase and task. Hash collisions can only raise a count,
so the phrases whose hash reaches the threshold include every frequent one; a last pass counts exactly these by their text.
The proposal and the phrases of the last pass reach the tasks as Bloom filters of fixed size (``FILTER_BITS``, 16 MB),
the only things broadcast. A phrase is by definition proposed if the filter holds it, when counting as when looking for
failures, so a false positive costs work and no correctness; a filter that a huge vocabulary fills up degrades to counting
more. Within a block equal phrases are found by exact word codes. A very common word or phrase is a few rows per task.

Scores need the counts of the parts of each candidate; they are joined on (lang, part), the parts' table salted
``SALT``-fold since common words begin or end many phrases. The longest lists are cut per (lang, hash) before per lang.

Defined results: null text has no words; null lang is ``und``; repeated rows count each; other columns may have any
name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.common import blocks, documents, flat_bytes, mix64, resolved, stored, word_hashes

LEAST, LONGEST, TOP, SCALE, COVERED_PERCENT = 30, 4, 2000, 2_000_000, 80
SAMPLE_ONE_IN, SAMPLE_LEAST = 4, 4
FILTER_BITS, PROBES, SALT, LONG_WORD = 1 << 27, 3, 8, 256
COUNT_BLOCK_BYTES, FOLD_ROWS = 2 << 20, 800_000
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
COUNTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("k", T.IntegerType()),
                       T.StructField("phrase", T.StringType()), T.StructField("n", T.LongType())])


class WordRuns:
    """Words of a block of texts: ``codes`` index ``vocab``; ``run`` numbers the piece of each word, ``row`` its text."""

    def __init__(self, text: pa.Array):
        raw, bounds = flat_bytes(pc.ascii_lower(pc.fill_null(text, "")))
        kind = np.zeros(256, np.uint8)
        kind[list(BREAKS)], kind[list(BLANKS)] = 2, 1
        kinds = kind[raw]
        inside = kinds == 0
        first = inside.copy()  # first byte of a word: after other than a word byte, or at the start of a text
        first[1:] &= ~inside[:-1]
        heads = bounds[:-1][np.diff(bounds) > 0]
        first[heads] = inside[heads]
        starts = np.flatnonzero(first)
        size = np.add.reduceat(inside, starts, dtype=np.int64) if len(starts) else starts  # word bytes up to the next word
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        flat = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[inside]))
        coded = pc.dictionary_encode(flat)
        self.vocab, self.codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        self.row = (np.searchsorted(bounds, starts, "right") - 1).astype(np.int32)
        self.run = np.searchsorted(np.flatnonzero(kinds == 2), starts) + self.row


def bulk_hashes(vocab: pa.Array) -> np.ndarray:
    """64-bit hash of each vocabulary entry, eight bytes of all entries at a time; entries over ``LONG_WORD`` bytes one by one."""
    raw, bounds = flat_bytes(vocab)
    raw = np.concatenate([raw, np.zeros(8, np.uint8)])
    size = np.diff(bounds)
    h = mix64(size.astype(np.uint64) + np.uint64(1))
    far = size > LONG_WORD
    open_ = np.flatnonzero(~far & (size > 0))
    byte = np.arange(8)
    for start in range(0, LONG_WORD, 8):
        if not len(open_):
            break
        chunk = raw[(bounds[open_] + start)[:, None] + byte]
        chunk[byte >= (size[open_] - start)[:, None]] = 0
        h[open_] = mix64(h[open_] * np.uint64(0x9E3779B97F4A7C15) ^ chunk.view(np.uint64)[:, 0])
        open_ = open_[size[open_] > start + 8]
    if far.any():
        h[far] = word_hashes(vocab.filter(pa.array(far)))
    return h


class PhraseFilter:
    """Bloom filter over 64-bit hashes; the words of the bitmap are set by :func:`filter_of`."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for at in probes(h, 64 * len(self.bits)):
            out &= (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def probes(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """Bit numbers of each hash (its lowest bit, which marks phrases of the greatest length, aside)."""
    out, x = [], h.astype(np.uint64) >> np.uint64(1)
    for _ in range(PROBES):
        x = mix64(x + np.uint64(0x9E3779B97F4A7C15))
        out.append(x & np.uint64(bits - 1))
    return out


class Level(NamedTuple):
    """Distinct phrases of k words of a block: position of their first occurrence, hash, count, whether they are new
    (not yet counted in an earlier pass)."""
    k: int
    where: np.ndarray
    hash: np.ndarray
    n: np.ndarray
    new: np.ndarray


class Block:
    """Phrases of a block of texts. Equal phrases are found by exact codes; hashes only serve the filters."""

    def __init__(self, text: pa.Array, lang: pa.Array):
        self.words = WordRuns(text)
        langs = pc.dictionary_encode(pc.fill_null(lang.cast(pa.string()), "und"))
        self.langs = langs.dictionary
        self.lang_of = langs.indices.to_numpy(zero_copy_only=False)[self.words.row]

    def levels(self, now: PhraseFilter | None, past: PhraseFilter | None, longest: int) -> Iterator[Level]:
        """All words; of longer phrases those whose two phrases without the last and without the first word are in ``now``.

        With ``past`` given, phrases in ``now`` but not in ``past`` are failures. A phrase that holds a failure may be
        frequent whatever ``past`` says, so it stands in for one in ``now``; a phrase is new unless both its phrases are in
        ``past``, which is when the earlier pass counted it.
        """
        words, size = self.words, len(self.words.vocab)
        if not len(words.codes):
            return
        word_hash = bulk_hashes(words.vocab)[words.codes]
        ids, at = self.lang_of.astype(np.int64) * size + words.codes, np.arange(len(words.codes), dtype=np.int32)
        hashes = mix64(word_hash ^ mix64(bulk_hashes(self.langs)[self.lang_of]))
        new, holds = np.ones(len(at), bool), None
        for k in range(1, longest + 1):
            coded = pc.dictionary_encode(pa.array(ids))
            ids = coded.indices.to_numpy(zero_copy_only=False)  # dense, so that ids * size stays below 64 bits
            n = np.bincount(ids, minlength=len(coded.dictionary))
            first = np.empty(len(n), np.int64)
            first[ids[::-1]] = np.arange(len(ids) - 1, -1, -1)
            distinct = hashes[first]
            yield Level(k, at[first], distinct, n, new[first])
            if k == longest:
                return
            in_now = may = now.has(distinct)[ids]
            if past is not None:
                in_past = past.has(distinct)[ids]
                holds = (in_now & ~in_past) if holds is None else holds | (in_now & ~in_past)
                may = in_now | holds
            # a phrase of k + 1 words begins where one of k words does and another follows a word later, in one piece
            place = np.full(len(words.codes) + 1, -1, np.int32)
            place[at] = np.arange(len(at), dtype=np.int32)
            follow = place[at + 1]
            last = np.minimum(at + k, len(words.codes) - 1)
            left = np.flatnonzero((follow >= 0) & may & may[follow] & (words.run[at] == words.run[last]) & (last == at + k))
            if not len(left):
                return
            follow = follow[left]
            if past is not None:
                new, holds = ~(in_past[left] & in_past[follow]), holds[left] | holds[follow]
            else:
                new = np.ones(len(left), bool)
            last, at = last[left], at[left]
            hashes = mix64(hashes[left] * np.uint64(0x9E3779B97F4A7C15) + word_hash[last] + np.uint64(k + 1))
            ids = ids[left].astype(np.int64) * size + words.codes[last]

    def phrases(self, level: Level, rows: np.ndarray) -> list[pa.Array]:
        """Arrays lang, k, phrase, n of some of a level's phrases."""
        where = level.where[rows]
        parts = [self.words.vocab.take(pa.array(self.words.codes[where + j])) for j in range(level.k)]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if level.k > 1 else parts[0]
        return [self.langs.take(pa.array(self.lang_of[where])), pa.array(np.full(len(where), level.k, np.int32)),
                phrase.cast(pa.string()), pa.array(level.n[rows].astype(np.int64))]


def folded(hashes: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
    """Counts by hash of several blocks in one."""
    coded = pc.dictionary_encode(pa.array(np.concatenate(hashes).view(np.int64)))
    n = np.bincount(coded.indices.to_numpy(zero_copy_only=False), weights=np.concatenate(counts))
    return pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n.astype(np.int64))], ["hash", "n"])


def hashed_counts(df: DataFrame, now, past, shortest: int, longest: int, greatest: int) -> DataFrame:
    """One pass: counts (hash, n) of the phrases of ``shortest`` to ``longest`` words that ``now`` and ``past`` (broadcast
    bitmaps) make worth counting and earlier passes have not counted. Hashes of phrases of ``greatest`` words, which no other
    phrase depends on, are odd, all others even. ``df`` has columns (text, lang)."""

    def run(batches):
        has_now = PhraseFilter(now.value) if now is not None else None
        has_past = PhraseFilter(past.value) if past is not None else None
        hashes, counts, rows = [], [], 0
        for batch in batches:
            text, lang = batch.column(0), batch.column(1)
            for lo, hi in blocks(text, COUNT_BLOCK_BYTES):
                for level in Block(text.slice(lo, hi - lo), lang.slice(lo, hi - lo)).levels(has_now, has_past, longest):
                    if level.k >= shortest:
                        hashes.append(level.hash[level.new] & ~np.uint64(1) | np.uint64(level.k == greatest))
                        counts.append(level.n[level.new])
                        rows += len(hashes[-1])
                if rows >= FOLD_ROWS:
                    yield folded(hashes, counts)
                    hashes, counts, rows = [], [], 0
                    pa.default_memory_pool().release_unused()
        if rows:
            yield folded(hashes, counts)

    # the tasks have folded their rows: no second hash table in front of the shuffle
    return df.mapInArrow(run, "hash long, n long").repartition("hash").groupBy("hash").agg(F.sum("n").alias("n"))


def phrase_counts(df: DataFrame, heavy, longest: int) -> DataFrame:
    """One pass: exact counts (lang, k, phrase, n) of the phrases in ``heavy`` (a broadcast bitmap), and under k = 0 the
    number of words per lang."""

    def run(batches):
        has = PhraseFilter(heavy.value)
        for batch in batches:
            text, lang = batch.column(0), batch.column(1)
            for lo, hi in blocks(text, COUNT_BLOCK_BYTES):
                block = Block(text.slice(lo, hi - lo), lang.slice(lo, hi - lo))
                for level in block.levels(has, None, longest):
                    yield pa.RecordBatch.from_arrays(block.phrases(level, np.flatnonzero(has.has(level.hash))), COUNTS.names)
                n = np.bincount(block.lang_of, minlength=len(block.langs))
                yield pa.RecordBatch.from_arrays([block.langs, pa.array(np.zeros(len(n), np.int32)),
                                                  pa.array([""] * len(n), pa.string()), pa.array(n.astype(np.int64))], COUNTS.names)

    return df.mapInArrow(run, COUNTS).groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def filter_of(hashes: DataFrame, old: np.ndarray | None, bits: int) -> np.ndarray:
    """Bitmap that holds the hashes (column ``hash``) and all of ``old``. Only set words of the bitmap come to the
    driver, folded in the tasks first: at most bits / 64 rows of 16 bytes."""

    def places(batches):
        for batch in batches:
            at = np.concatenate(probes(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits))
            word, one = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
            order = np.argsort(word)
            word, one = word[order], one[order]
            heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
            merged = np.bitwise_or.reduceat(one, heads) if len(word) else one
            yield pa.RecordBatch.from_arrays([pa.array(word[heads].view(np.int64)), pa.array(merged.view(np.int64))], ["w", "b"])

    rows = hashes.select("hash").mapInArrow(places, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(bits // 64, np.uint64) if old is None else old.copy()
    out[rows.column("w").to_numpy()] |= rows.column("b").to_numpy().view(np.uint64)
    return out


def frequent_phrases(df: DataFrame, least: int = LEAST, longest: int = LONGEST, one_in: int = SAMPLE_ONE_IN,
                     sample_least: int = SAMPLE_LEAST, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame, int]:
    """``df`` has columns (text, lang). Returns the table (lang, k, phrase, n) of all phrases of 1 to ``longest`` words
    with n >= ``least``, the table (lang, n) of words per lang, and the number of full counting passes."""
    context = df.sparkSession.sparkContext
    sample = df.where(F.pmod(F.xxhash64("text", "lang"), F.lit(one_in)) == 0)
    bits = sent = None
    for k in range(1, longest):  # proposals of up to longest - 1 words decide what is counted
        bits = filter_of(hashed_counts(sample, sent, None, k, k, longest).where(F.col("n") >= sample_least), bits, filter_bits)
        if sent is not None:
            sent.destroy()
        sent = context.broadcast(bits)
    counted = stored(hashed_counts(df, sent, None, 1, longest, longest).where(F.col("n") >= least), "heavy")
    heavy, passes = filter_of(counted, None, filter_bits), 1
    # phrases of the border that proved frequent; those of the greatest length lead to no other
    failed = filter_of(counted.where(F.col("hash") % 2 == 0), bits, filter_bits)
    if (failed != bits).any():
        past, sent = sent, context.broadcast(failed)
        more = stored(hashed_counts(df, sent, past, 2, longest, longest).where(F.col("n") >= least), "more")
        heavy, passes = filter_of(more, heavy, filter_bits), 2
        past.destroy()
    sent.destroy()
    held = context.broadcast(heavy)
    found = stored(phrase_counts(df, held, longest).where((F.col("n") >= least) | (F.col("k") == 0)), "phrases")
    held.destroy()
    return (found.where((F.col("k") > 0) & (F.col("n") >= least)), found.where(F.col("k") == 0).select("lang", "n"), passes)


def scored(found: DataFrame, least: int = LEAST, salt: int = SALT) -> DataFrame:
    """Candidates (lang, k, phrase, a) with their lowest-scoring cut (score, l, r), from the table of frequent phrases."""
    cand = found.where(F.col("k") >= 2).select("lang", "k", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    sides = F.explode(F.flatten(F.transform(F.sequence(F.lit(1), F.col("k") - 1), lambda c: F.array(
        F.struct(c.alias("cut"), F.lit(True).alias("head"), F.array_join(F.slice("w", F.lit(1), c), " ").alias("part")),
        F.struct(c.alias("cut"), F.lit(False).alias("head"), F.array_join(F.slice("w", c + 1, F.col("k") - c), " ").alias("part"))))))
    asked = cand.select("lang", "k", "phrase", "a", sides.alias("s")).select(
        "lang", "k", "phrase", "a", "s.cut", "s.head", "s.part",
        F.pmod(F.xxhash64("phrase", "s.cut"), F.lit(salt)).cast("int").alias("salt"))
    parts = found.select(
        "lang", F.col("phrase").alias("part"), F.col("n").alias("f"), F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("salt"))
    joined = asked.join(parts, ["lang", "part", "salt"])
    cuts = joined.groupBy("lang", "k", "phrase", "a", "cut").agg(
        F.max(F.when(F.col("head"), F.col("f"))).alias("l"), F.max(F.when(~F.col("head"), F.col("f"))).alias("r"))
    score = F.expr(f"(cast(a as decimal(20,0)) * {SCALE}) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "k", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    return best.select("lang", "k", "phrase", "a", "b.score", "b.l", "b.r")


def uncovered(cand: DataFrame, found: DataFrame, percent: int = COVERED_PERCENT) -> DataFrame:
    """Candidates without those that any longer candidate holds at ``percent`` of their count or more."""
    longer = found.where(F.col("k") >= 3).select("lang", "k", "n", F.split("phrase", " ").alias("w"))
    inside = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("k") - m + 1), lambda at: F.array_join(F.slice("w", at, m), " ")))))
    most = longer.select("lang", inside.alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    covered = F.col("most").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * percent
    return cand.join(most, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False))).drop("most")


def top_phrases(cand: DataFrame, top: int = TOP, buckets: int = 64) -> DataFrame:
    """First ``top`` of each lang with their rank: first per (lang, hash), then per lang."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = cand.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(buckets)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))).where(F.col("rank") <= top)
    ranked = part.drop("rank", "bucket").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top)


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP,
                 one_in: int = SAMPLE_ONE_IN, sample_least: int = SAMPLE_LEAST, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Per lang the first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    text_at, lang_at = resolved(df, text_col), resolved(df, lang_col)
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    slim = flat.select(F.col(f"c{text_at}").cast("string").alias("text"), F.col(f"c{lang_at}").cast("string").alias("lang"))
    found, words, _ = frequent_phrases(slim, least, one_in=one_in, sample_least=sample_least, filter_bits=filter_bits)
    best = top_phrases(uncovered(scored(found, least), found), top)
    return best.join(F.broadcast(words), "lang").select(  # one row per lang
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 2000 phrases per lang of all documents."""
    return collocations(documents(spark, sf_dir))


def op13_sql() -> str:
    """DuckDB: all phrases counted directly."""
    grams = " UNION ALL ".join(
        "SELECT lang, {k} AS k, {phrase} AS phrase FROM x WHERE {ok}".format(
            k=k, phrase=" || ' ' || ".join(f"w{j}" for j in range(k)), ok="true" if k == 1 else f"w{k - 1} IS NOT NULL")
        for k in range(1, LONGEST + 1))
    leads = ", ".join(f"lead(w, {j}) OVER p AS w{j}" for j in range(1, LONGEST))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{upper}', '{lower}') AS t
           FROM documents),
p AS (SELECT doc, lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece, generate_subscripts(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]'), 1) AS pn FROM d),
q AS (SELECT doc, lang, pn, string_split_regex(piece, '[\\x20\\x09]') AS ws FROM p),
y AS (SELECT doc, lang, pn, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM q),
x AS (SELECT lang, w AS w0, {leads} FROM y WHERE w <> '' WINDOW p AS (PARTITION BY doc, pn ORDER BY pos)),
g AS (SELECT lang, k, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= {LEAST}),
n AS (SELECT lang, count(*) AS n FROM x GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM g WHERE k >= 2),
u AS (SELECT c.*, unnest(range(1, c.k)) AS cut FROM c),
s AS (SELECT u.lang, u.phrase, u.k, u.a, u.cut, h.f AS l, t.f AS r, CAST({SCALE} AS HUGEINT) * u.a // (h.f + t.f) AS score
      FROM u JOIN g h ON h.lang = u.lang AND h.phrase = array_to_string(u.ws[1:u.cut], ' ')
             JOIN g t ON t.lang = u.lang AND t.phrase = array_to_string(u.ws[u.cut + 1:u.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, a, k, ws, m, unnest(range(1, k - m + 2)) AS pos FROM (SELECT *, unnest(range(2, k)) AS m FROM c)),
v AS (SELECT lang, array_to_string(ws[pos:pos + m - 1], ' ') AS phrase, max(a) AS most FROM i GROUP BY ALL),
z AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank
      FROM b LEFT JOIN v USING (lang, phrase) WHERE v.most IS NULL OR 100 * v.most < {COVERED_PERCENT} * b.a)
SELECT z.lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n.n,
       CAST(score AS BIGINT) AS score FROM z JOIN n USING (lang) WHERE rank <= {TOP}
"""

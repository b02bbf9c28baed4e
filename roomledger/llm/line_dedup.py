"""Line dedup by a suffix array over line sequences (operator 9).

The corpus is one sequence of line ids, document after document (by id, then text hash). Lines that occur once
split it; the rest is ranked by prefix doubling: at level k a suffix's rank is the order of its first 2**k
lines, and the next one ranks pairs (rank here, rank 2**k lines on). A job makes two levels: it ranks the four ranks 2**k lines
apart, whose first two name the level between. That is a window within the
document, a distinct, a sort of the distinct keys and a join, until no rank splits any more.

Suffixes in rank order, ties by position, are the suffix array. The common prefix of neighbours follows
from the rounds: ranks that never part mean the whole rest; ranks that part after m rounds mean fewer than
2**m lines; the first half of these is known to be equal, the rest is compared line by line, one row a line, so no task
holds a document. Only irreducible neighbours (different line in front) are compared; any other value is
the one of the position before, less one, so the compared lines stay within n log n. Neighbours whose common prefix
has MIN_WORDS words or more are joined into intervals; all of an interval's suffixes share its smallest common
prefix. Its first position is the original, and the run at every later one is deleted.

A longer match inside an interval can end in lines that lie behind all of these runs. So each line is also looked at
as a run's end: the shortest run of MIN_WORDS words that ends there is named by the ranks of its first and last
2**k lines (equal names, equal runs), and later copies of a name are deleted. Every line of a maximal repeated run of
MIN_WORDS words or more lies in the shortest such run from the run's start, or in the shortest one that ends at the line
itself; so both together delete exactly the union of all maximal repeated runs, first copies left out.

The deleted line numbers go to the texts by one plan at every size: a Bloom filter of at most FILTER_WORDS rows of two longs (8 MB) over
the keys of documents that lose lines tells which texts may be concerned; these are joined by a shuffle, all others
pass by unmoved. A crowded filter lets more texts into the join, the result is the same.

Defined results: null and empty texts stay as they are; rows with equal id and text are one document and get the same
result; null ids come first in the order; runs may repeat within a document; a document may lose all lines (empty text);
extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roomledger.llm.common import documents, resolved, stored

MIN_WORDS = 20
# Words (longs) of the Bloom filter over documents that lose lines, a row each, and its bits per document, all in one word:
# about 3 % false hits at 3 million of them.
FILTER_WORDS, FILTER_HASHES = 1 << 19, 3
SPACES = "[\\x20\\x09-\\x0D]+"


def count_words(line: Column) -> Column:
    """Words of a line. Where single spaces part them, the spaces are counted; only other lines are split."""
    odd = line.contains("  ") | line.startswith(" ") | line.endswith(" ") | line.rlike("[\\x09-\\x0D]") | (line == "")
    spaces = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    return F.when(~odd, spaces + 1).otherwise(F.size(F.array_remove(F.split(line, SPACES), "")))


def repeated_lines(keyed: DataFrame) -> DataFrame:
    """Lines that occur twice or more (``keyed``: id, r, text): id, r, at, h, g, w; h and g identify the line."""
    lines = keyed.select("id", "r", F.posexplode(F.split("text", "\n")).alias("at", "line")).select(
        "id", "r", "at", F.xxhash64("line").alias("h"), F.hash("line").alias("g"), count_words(F.col("line")).alias("w"))
    lines = stored(lines, "all-lines")  # hashes and counts only, so the texts are split once
    often = lines.groupBy("h", "g").agg(F.count("*").alias("n")).where("n > 1").select("h", "g")
    return lines.join(often, ["h", "g"]).dropDuplicates(["id", "r", "at"])


def numbered(rows: DataFrame, keys: list[str], halves: int = 0) -> tuple[DataFrame, int]:
    """``rows`` with the order number of their keys as ``rank`` (growing, with gaps), and the number of distinct keys.

    ``halves`` > 0 also gives ``half``, the number of the first ``halves`` keys: the smallest rank that starts with them.
    """
    kinds = stored(rows.select(*keys).distinct().orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()), "ranks")
    named = kinds
    if halves:
        named = kinds.join(kinds.groupBy(*keys[:halves]).agg(F.min("rank").alias("half")), keys[:halves])
    return rows.join(named, keys), kinds.count()


def within(*order: str):
    return Window.partitionBy("id", "r").orderBy(*order)


def suffix_ranks(rows: DataFrame) -> DataFrame:
    """Adds ``levels``, names of the first 1, 2, 4, ... lines of each suffix; ``rank``, the last of them, orders all rests."""
    first, kinds = numbered(rows, ["h", "g"])
    now, step = stored(first.withColumn("levels", F.array("rank")).drop("h", "g"), "suffixes"), 1
    while kinds:
        quads = now
        for i, name in enumerate(["two", "three", "four"], 1):
            ahead = F.max("rank").over(within("at").rangeBetween(i * step, i * step))
            quads = quads.withColumn(name, F.coalesce(ahead, F.lit(-1)))
        before = kinds
        ranked, kinds = numbered(quads.withColumnRenamed("rank", "one"), ["one", "two", "three", "four"], halves=2)
        ranked = ranked.withColumn("levels", F.concat("levels", F.array("half", "rank"))).drop("one", "two", "three", "four", "half")
        now, step = stored(ranked, "suffixes"), 4 * step
        if kinds == before:
            break
    return now


def suffix_array(ranked: DataFrame) -> DataFrame:
    """Suffixes with the part of the array they lie in (``part``) and their neighbour before (``prev``).

    Adds: ``left`` (line in front, if it repeats too), ``stop`` (end of the stretch of repeated lines), ``words``
    (repeated words in front, in the document).
    """
    gap = Window.partitionBy("id", "r").orderBy("at")
    rows = ranked.withColumn("line", F.element_at("levels", 1))
    rows = rows.withColumn("left", F.max("line").over(gap.rangeBetween(-1, -1)))
    rows = rows.withColumn("words", F.sum("w").over(gap.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("words", F.coalesce("words", F.lit(0)))
    ends = F.when(F.max("line").over(gap.rangeBetween(1, 1)).isNull(), F.col("at") + 1)
    rows = rows.withColumn("ends", ends)
    rows = rows.withColumn("stop", F.first("ends", ignorenulls=True).over(gap.rowsBetween(0, Window.unboundedFollowing))).drop("ends")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["rank", "id", "r", "at"]
    dealt = stored(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "array")
    mine = F.struct("id", "r", "at", "left", "levels", "stop")
    dealt = dealt.withColumn("prev", F.lag(mine).over(Window.partitionBy("part").orderBy(*order)))
    # the last suffix of each part is the neighbour of the next part's first (one row per part)
    last = dealt.groupBy("part").agg(F.max_by(mine, F.struct(*order)).alias("end"))
    last = last.select("part", F.lag("end").over(Window.orderBy("part")).alias("end"))
    joined = dealt.join(last, "part").withColumn("prev", F.coalesce("prev", "end"))
    return joined.drop("end")


def common_prefixes(array: DataFrame) -> DataFrame:
    """Adds ``lcp`` (lines shared with the neighbour before) and ``shared`` (their words). ``array`` is stored."""
    same = F.size(F.filter(F.zip_with("levels", "prev.levels", lambda x, y: x == y), lambda e: e))
    rows = array.withColumn("m", F.when(F.col("prev").isNull(), 0).otherwise(same))
    tied = F.col("m") == F.size("levels")
    fresh = F.col("left").isNull() | ~F.col("left").eqNullSafe(F.col("prev.left"))
    # ranks equal in m rounds: the first 2**(m-1) lines are equal; within 2**m lines, or where a stretch ends, they part
    half = F.pow(F.lit(2), F.col("m") - 1).cast("int")
    limit = F.least(2 * half, F.col("stop") - F.col("at"), F.col("prev.stop") - F.col("prev.at"))
    rows = rows.withColumn("half", half).withColumn("limit", limit)
    rows = rows.withColumn("known", F.when(F.col("m") < 2, F.col("m")).when(tied, F.col("stop") - F.col("at"))
                           .when(F.col("limit") <= F.col("half"), F.col("limit")))
    asked = rows.where(fresh & F.col("known").isNull()).select(
        "id", "r", "at", "limit", F.col("prev.id").alias("id2"), F.col("prev.r").alias("r2"), F.col("prev.at").alias("at2"),
        F.explode(F.sequence(F.col("half"), F.col("limit") - 1)).alias("d"))
    texts = array.select(F.col("id").alias("idt"), F.col("r").alias("rt"), F.col("at").alias("att"), F.element_at("levels", 1).alias("line"))

    def with_line(pairs: DataFrame, id_: str, r: str, at: str, name: str) -> DataFrame:
        """The line ``d`` lines behind ``at`` of that document; it exists, as the stretch goes on to there."""
        return pairs.join(texts, F.col(id_).eqNullSafe(F.col("idt")) & (F.col(r) == F.col("rt")) & (F.col(at) + F.col("d") == F.col("att"))
                          ).withColumnRenamed("line", name).drop("idt", "rt", "att")

    pairs = with_line(with_line(asked, "id", "r", "at", "one"), "id2", "r2", "at2", "two")
    answers = pairs.groupBy("id", "r", "at", "limit").agg(F.min(F.when(F.col("one") != F.col("two"), F.col("d"))).alias("differs")).select(
        "id", "r", "at", F.coalesce("differs", "limit").alias("found"))
    answers = answers.select(F.col("id").alias("ida"), F.col("r").alias("ra"), F.col("at").alias("ata"), "found")
    rows = rows.join(answers, F.col("id").eqNullSafe(F.col("ida")) & (F.col("r") == F.col("ra")) & (F.col("at") == F.col("ata")),
                     "left").drop("ida", "ra", "ata")
    value = F.least(F.coalesce("known", "found"), F.col("stop") - F.col("at"), F.col("prev.stop") - F.col("prev.at"))
    before = within("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("to", F.last(F.when(fresh | F.col("known").isNotNull(), F.col("at") + value), ignorenulls=True).over(before))
    rows = rows.withColumn("lcp", F.greatest(F.col("to") - F.col("at"), F.lit(0)))
    # words up to the end of the shared lines: the sum in front of the line behind them
    rows = stored(rows.select("id", "r", "at", "rank", "part", "words", "w", "lcp"), "prefixes")
    ends = rows.select(F.col("id").alias("ide"), F.col("r").alias("re"), (F.col("at") + 1).alias("ate"),
                       (F.col("words") + F.col("w")).alias("upto"))
    out = rows.join(ends, F.col("id").eqNullSafe(F.col("ide")) & (F.col("r") == F.col("re"))
                    & (F.col("at") + F.col("lcp") == F.col("ate")), "left")
    return out.withColumn("shared", F.when(F.col("lcp") > 0, F.col("upto") - F.col("words")).otherwise(0)).drop("ide", "re", "ate", "upto")


def later_copies(prefixes: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Runs to delete: id, r, at, depth. One per suffix that is not its interval's first."""
    order = ["rank", "id", "r", "at"]
    cut = (F.col("shared") < min_words).cast("long")
    rows = prefixes.withColumn("cut", cut)
    per_part = rows.groupBy("part").agg(F.sum("cut").alias("cuts"))
    offset = per_part.select("part", F.coalesce(F.sum("cuts").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    running = F.sum("cut").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = stored(rows.withColumn("running", running).join(offset, "part").select(
        "id", "r", "at", "lcp", "cut", (F.col("running") + F.col("offset")).alias("interval")), "intervals")
    found = rows.groupBy("interval").agg(F.min(F.struct("id", "r", "at")).alias("first"),
                                         F.min(F.when(F.col("cut") == 0, F.col("lcp"))).alias("depth")).where("depth is not null")
    return rows.join(found, "interval").where(F.struct("id", "r", "at") > F.col("first")).select("id", "r", "at", "depth")


def later_ends(array: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Runs to delete, found from their ends: id, r, at, depth of later copies of the shortest runs of
    ``min_words`` words that end at each line."""
    starts = array.select("id", "r", "stop", F.col("words").alias("value"), F.lit(0).alias("end"), "at")
    ends = array.select("id", "r", "stop", (F.col("words") + F.col("w") - min_words).alias("value"), F.lit(1).alias("end"), "at")
    seen = Window.partitionBy("id", "r", "stop").orderBy("value", "end", "at").rowsBetween(Window.unboundedPreceding, 0)
    runs = starts.unionByName(ends).withColumn("from", F.last(F.when(F.col("end") == 0, F.col("at")), ignorenulls=True).over(seen))
    runs = runs.where("end = 1 and from is not null").select("id", "r", "from", (F.col("at") - F.col("from") + 1).alias("depth"))
    runs = runs.withColumn("k", F.floor(F.log2("depth") + 1e-9).cast("int"))
    runs = runs.withColumn("tail", F.col("from") + F.col("depth") - F.pow(F.lit(2), F.col("k")).cast("int"))
    level = F.least(F.col("k") + 1, F.size("levels"))

    def rank_at(rows: DataFrame, at: str, name: str) -> DataFrame:
        known = array.select(F.col("id").alias("idk"), F.col("r").alias("rk"), F.col("at").alias("atk"), "levels")
        return rows.join(known, F.col("id").eqNullSafe(F.col("idk")) & (F.col("r") == F.col("rk")) & (F.col(at) == F.col("atk"))
                         ).withColumn(name, F.element_at("levels", level)).withColumn(
                             "last", F.col("k") + 1 >= F.size("levels")).drop("idk", "rk", "atk", "levels")

    named = rank_at(rank_at(runs, "from", "one"), "tail", "two")
    # ranks of the last round tell whole rests apart, so the front one is enough there
    named = stored(named.withColumn("two", F.when(F.col("last"), -1).otherwise(F.col("two"))).select(
        "id", "r", F.col("from").alias("at"), "depth", "one", "two"), "ends")
    found = named.groupBy("depth", "one", "two").agg(F.min(F.struct("id", "r", "at")).alias("first"), F.count("*").alias("n")).where("n > 1")
    return named.join(found, ["depth", "one", "two"]).where(F.struct("id", "r", "at") > F.col("first")).select("id", "r", "at", "depth")


def deleted_lines(keyed: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """id, r and the sorted numbers of the deleted lines (``gone``) of documents that lose any."""
    ranked = suffix_ranks(stored(repeated_lines(keyed), "lines"))
    array = stored(suffix_array(ranked), "array")
    runs = later_copies(common_prefixes(array), min_words).unionByName(later_ends(array, min_words))
    runs = runs.groupBy("id", "r", "at").agg(F.max("depth").alias("depth"))
    whole = ranked.select("id", "r", "at").join(
        runs.select(F.col("id").alias("idr"), F.col("r").alias("rr"), F.col("at").alias("atr"), "depth"),
        F.col("id").eqNullSafe(F.col("idr")) & (F.col("r") == F.col("rr")) & (F.col("at") == F.col("atr")), "left")
    reach = F.max(F.col("at") + F.col("depth")).over(within("at").rowsBetween(Window.unboundedPreceding, 0))
    gone = whole.withColumn("reach", reach).where("reach > at")
    return gone.groupBy("id", "r").agg(F.sort_array(F.collect_set("at")).alias("gone"))


def filter_word(key: Column) -> Column:
    """The word of the Bloom filter that a key's bits lie in."""
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(FILTER_WORDS))


def filter_bits(key: Column) -> Column:
    """A long with the FILTER_HASHES bits of a key set."""
    places = [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(64)).cast("int") for i in range(1, FILTER_HASHES + 1)]
    return reduce(lambda x, y: x.bitwiseOR(y), [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places])


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """The Bloom filter of a long column: word, bits. At most FILTER_WORDS rows."""
    return keys.groupBy(filter_word(F.col(key)).alias("word")).agg(F.bit_or(filter_bits(F.col(key))).alias("bits"))


def may_hold(rows: DataFrame, words: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with ``name``: false for a key that the filter was not built from (true for a few of them)."""
    marked = rows.join(F.broadcast(words), filter_word(F.col(key)) == F.col("word"), "left")
    mask = filter_bits(F.col(key))
    return marked.withColumn(name, F.coalesce(F.col("bits").bitwiseAND(mask) == mask, F.lit(False))).drop("word", "bits")


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``df`` with the text's later copies deleted, and n_lines, n_deleted (long)."""
    id_at, text_at = resolved(df, id_col), resolved(df, text_col)
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    text, key = F.col(f"c{text_at}"), F.col(f"c{id_at}")
    flat = flat.withColumn("rk", F.xxhash64(key.cast("string"), text))
    keyed = flat.where(text.isNotNull() & (F.length(text) > 0)).select(key.alias("id"), F.col("rk").alias("r"), text.alias("text"))
    gone = stored(deleted_lines(keyed, min_words), "deleted")
    marked = may_hold(flat, stored(key_filter(gone, "r"), "filter"), "rk", "concerned")
    # a merge join at every size: the table of line numbers grows with the corpus and is never broadcast
    joined = marked.where("concerned").join(gone.hint("merge"), key.eqNullSafe(F.col("id")) & (F.col("rk") == F.col("r")), "left")
    others = marked.where(~F.col("concerned")).select(*flat.columns).withColumn("gone", F.lit(None).cast(gone.schema["gone"].dataType))
    out = joined.select(*flat.columns, "gone").unionByName(others)
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda x, i: ~F.array_contains(F.col("gone"), i))
    new = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    names = [F.col(f"c{i}") if i != text_at else new.alias(f"c{i}") for i in range(len(df.columns))]
    return out.select(*names, F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_deleted")).toDF(*df.columns, "n_lines", "n_deleted")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later copies of repeated line runs of MIN_WORDS words or more."""
    return dedup_lines(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_lines", "n_deleted", "text")

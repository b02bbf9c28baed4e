"""Fill-in-middle transformation over seekable compressed frames (operator 11).

A text is stored as independent zstandard frames of at most ``FRAME_UNITS`` code points, with the cumulative unit counts
at which they start. Reading a range of units seeks to its first frame; only frames that a cut falls into are decoded to
code points, every other frame is streamed as bytes. The frame table is written once to the shared folder; from it the
second pass cuts each text into prefix, middle and suffix, lays the output out as a frame store of its own, and digests
output and restored text as streams of frames, so that neither is ever built as one value (only ``fill_in_middle`` with
``output=`` does, for callers who want the text). The restored text is read from the output's frames and the form alone.

Both passes work row by row without a shuffle: a long text is a long row, never a hot task, and equal texts cost no
more than unequal ones.

Defined results: null text is empty; an empty text is plain; a null id is hashed as the empty text after ``1:``;
repeated rows give equal rows; other columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.common import documents, resolved, stored

# Code points in a frame; compressed bytes of result rows handed over at once.
FRAME_UNITS, LEVEL, SLAB_BYTES = 16_384, 1, 4 << 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
PLAIN_FROM, SPM_BELOW = 90, 20  # percent of h3, percent of h4


class Frames:
    """A text as independent compressed frames. ``starts[i]`` is the number of units before frame i; the last entry is
    the length of the text."""

    def __init__(self, frames: list[bytes], starts: list[int]):
        self.frames, self.starts = frames, starts

    @classmethod
    def of(cls, text: str | Iterable[str], compress, units: int = FRAME_UNITS) -> Frames:
        """Frames of a text, or of a text given in parts."""
        frames, starts = [], [0]
        for part in [text] if isinstance(text, str) else text:
            for lo in range(0, len(part), units):
                unit = part[lo:lo + units]
                frames.append(compress(unit.encode()))
                starts.append(starts[-1] + len(unit))
        return cls(frames, starts)

    def __len__(self) -> int:
        return self.starts[-1]

    def read(self, lo: int, hi: int, decompress) -> Iterator[bytes]:
        """UTF-8 bytes of the units lo to hi, frame by frame; frames cut by lo or hi are decoded to be cut."""
        i = bisect_right(self.starts, lo) - 1
        while lo < hi:
            start, end = self.starts[i], self.starts[i + 1]
            data = decompress(self.frames[i])
            if start < lo or hi < end:
                data = data.decode()[lo - start:hi - start].encode()
            yield data
            lo, i = end, i + 1

    def texts(self, decompress) -> Iterator[tuple[int, str]]:
        """Start and text of each frame in order."""
        for start, frame in zip(self.starts, self.frames):
            yield start, decompress(frame).decode()


def find_marks(store: Frames, decompress) -> dict[str, int]:
    """Unit at which each of the three marks first occurs, marks across a frame border included."""
    found: dict[str, int] = {}
    tail = ""
    for start, text in store.texts(decompress):
        seen = tail + text
        for mark in (PREFIX, SUFFIX, MIDDLE):
            if mark not in found and (at := seen.find(mark)) >= 0:
                found[mark] = start - len(tail) + at
        tail = seen[-2:]
    return found


def cuts(n: int, key: str) -> tuple[str, int, int]:
    """Form of a text of n > 0 units without marks, and the two cuts, from the sha256 of the row key."""
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return PLAIN if h3 % 100 >= PLAIN_FROM else SPM if h4 % 100 < SPM_BELOW else PSM, a, b


def arranged(store: Frames, form: str, a: int, b: int, compress, decompress) -> Frames:
    """The output as a frame store: whole frames of the text are taken over as they are, cut frames are rewritten."""
    spans = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, len(store))}
    order = {PLAIN: (), PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}[form]
    if not order:
        return store
    frames, starts = [], [0]

    def put(frame: bytes, units: int) -> None:
        frames.append(frame)
        starts.append(starts[-1] + units)

    for mark in order:
        lo, hi = spans[mark]
        i = bisect_right(store.starts, lo) - 1
        head = mark
        while lo < hi:
            start, end = store.starts[i], store.starts[i + 1]
            if start == lo and end <= hi:
                if head:
                    put(compress(head.encode()), len(head))
                    head = ""
                put(store.frames[i], end - start)
            else:
                part = head + decompress(store.frames[i]).decode()[lo - start:hi - start]
                put(compress(part.encode()), len(part))
                head = ""
            lo, i = end, i + 1
        if head:
            put(compress(head.encode()), len(head))
    return Frames(frames, starts)


def restored(output: Frames, form: str, decompress) -> Iterator[bytes]:
    """The text again, in order, from the output and its form: the marks are looked up, the spans between them read."""
    if form == PLAIN:
        yield from output.read(0, len(output), decompress)
        return
    at = find_marks(output, decompress)
    order = sorted(at, key=at.get)
    ends = {m: at[order[k + 1]] if k + 1 < len(order) else len(output) for k, m in enumerate(order)}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from output.read(at[mark] + len(mark), ends[mark], decompress)


def frame_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", units: int = FRAME_UNITS) -> DataFrame:
    """One row per document: id, n (units), marked (a mark occurs in the text), starts, frames."""
    id_at, text_at = resolved(df, id_col), resolved(df, text_col)
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    slim = flat.select(F.col(f"c{id_at}").alias("id"), F.col(f"c{text_at}").cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", slim.schema["id"].dataType), T.StructField("n", T.LongType()),
                           T.StructField("marked", T.BooleanType()), T.StructField("starts", T.ArrayType(T.LongType())),
                           T.StructField("frames", T.ArrayType(T.BinaryType()))])

    def run(batches):
        import zstandard
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            first, size, cols = 0, 0, ([], [], [], [])

            def slab(end):
                arrays = [batch.column(0).slice(first, end - first)] + [
                    pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.binary())))]
                return pa.RecordBatch.from_arrays(arrays, schema.names)

            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                store = Frames.of(text, compress, units)
                for c, v in zip(cols, (len(store), any(m in text for m in (PREFIX, SUFFIX, MIDDLE)), store.starts, store.frames)):
                    c.append(v)
                size += sum(map(len, store.frames))
                if size >= SLAB_BYTES:
                    yield slab(i + 1)
                    first, size, cols = i + 1, 0, ([], [], [], [])
            yield slab(batch.num_rows)

    return slim.mapInArrow(run, schema)


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", units: int = FRAME_UNITS,
                   output: str | None = None) -> DataFrame:
    """Per document: id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256, and the transformed text
    itself under the name ``output`` if given. The frame table is stored in the shared folder in between."""
    frames = stored(frame_table(df, id_col, text_col, units), "frames")
    keyed = frames.select("id", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("key"), "n", "marked", "starts", "frames")
    fields = [T.StructField("id", keyed.schema["id"].dataType), T.StructField("n", T.LongType()),
              T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
              T.StructField("middle_chars", T.LongType()), T.StructField("output_sha256", T.StringType()),
              T.StructField("restored_sha256", T.StringType())]
    if output is not None:
        fields.append(T.StructField("output", T.StringType()))
    with_text = output is not None

    def digest(parts: Iterable[bytes]) -> str:
        sha = hashlib.sha256()
        for part in parts:
            sha.update(part)
        return sha.hexdigest()

    def run(batches):
        import zstandard
        compress, decompress = zstandard.ZstdCompressor(level=LEVEL).compress, zstandard.ZstdDecompressor().decompress
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()] + [pa.string()] * with_text
        for batch in batches:
            first, size, cols = 0, 0, tuple([] for _ in types)

            def slab(end):
                arrays = [batch.column(0).slice(first, end - first), batch.column(2).slice(first, end - first)]
                return pa.RecordBatch.from_arrays(arrays + [pa.array(c, t) for c, t in zip(cols, types)], [f.name for f in fields])

            for i in range(batch.num_rows):
                n = batch.column(2)[i].as_py()
                store = Frames(batch.column(5)[i].as_py(), batch.column(4)[i].as_py())
                form, a, b = (PLAIN, 0, 0) if not n or batch.column(3)[i].as_py() else cuts(n, batch.column(1)[i].as_py())
                out = arranged(store, form, a, b, compress, decompress)
                row = [form, None if form == PLAIN else a, None if form == PLAIN else b - a,
                       digest(out.read(0, len(out), decompress)), digest(restored(out, form, decompress))]
                if with_text:
                    row.append(b"".join(out.read(0, len(out), decompress)).decode())
                    size += len(row[-1])
                for c, v in zip(cols, row):
                    c.append(v)
                if size >= SLAB_BYTES:
                    yield slab(i + 1)
                    first, size, cols = i + 1, 0, tuple([] for _ in types)
            yield slab(batch.num_rows)

    done = keyed.mapInArrow(run, T.StructType(fields))
    return done.toDF(id_col, *[f.name for f in fields[1:7]], *([output] if with_text else []))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms, cuts and digests of all documents."""
    return fill_in_middle(documents(spark, sf_dir))


OP11_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT doc_id, t, n, CAST('0x' || substr(x, 1, 8) AS BIGINT) % (n + 1) AS c1,
             CAST('0x' || substr(x, 9, 8) AS BIGINT) % (n + 1) AS c2,
             CAST('0x' || substr(x, 17, 8) AS BIGINT) % 100 AS p3, CAST('0x' || substr(x, 25, 8) AS BIGINT) % 100 AS p4 FROM d),
f AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR p3 >= {PLAIN_FROM} THEN 'plain'
                  WHEN p4 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM h),
s AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1, n - b) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                   ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""

"""Sampled piece segmentations and lossless decoding (operator 2).

The text's segmentations into vocabulary pieces form a lattice; a segmentation has the product of its
pieces' weights as probability. Forward filtering sums the weights of all ways to reach each position;
backward sampling then draws the last piece in proportion, moves to its start, and so on, which draws whole
segmentations exactly by their probability. No piece holds a space mark after another character, so the
lattice splits exactly in front of each run of marks: a block's distinct units are filtered once, side by side, and sampled
for all their occurrences together. The random numbers are a hash of (seed, row key, position), so a row's sample
does not depend on partitions, order or retries.

Weights: the vocabulary holds no probabilities, only merge ranks; a piece of rank r weighs
(r + RANK_SHIFT) ** -ZIPF, and the byte fallback BYTE_WEIGHT a byte. ``temperature`` raises all weights to
its inverse. Characters without any piece, and those only, are written as byte pieces. The mark itself, where the text
holds it, is such a character, as its pieces stand for spaces: it becomes LITERAL, which no piece holds and no text can.

Defined results: null or empty text has no pieces; equal rows get equal samples; extra columns are ignored;
decoding gives the text back exactly (null as empty), spaces and line ends included.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.common import blocks, documents, give_back, mix64, resolved

MARK = "▁"  # written for a space
LITERAL = "\udc81"  # stands for a MARK of the text; a lone surrogate, so it is no character of any text
ZIPF, RANK_SHIFT, BYTE_WEIGHT = 1.0, 10.0, 1e-6
# Longer units are filtered one by one, shorter ones side by side.
LONG_UNIT = 64
# Text bytes whose lattice is held at once.
PIECE_BLOCK_BYTES = 1 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def load_pieces(path: str) -> tuple[dict[str, int], np.ndarray, int]:
    """Piece -> id (normal pieces only), log weight per id, and the id of byte 0."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    ids = {model.id_to_piece(i): i for i in range(n)
           if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
    first_byte = next(i for i in range(n) if model.is_byte(i))
    rank = np.arange(n) - first_byte - 256 + RANK_SHIFT
    weights = -ZIPF * np.log(np.maximum(rank, RANK_SHIFT))
    return ids, weights, first_byte


class Lattice:
    """Lattices of a block's units, filtered forward and kept as flat edge lists for backward sampling.

    Positions of a unit are 0..n; position p > 0 has edges (start, piece) with cumulative probabilities. All
    units' positions are numbered together: ``at[u] + p``.
    """

    def __init__(self, path: str, temperature: float = 1.0):
        self.path, self.temperature = path, temperature
        ids, logs, self.first_byte = load_pieces(path)
        scaled = np.exp(logs / temperature)
        self.weight = {piece: (i, float(scaled[i])) for piece, i in ids.items()}
        self.byte_weight = BYTE_WEIGHT ** (1 / temperature)
        self.longest = max(map(len, ids))
        self.power = np.cumprod(np.full(self.longest, GOLDEN)) * GOLDEN
        self.tables = {}  # by length: which hash prefixes occur, sorted hashes, ids, weights, characters
        for n in sorted({len(piece) for piece in ids}):
            same = [piece for piece in ids if len(piece) == n]
            chars = np.frombuffer("".join(same).encode("utf-32-le"), np.uint32).reshape(-1, n)
            hashes = (chars.astype(np.uint64) * self.power[n - 1::-1][:n]).sum(axis=1, dtype=np.uint64)
            order = np.argsort(hashes)
            found = np.array([ids[piece] for piece in same])[order]
            there = np.zeros(1 << 16, bool)
            there[hashes >> np.uint64(48)] = True
            self.tables[n] = (there, hashes[order], found, scaled[found], chars[order])

    def found(self, chars: list[np.ndarray], p: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Pieces that end at position ``p`` of the units that reach it: (length, unit, id, weight), long ones first."""
        m = len(chars[p - 1])
        h, out = np.zeros(m, np.uint64), []
        for n in range(1, min(p, self.longest) + 1):
            h = h + chars[p - n][:m] * self.power[n - 1]
            if n not in self.tables:
                continue
            there, hashes, ids, weights, letters = self.tables[n]
            unit = np.flatnonzero(there[h >> np.uint64(48)])
            at = np.minimum(np.searchsorted(hashes, h[unit]), len(hashes) - 1)
            same = hashes[at] == h[unit]
            unit, at = unit[same], at[same]
            same = np.ones(len(unit), bool)
            for j in range(n):
                same &= chars[p - n + j][unit] == letters[at, j]
            out.append((n, unit[same], ids[at[same]], weights[at[same]]))
        return out[::-1]

    def filter_short(self, size: np.ndarray, text: np.ndarray, first: np.ndarray) -> list[tuple]:
        """Forward filtering of units side by side, position by position. ``size``: characters, falling; ``text``:
        all characters; ``first``: number of each unit's position 0. alpha is kept as mantissa and exponent."""
        starts = np.cumsum(size) - size
        live = [int(np.searchsorted(-size, -p, "left")) for p in range(int(size[0]) if len(size) else 0)]
        chars = [text[starts[:m] + p] for p, m in enumerate(live)]
        alpha, power = [np.ones(len(size))], [np.zeros(len(size), np.int32)]
        out = []
        for p, m in enumerate(live, 1):
            edges = self.found(chars, p)
            single = np.zeros(m, bool)
            if edges and edges[-1][0] == 1:
                single[edges[-1][1]] = True
            odd = np.flatnonzero(~single)
            if len(odd):
                c = chars[p - 1][odd].astype(np.int64)
                width = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
                edges.append((1, odd, -1 - c, self.byte_weight ** width))
            unit = np.concatenate([e[1] for e in edges])
            order = np.argsort(unit, kind="stable")
            unit = unit[order]
            back = np.repeat([e[0] for e in edges], [len(e[1]) for e in edges])[order]
            code = np.concatenate([e[2] for e in edges])[order]
            share = np.concatenate([alpha[p - e[0]][e[1]] * e[3] for e in edges])[order]
            high = np.concatenate([power[p - e[0]][e[1]] for e in edges])[order]
            begin = np.searchsorted(unit, np.arange(m))  # each unit has an edge
            top = np.maximum.reduceat(high, begin)
            share = np.ldexp(share, high - top[unit])
            serial = np.arange(len(unit)) - begin[unit]
            run = share.copy()
            for k in range(1, int(serial.max()) + 1):
                here = np.flatnonzero(serial == k)
                run[here] += run[here - 1]
            total = run[np.append(begin[1:], len(unit)) - 1]
            mantissa, exponent = np.frexp(total)
            alpha.append(mantissa)
            power.append(top + exponent)
            out.append((first[unit] + p, serial.astype(np.int16), run / total[unit], share / total[unit], back.astype(np.int16), code.astype(np.int32)))
        return out

    def filter_long(self, unit: str, first: int) -> list[tuple]:
        """The same for a single long unit, one position after the other."""
        n, longest, weight = len(unit), self.longest, self.weight
        alpha, rows = [1.0], []
        for p in range(1, n + 1):
            total, edges = 0.0, []
            for s in range(max(0, p - longest), p):
                known = weight.get(unit[s:p])
                if known:
                    share = alpha[s] * known[1]
                    total += share
                    edges.append((share, p - s, known[0]))
            if not edges or edges[-1][1] != 1:
                c = unit[p - 1]
                share = alpha[p - 1] * self.byte_weight ** len(c.encode("utf-8", "surrogatepass"))
                total += share
                edges.append((share, 1, -1 - ord(c)))
            alpha.append(total)
            if total < 1e-100:  # only the last few positions are looked at again
                for s in range(max(0, p - longest), p + 1):
                    alpha[s] *= 1e100
            run = 0.0
            for k, (share, span, found) in enumerate(edges):
                run += share
                rows.append((first + p, k, run / total, share / total, span, found))
        kinds = (np.int64, np.int16, np.float64, np.float64, np.int16, np.int32)
        return [tuple(map(np.array, zip(*rows, strict=True), kinds))]

    def numbers(self, units: list[str]) -> np.ndarray:
        """Number of each unit; the distinct ones are filtered forward and replace those of the block before."""
        distinct = list(dict.fromkeys(units))
        size = np.fromiter(map(len, distinct), np.int64, len(distinct))
        order = np.argsort(-size, kind="stable")
        size = size[order]
        at = np.cumsum(size + 1) - size - 1
        long = int(np.searchsorted(-size, -LONG_UNIT, "left"))
        text = np.frombuffer("".join([distinct[i] for i in order[long:]]).encode("utf-32-le", "surrogatepass"), np.uint32)
        rows = [e for j in range(long) for e in self.filter_long(distinct[order[j]], int(at[j]))]
        rows += self.filter_short(size[long:], text, at[long:])
        rows = list(zip(*rows, strict=True)) if rows else [[np.zeros(0, np.int64)]] * 6
        place = np.concatenate(rows[0])
        bounds = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=int((size + 1).sum())))])
        to = bounds[place] + np.concatenate(rows[1])

        def laid_out(parts: list[np.ndarray]) -> np.ndarray:
            out = np.empty(len(to), parts[0].dtype)
            out[to] = np.concatenate(parts)
            return out

        # an edge's position plus its cumulative probability is one increasing key over all edges
        key = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) + np.minimum(laid_out(rows[2]), 1.0)
        flat = (key, laid_out(rows[4]), laid_out(rows[5]), np.log(np.maximum(laid_out(rows[3]), 1e-300)))
        self.arrays = (at, size, bounds, *flat)
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        if len(distinct) == len(units):
            return number
        known = dict(zip(distinct, number.tolist(), strict=True))
        return np.fromiter(map(known.__getitem__, units), np.int64, len(units))

    def sample(self, n: np.ndarray, key: np.ndarray, serial: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward sampling of all occurrences. ``n``: unit numbers; ``key``/``serial``: row key and number of the
        unit in its row. Returns (occurrence, piece code, log probability) in text order."""
        at, size, bounds, cum, back, piece, logp = self.arrays
        pos, first = size[n], at[n]
        live = np.flatnonzero(pos > 0)
        state = mix64(key + (serial.astype(np.uint64) + np.uint64(1)) * GOLDEN)
        times = np.zeros(len(n), np.int64)
        steps = []
        while len(live):
            here = pos[live]
            p = first[live] + here
            draw = mix64(state[live] + here.astype(np.uint64) * GOLDEN)
            uniform = (draw >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
            edge = np.searchsorted(cum, p + uniform, "right")
            edge = np.clip(edge, bounds[p], bounds[p + 1] - 1)  # rounding of the sum must not leave the position
            steps.append((live, edge))
            times[live] += 1
            here = here - back[edge]
            pos[live] = here
            live = live[here > 0]
        ends = np.cumsum(times)
        edges = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        for k, (live, edge) in enumerate(steps):  # drawn from the end: step k is the k-th last piece
            edges[ends[live] - 1 - k] = edge
        return np.repeat(np.arange(len(n)), times), piece[edges].astype(np.int64), logp[edges]


UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def split_units(text: str) -> list[str]:
    """Units in whose front every segmentation has a boundary. A space mark opens the text."""
    return UNIT.findall(MARK + text.replace(MARK, LITERAL).replace(" ", MARK)) if text else []


def unit_table(text: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct units of texts, the unit of each occurrence, and the number of occurrences per text."""
    single = pc.invert(pc.or_(pc.match_substring(text, "  "), pc.or_(pc.starts_with(text, " "), pc.ends_with(text, " "))))
    if pc.all(single).as_py() is not False and not pc.any(pc.match_substring(text, MARK)).as_py():
        parts = pc.split_pattern(text, " ")  # one unit per word
        counts = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.dictionary_encode(parts.flatten())
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        empty = pc.equal(text, "").to_numpy(zero_copy_only=False)
        if empty.any():
            codes = codes[~np.repeat(empty, counts)]
            counts = np.where(empty, 0, counts)
        return [MARK + w for w in coded.dictionary.to_pylist()], codes, counts
    rows = [split_units(t) for t in text.to_pylist()]
    number: dict[str, int] = {}
    codes = np.array([number.setdefault(u, len(number)) for r in rows for u in r], np.int64)
    return list(number), codes, np.array([len(r) for r in rows], np.int64)


def spread_bytes(who: np.ndarray, codes: np.ndarray, first_byte: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of characters without a piece (negative) replaced by the ids of their UTF-8 bytes."""
    odd = np.flatnonzero(codes < 0)
    if not len(odd):
        return who, codes
    data = [chr(-1 - int(c)).replace(LITERAL, MARK).encode() for c in codes[odd]]
    times = np.ones(len(codes), np.int64)
    times[odd] = [len(d) for d in data]
    out = np.repeat(codes, times)
    out[np.repeat(codes < 0, times)] = first_byte + np.frombuffer(b"".join(data), np.uint8).astype(np.int64)
    return np.repeat(who, times), out


class Decoder:
    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        table = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else
                 model.id_to_piece(i).replace(MARK, " ").encode() for i in range(model.get_piece_size())]
        self.bounds = np.concatenate([[0], np.cumsum([len(t) for t in table])])
        self.data = np.frombuffer(b"".join(table), np.uint8)

    def __call__(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """UTF-8 texts of rows ids[bounds[i]:bounds[i + 1]], without the mark that opens each."""
        size = np.diff(self.bounds)[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        flat = self.data[np.repeat(self.bounds[:-1][ids] - ends[:-1], size) + np.arange(int(ends[-1]))]
        at = ends[bounds]
        return [flat[a + 1:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


def sample_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None,
                  seed: int = 7, temperature: float = 1.0, decoded: bool = False) -> DataFrame:
    """Columns id, ids (sampled piece ids), logprob (of the segmentation given the text); with ``decoded`` also decoded_crc32
    and decoded_chars of the text that the ids give back, block by block in the same task."""
    if model_path is None:
        import public_tokenizers
        model_path = public_tokenizers.path("piece_bpe_32k.model")
    id_at, text_at = resolved(df, id_col), resolved(df, text_col)
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    slim = flat.select(F.col(f"c{id_at}").alias("id"), F.col(f"c{text_at}").cast("string").alias("text"),
                       F.xxhash64(F.lit(seed), F.col(f"c{id_at}").cast("string")).alias("key"))
    schema = T.StructType([T.StructField("id", slim.schema["id"].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("logprob", T.DoubleType())]
                          + [T.StructField(n, T.LongType()) for n in ("decoded_crc32", "decoded_chars") if decoded])

    def run(batches):
        lattice = Lattice(model_path, temperature)
        decode = Decoder(model_path) if decoded else None
        for batch in batches:
            text = pc.fill_null(batch.column(1), "")
            keys = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint64)
            for lo, hi in blocks(text, PIECE_BLOCK_BYTES):
                units, which, counts = unit_table(text.slice(lo, hi - lo))
                doc = np.repeat(np.arange(hi - lo), counts)
                serial = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                numbers = lattice.numbers(units)[which] if len(which) else which
                who, codes, logs = lattice.sample(numbers, keys[lo:hi][doc], serial)
                logprob = np.bincount(doc[who], logs, minlength=hi - lo)
                who, codes = spread_bytes(who, codes, lattice.first_byte)
                bounds = np.concatenate([[0], np.cumsum(np.bincount(doc[who], minlength=hi - lo))])
                arrays = [batch.column(0).slice(lo, hi - lo),
                          pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(codes, pa.int32())), pa.array(logprob + 0.0)]
                if decoded:
                    texts = decode(codes, bounds)
                    arrays += [pa.array([zlib.crc32(t) for t in texts], pa.int64()),
                               pc.utf8_length(pa.array(texts, pa.binary()).view(pa.string())).cast(pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)
        give_back()

    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode_pieces(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model_path: str | None = None) -> DataFrame:
    """Columns id, text: the exact text of piece ids (null ids: empty)."""
    if model_path is None:
        import public_tokenizers
        model_path = public_tokenizers.path("piece_bpe_32k.model")
    slim = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    schema = T.StructType([T.StructField("id", slim.schema["id"].dataType), T.StructField("text", T.StringType())])

    def run(batches):
        decode = Decoder(model_path)
        for batch in batches:
            bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(batch.column(1)), 0)
                                                    .to_numpy(zero_copy_only=False))])
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            texts = [t.decode() for t in decode(flat, bounds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op2_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document and the CRC-32 of the text decoded from it again."""
    found = sample_pieces(documents(spark, sf_dir), decoded=True)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "logprob", "ids", "decoded_crc32", "decoded_chars")

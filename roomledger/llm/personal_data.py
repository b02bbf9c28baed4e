"""Personal data by patterns and a semi-Markov conditional random field (operator 6).

Patterns give the base spans of four kinds. The field adds spans the patterns do not reach (other separators,
missing country codes, masked signs). It runs on islands: stretches of words that hold a digit, an at sign or a masked
one ("(at)", "[at]"), one space apart; where a masked sign opens or ends its word, the word one space beside it belongs
to the island too. An island is cut into units (digit runs, letter runs, single signs); a segmentation labels
each unit as outside or groups up to MAX_UNITS units as an entity of a kind. Features look at the whole
candidate span (digits, groups, signs, checksum, borders, context). Viterbi over segments picks boundaries and kinds
jointly. Candidates are segments of islands; a candidate holds digits or a sign, so text without either has none.

Training (exact segment log-likelihood, forward-backward) uses a bounded sample: islands of at most
SAMPLE_DOCS documents, the base spans being the labels, and copies of these with the entity rewritten in ways
the patterns miss. Islands that hold a masked sign already are left out, as no pattern labels them. Added spans never
overlap base spans.

Defined results: null or empty text has no spans (the digest of the empty list); repeated rows get equal results; a
table without any base span adds none; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.common import bounded_sample, documents, map_text

KINDS = ("email", "ip", "card", "phone")
MAX_UNITS, MAX_WORD = 24, 64
SAMPLE_DOCS, SAMPLE_CHARS, EPOCHS, RATE = 1500, 20_000, 12, 0.15
# Log odds by which an added segmentation must beat the one without entities.
MARGIN = 2.0

AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all base spans, sorted by start and kind.

    An address is found by its at sign: its local part is the whole run of allowed characters in front of
    it, as far as the preceding address, which is what the leftmost match of the pattern takes.
    """
    found = []
    last = 0
    if "@" in text:
        for m in AT.finditer(text):
            s = m.start()
            while s > last and text[s - 1] in LOCAL:
                s -= 1
            if s < m.start():
                found.append((s, 0, m.end()))
                last = m.end()
    if text.count(".") >= 3:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = only_digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(only_digits(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(s, KINDS[k], e) for s, k, e in sorted(found)]


# ---- islands, units, candidate segments ----------------------------------------------------------------------

SPACES = frozenset(" \t\n\x0b\x0c\r")
BLANKS = SPACES | {""}
UNIT = re.compile(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]")
BLANK = re.compile(r"[\x20\x09-\x0D]")


def islands(text: str) -> list[tuple[int, int]]:
    """Stretches of words that hold a digit or an at sign (plain or masked), one space apart, with the words beside
    a masked sign. A word's part more than MAX_WORD characters in front of its first such sign is left out (no entity
    is that long)."""
    out: list[list[int]] = []
    at, n = 0, len(text)
    while m := TRIGGER.search(text, at):
        s, floor = m.start(), out[-1][1] if out else 0
        if m.end() - s > 1 and s - 1 > floor and text[s - 1] == " " and text[s - 2] not in SPACES:
            s -= 1
        low = max(floor, s - MAX_WORD)
        while s > low and text[s - 1] not in SPACES:
            s -= 1
        stop = BLANK.search(text, m.end())
        e = stop.start() if stop else n
        while MASKED.fullmatch(text, e - 4, e) and text[e:e + 1] == " " and text[e + 1:e + 2] not in BLANKS:
            stop = BLANK.search(text, e + 1)
            e = stop.start() if stop else n
        if out and s - out[-1][1] <= 1 and text[out[-1][1]:s] in ("", " "):
            out[-1][1] = e
        else:
            out.append([s, e])
        at = e
    return [(s, e) for s, e in out]


def bucket(n: int, bounds: tuple[int, ...]) -> int:
    return sum(n >= b for b in bounds)


def border(c: str) -> int:
    return 0 if not c or c in SPACES else 1 if c.isdigit() else 2 if c.isalpha() else 3 if c in "@._%+-" else 4


# Numbers of values of each feature of a segment, in the order of :func:`features`.
SIZES = (12, 3, 5, 6, 4, 3, 2, 2, 6, 5, 3, 4, 3, 3, 5, 5, 2, 12 * 8)
OFFSETS = np.concatenate([[0], np.cumsum(SIZES)])
GROUP = re.compile(r"[0-9]+")
MASKED = re.compile(r"[(\[]at[)\]]")
ENDING = re.compile(r"\.[A-Za-z]{2,24}$")


def features(text: str, s: int, e: int) -> list[int]:
    """Whole-span features of text[s:e] as indices into the weights."""
    span = text[s:e]
    groups = GROUP.findall(span)
    digits = "".join(groups)
    letters = sum(c.isalpha() for c in span)
    dots, dashes, blanks = span.count("."), span.count("-"), span.count(" ")
    n = bucket(len(digits), (1, 4, 7, 8, 10, 11, 12, 13, 14, 17, 20))
    masked = bool(MASKED.search(span))
    first, last = span[0], span[-1]
    values = (
        n, min(span.count("@") + masked, 2), min(dots, 4),
        0 if first == "+" else 1 if first == "(" else 2 if first.isdigit() else 3 if first.isalpha() else 4 if first in "._%" else 5,
        0 if last.isdigit() else 1 if last.isalpha() else 2 if last == ")" else 3,
        bucket(letters, (1, 6)), int(masked), int(bool(ENDING.search(span))),
        min(len(groups), 5), bucket(max(map(len, groups), default=0), (1, 4, 5, 13)),
        0 if not groups else 1 if all(len(g) <= 3 and int(g) <= 255 for g in groups) else 2,
        0 if len(digits) < 14 or len(digits) > 19 else 1 if luhn(digits) else 2, bucket(dashes, (1, 2)), bucket(blanks, (1, 3)),
        border(text[s - 1:s]), border(text[e:e + 1]), int(len(set(map(len, groups))) <= 1),
        n * 8 + min(len(groups), 3) * 2 + (letters > 0))
    return [int(o) + v for o, v in zip(OFFSETS, values, strict=False)]


WIDTH = int(OFFSETS[-1]) + 1  # the last one is the bias


def segments(text: str, s: int, e: int):
    """Unit by unit of an island: the end of the unit and the candidate segments there, (units back, start, features).

    A candidate holds four digits or more, or a whole at sign (plain or masked), at least a digit or letter at its
    ends or an opening sign, and no line end. Only the last MAX_UNITS units are held, so an island of any length
    takes time in proportion and memory of a constant size.
    """
    recent: deque = deque(maxlen=MAX_UNITS)  # (start, good start, digits, unit at whose end a sign from here is whole)
    for j, m in enumerate(UNIT.finditer(text, s, e), 1):
        unit, at = m.group(), m.start()
        whole = j if unit == "@" else j + 2 if unit in "([" and MASKED.match(text, at, e) else None
        recent.append((at, unit[0].isalnum() or unit in "+(_%", len(unit) if unit[0].isdigit() else 0, whole))
        here = []
        if unit[-1].isalnum() or unit == ")":
            digits, sign = 0, False
            for back, (start, good, number, at_sign) in enumerate(reversed(recent), 1):
                digits += number
                sign = sign or (at_sign is not None and at_sign <= j)
                if good and (digits >= 4 or sign):
                    here.append((back, start, [*features(text, start, m.end()), WIDTH - 1]))
        yield m.end(), here


def candidates(text: str, s: int, e: int) -> tuple[list[int], list[list[tuple[int, list[int]]]]]:
    """Unit bounds of an island and, for each unit end, the candidate segments (first unit, features) there; for the
    short islands of the training sample, which forward-backward reads twice."""
    bounds, out = [s], [[]]
    for j, (end, here) in enumerate(segments(text, s, e), 1):
        bounds.append(end)
        out.append([(j - back, f) for back, _, f in here])
    return bounds, out


class Field:
    """Semi-Markov field over the segments of an island; unlabelled units score nothing."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def scores(self, segs: list[tuple[int, list[int]]]) -> np.ndarray:
        return self.weights[np.array([f for _, f in segs])].sum(axis=1)

    def best(self, text: str, s: int, e: int) -> list[tuple[int, str, int]]:
        """Viterbi: (start, kind, end) of the entities of the best segmentation, if it is MARGIN better than
        none and all of its entities pay."""
        top = deque([0.0], maxlen=MAX_UNITS + 1)  # best scores up to the last unit ends, latest last
        chosen: dict[int, tuple[int, int, int, int]] = {}  # unit end: (first unit, kind, start, end)
        j = 0
        for end, here in segments(text, s, e):
            j += 1
            best = top[-1]
            if here:
                table = self.scores([(back, f) for back, _, f in here]) - MARGIN
                total = table.max(axis=1) + np.array([top[-back] for back, _, _ in here])
                k = int(total.argmax())
                if total[k] > best:
                    best = float(total[k])
                    chosen[j] = (j - here[k][0], int(table[k].argmax()), here[k][1], end)
            top.append(best)
        found = []
        while j > 0:
            if j in chosen:
                j, kind, start, end = chosen[j]
                found.append((start, KINDS[kind], end))
            else:
                j -= 1
        return found[::-1]

    def gradient(self, ends: list, gold: dict[tuple[int, int], int]) -> np.ndarray:
        """Derivative of the log-likelihood of the gold entities ({(first unit, end unit): kind})."""
        n = len(ends) - 1
        grad = np.zeros_like(self.weights)
        tables = [self.scores(x) if x else None for x in ends]
        alpha = np.full(n + 1, -np.inf)
        alpha[0] = 0.0
        for j in range(1, n + 1):
            terms = [np.array([alpha[j - 1]])]
            if ends[j]:
                terms.append((tables[j] + alpha[[i for i, _ in ends[j]]][:, None]).ravel())
            terms = np.concatenate(terms)
            alpha[j] = terms.max() + np.log(np.exp(terms - terms.max()).sum())
        beta = np.full(n + 1, -np.inf)
        beta[n] = 0.0
        for j in range(n, 0, -1):
            beta[j - 1] = np.logaddexp(beta[j - 1], beta[j])
            for row, (i, _) in enumerate(ends[j]):
                beta[i] = np.logaddexp(beta[i], beta[j] + np.logaddexp.reduce(tables[j][row]))
        for j in range(1, n + 1):
            for row, (i, f) in enumerate(ends[j]):
                share = -np.exp(alpha[i] + tables[j][row] + beta[j] - alpha[n])
                kind = gold.get((i, j))
                if kind is not None:
                    share[kind] += 1
                grad[f] += share
        return grad


def rewrites(span: str, kind: str, rng: np.random.Generator) -> str:
    """The entity in a form that the patterns miss."""
    pick = int(rng.integers(3))
    if kind == "email":
        return span.replace("@", ("(at)", "[at]", " [at] ")[pick])
    if kind == "ip":
        return span.replace(".", ("[.]", "(.)", "[.]")[pick])
    digits = only_digits(span)
    if kind == "card":
        return ("." if pick else "_").join(digits[i:i + 4] for i in range(0, len(digits), 4))
    local = digits[-10:]
    return (f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}-{local[3:6]}-{local[6:]}",
            f"{local[:3]}.{local[3:6]}.{local[6:]}")[pick]


def fit(texts: list[str], seed: int = 9, per_kind: int = 150, outside: int = 300) -> np.ndarray | None:
    """Weights of the field, or None when the sample holds no base span."""
    rng = np.random.default_rng(seed)
    cases, taken = [], dict.fromkeys((*KINDS, None), 0)
    for text in texts:
        if not TRIGGER.search(text):
            continue
        spans = base_spans(text)
        for s, e in islands(text):
            if MASKED.search(text, s, e):
                continue
            inner = [x for x in spans if s <= x[0] and x[2] <= e]
            kind = inner[0][1] if inner else None
            if e - s > 400 or taken[kind] >= (per_kind if kind else outside):
                continue
            taken[kind] += 1
            left, right = text[max(0, s - 12):s], text[e:e + 12]
            for changed in (False, True) if inner else (False,):
                out, gold, at = left, [], s
                for a, k, b in inner:
                    if a < at:
                        continue
                    new = rewrites(text[a:b], k, rng) if changed else text[a:b]
                    out += text[at:a]
                    gold.append((len(out), k, len(out) + len(new)))
                    out, at = out + new, b
                out += text[at:e]
                cases.append((out + right, len(left), len(out), gold))
    if not sum(taken[k] for k in KINDS):
        return None
    for _ in range(per_kind // 5):  # dates, times, amounts and versions are outside
        y, m, d, h, w, n = (int(rng.integers(a, b)) for a, b in ((1900, 2100), (1, 13), (1, 29), (0, 24), (0, 60), (10**3, 10**9)))
        for other in (f"{y}-{m:02}-{d:02}", f"{y}-{m:02}-{d:02} {h:02}:{w:02}:{w:02}", f"{d:02}.{m:02}.{y}", f"{m}/{d}/{y}",
                      f"{n:,}.{w:02}", f"{n}", f"{m}.{d}.{h}", f"{y}-{y + m}", f"{h:02}:{w:02} {d}.{m}.{y}"):
            cases.append((f"on {other} in", 3, 3 + len(other), []))
    prepared = []
    for text, s, e, gold in cases:
        bounds, ends = candidates(text, s, e)
        place = {b: i for i, b in enumerate(bounds)}
        prepared.append((ends, {(place[a], place[b]): KINDS.index(k) for a, k, b in gold if a in place and b in place}))
    field = Field(np.zeros((WIDTH, len(KINDS))))
    field.weights[-1] = -3.0
    square = np.full_like(field.weights, 1e-6)
    for _ in range(EPOCHS):
        order = rng.permutation(len(prepared))
        for k in range(0, len(order), 16):
            grad = sum(field.gradient(*prepared[i]) for i in order[k:k + 16]) - 0.01 * field.weights
            square += grad * grad
            field.weights += RATE * grad / np.sqrt(square + 1)
    return field.weights


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def all_spans(text: str, field: Field | None) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """Base spans, and base spans with what the field adds."""
    if not TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    if field is None:
        return base, base
    covers = sorted((s, e) for s, _, e in base)
    added = []
    for s, e in islands(text):
        inside = [(a, b) for a, b in covers if a < e and s < b]
        # what base spans leave of the island is decoded; parts of theirs are not candidates
        for a, b in zip([s, *[x[1] for x in inside]], [*[x[0] for x in inside], e], strict=True):
            if b - a >= 4:
                added += field.best(text, a, b)
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted([*base, *added], key=lambda x: (x[0], order[x[1]], x[2]))


FIELDS = [*[(f"n_{k}", T.LongType()) for k in KINDS], ("base_sha256", T.StringType()), ("spans", T.StringType()),
          ("n_added", T.LongType())]


def find_personal_data(docs: DataFrame, keep: list[str] | None, text_col: str = "text", id_col: str = "doc_id",
                       redacted: str | None = None) -> DataFrame:
    """Counts, base digest and spans beside the ``keep`` columns (None: all); with ``redacted``, only that column:
    the text with each span replaced by its kind in angle brackets (null stays null)."""
    sample = bounded_sample(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        F.col("text").rlike("[0-9@]")), "id", "text", SAMPLE_DOCS, SAMPLE_CHARS)
    weights = fit([r[0] for r in sample.orderBy("id", "text").limit(2 * SAMPLE_DOCS).select("text").collect()])
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        field = Field(sent.value) if sent.value is not None else None

        def spans(text: pa.Array) -> list:
            rows = [all_spans(t, field) for t in pc.fill_null(text, "").to_pylist()]
            counts = [pa.array([sum(x[1] == k for x in base) for base, _ in rows], pa.int64()) for k in KINDS]
            return [*counts, pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows]),
                    pa.array([joined(both) for _, both in rows]), pa.array([len(both) - len(base) for base, both in rows], pa.int64())]

        def redact(text: pa.Array) -> list:
            return [pa.array([None if t is None else without(t, all_spans(t, field)[1]) for t in text.to_pylist()], pa.string())]

        return redact if redacted else spans

    return map_text(docs, text_col, keep, [(redacted, T.StringType())] if redacted else FIELDS, make)


def without(text: str, spans: list[tuple[int, str, int]]) -> str:
    """``text`` with spans replaced by their kind; overlapping spans are replaced as one, by the first one's kind."""
    out, at, merged = [], 0, []
    for s, k, e in spans:
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([s, k, e])
    for s, k, e in merged:
        out += [text[at:s], f"<{k.upper()}>"]
        at = e
    return "".join([*out, text[at:]])


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in all documents."""
    return find_personal_data(documents(spark, sf_dir), ["doc_id"])

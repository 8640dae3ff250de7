"""Personal data: fixed patterns and a semi-Markov conditional random field.

The patterns find mail addresses, IP addresses, card and phone numbers. The model scores whole candidate segments: a text
is cut into atoms (runs of letters and digits, single other characters), a segment is up to ``MOST_ATOMS`` atoms with
a type, and its features describe the segment as a whole (shape, digit count, checksum, octets, gaps, neighbours).
Dynamic programming over the end positions chooses boundaries and types together; training maximises the conditional
likelihood by the forward-backward recursion over segments. Only surroundings of digits and ``@`` are decoded, since a
segment must hold one of them: elsewhere "no entity" is the only path.

Labels come from the patterns, on a bounded sample of rows (``TRAIN_ROWS``, a parameter, in the order of a hash of
id and text, whole lines of theirs); everything else covers all rows and whole texts. A model span is added where it touches no pattern span and
its posterior log-odds against "no entity" reach ``LEAST_ODDS``. Spans are in code points. Null and empty texts have no
spans; rows are independent, repeated rows repeat their spans. Only the id and the text are read.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm import spans as sp
from floodmark.llm.textscan import CodePoints, blocks, byte_class, owner, utf8

NAME = "op9_personal_data"
SQL = None
KINDS = ("email", "ip", "card", "phone")
OUTSIDE = "none"
TRAIN_ROWS = 3000
#: Atoms of a training lattice, about (longer ones are cut), and candidate segments of all that train.
TRAIN_ATOMS, TRAIN_SEGMENTS = 400, 100_000
EPOCHS, RATE, DECAY = 4, 0.3, 1e-4
MOST_ATOMS = 16
#: Characters decoded around a digit or @.
MARGIN = 48
LEAST_ODDS = 3.0

# possessive parts and look-behinds keep long runs linear; the matches are those of the plain patterns
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ATOM = re.compile(r"[A-Za-z0-9]+|[^\sA-Za-z0-9]")
_HIT = byte_class("@0123456789")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str) -> list[sp.Span]:
    """Pattern spans by kind, then start."""
    found, last = [], 0
    for m in DOMAIN.finditer(text) if "@" in text else ():
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            found.append(("email", start, m.end()))
            last = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if 13 <= len(m[0]) <= 40:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            found.append(("phone", *m.span()))
    return found


def atom_class(atom: str) -> str:
    if not atom.isascii():
        return "u"
    if atom.isdigit():
        return f"d{min(len(atom), 8)}"
    if atom.isalpha():
        return "a"
    return "x" if atom.isalnum() else atom


class Lattice:
    """Atoms of a stretch of text and the candidate segments over them."""

    def __init__(self, text: str, start: int, end: int):
        self.text = text
        self.atoms = [(m.start(), m.end()) for m in ATOM.finditer(text, start, end)]
        self.classes = [atom_class(text[s:e]) for s, e in self.atoms]
        self.key = [c[0] in "dx@" for c in self.classes]
        self.edge = [c[0] in "dxa" for c in self.classes]

    def candidates(self, i: int) -> Iterator[int]:
        """Ends (exclusive) of the segments from atom ``i``: they hold a digit or @ and no wide gap."""
        if not (self.edge[i] or self.classes[i] in "+("):
            return
        holds = False
        for j in range(i, min(i + MOST_ATOMS, len(self.atoms))):
            if j > i and self.atoms[j][0] - self.atoms[j - 1][1] > 1:
                return
            holds = holds or self.key[j]
            if holds and self.edge[j]:
                yield j + 1

    def features(self, i: int, j: int) -> tuple[str, ...]:
        """Features of the whole segment."""
        start, end = self.atoms[i][0], self.atoms[j - 1][1]
        span = self.text[start:end]
        digits = re.sub("[^0-9]", "", span)
        gaps = span.count(" ")
        shape = "".join(self.classes[i:j])
        before = self.classes[i - 1][0] if i and self.atoms[i - 1][1] == start else "_"
        after = self.classes[j][0] if j < len(self.atoms) and self.atoms[j][0] == end else "_"
        letters = any(c[0] in "ax" for c in self.classes[i:j])
        n, at = len(digits), span.count("@")
        parts = span.split(".")
        octets = len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
        return (
            "bias",
            f"shape={re.sub('[0-9]', '', shape)[:24]}",
            f"digits={min(n, 20)}/{int(letters)}",
            f"at={at}/{int(gaps > 0)}",
            f"at={at}/dots={min(span.count('.'), 4)}/{int(span[at and span.rfind('@'):].count('.') > 0)}",
            f"luhn={int(13 <= n <= 19 and not letters and luhn(digits))}",
            f"octets={int(octets)}",
            f"plus={int(span[0] == '+')}/{int(9 <= n <= 15)}/{int(letters)}",
            f"before={before}",
            f"after={after}",
            f"gaps={min(gaps, 4)}/{int(letters)}",
            f"first={self.classes[i][0]}",
        )


class SpanModel:
    """Weights per (kind, feature); "no entity" is one atom long and scores 0."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = defaultdict(float, weights or {})
        self.memo: dict[tuple[str, ...], tuple[float, ...]] = {}

    def scores(self, features: tuple[str, ...]) -> tuple[float, ...]:
        found = self.memo.get(features)
        if found is None:
            found = tuple(sum(self.weights.get((k, f), 0.0) for f in features) for k in KINDS)
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[features] = found
        return found

    def segments(self, lattice: Lattice) -> list[list[tuple[int, tuple[str, ...], tuple[float, ...]]]]:
        out = []
        for i in range(len(lattice.atoms)):
            feats = [(j, lattice.features(i, j)) for j in lattice.candidates(i)]
            out.append([(j, f, self.scores(f)) for j, f in feats])
        return out

    def decode(self, lattice: Lattice) -> list[tuple[str, int, int, float]]:
        """Best segmentation: kind, first atom, end atom, log-odds of each entity against no entity there.

        Segments are looked at once, from left to right; only a score and a back-pointer per atom are kept.
        """
        n = len(lattice.atoms)
        best, back = [0.0] + [-math.inf] * n, [None] * (n + 1)
        for i in range(n):
            if best[i] > best[i + 1]:
                best[i + 1], back[i + 1] = best[i], None
            for j in lattice.candidates(i):
                for kind, s in zip(KINDS, self.scores(lattice.features(i, j))):
                    if best[i] + s > best[j]:
                        best[j], back[j] = best[i] + s, (i, kind, s)
        out, at = [], n
        while at:
            if back[at] is None:
                at -= 1
                continue
            i, kind, s = back[at]
            out.append((kind, i, at, s))
            at = i
        return out[::-1]

    def fit(self, lattices: list[tuple[Lattice, dict[tuple[int, int], str]]]) -> None:
        """Stochastic ascent on the conditional log-likelihood of the labelled segmentations (AdaGrad)."""
        squares: dict[tuple[str, str], float] = defaultdict(float)
        for _ in range(EPOCHS):
            for lattice, labels in lattices:
                self.memo.clear()
                for key, g in self._gradient(lattice, labels).items():
                    g -= DECAY * self.weights[key]
                    squares[key] += g * g
                    self.weights[key] += RATE * g / math.sqrt(squares[key] + 1e-8)
        self.memo.clear()

    def _gradient(self, lattice: Lattice, labels: dict[tuple[int, int], str]) -> dict[tuple[str, str], float]:
        n, segments = len(lattice.atoms), self.segments(lattice)
        forward, backward = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
        for i in range(n):
            forward[i + 1] = _logadd(forward[i + 1], forward[i])
            for j, _, scores in segments[i]:
                for s in scores:
                    forward[j] = _logadd(forward[j], forward[i] + s)
        for i in reversed(range(n)):
            total = backward[i + 1]
            for j, _, scores in segments[i]:
                for s in scores:
                    total = _logadd(total, backward[j] + s)
            backward[i] = total
        out: dict[tuple[str, str], float] = defaultdict(float)
        for i in range(n):
            for j, features, scores in segments[i]:
                label = labels.get((i, j))
                for kind, s in zip(KINDS, scores):
                    g = float(kind == label) - math.exp(min(0.0, forward[i] + s + backward[j] - forward[n]))
                    if abs(g) > 1e-4:
                        for f in features:
                            out[kind, f] += g
        return out


def _logadd(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def stretches(text: str, hits: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of the text around the hits (sorted code points), widened to white space where it is near."""
    if not len(hits):
        return
    for group in np.split(hits, np.flatnonzero(np.diff(hits) > 2 * MARGIN) + 1):
        start, end = max(0, int(group[0]) - MARGIN), min(len(text), int(group[-1]) + 1 + MARGIN)
        left, right = text.rfind(" ", max(0, start - MARGIN), start), text.find(" ", end, end + MARGIN)
        yield left + 1 if left >= 0 else start, right if right >= 0 else end


def scanned(column: pa.Array) -> Iterator[tuple[str, np.ndarray]]:
    """Each text with the code points of its digits and @ signs."""
    data, offsets = utf8(column)
    at = np.flatnonzero(_HIT[data])
    rows = owner(at, offsets)
    points = CodePoints(data, offsets).of(at, rows)
    cuts = np.searchsorted(rows, np.arange(len(column) + 1))
    for k, text in enumerate(column.to_pylist()):
        yield text or "", points[cuts[k] : cuts[k + 1]]


def labelled(text: str, hits: np.ndarray) -> Iterator[tuple[Lattice, dict[tuple[int, int], str]]]:
    """Lattices of a text with the pattern spans as labels (those that end at atoms, without overlaps).

    A lattice over ``TRAIN_ATOMS`` atoms is cut into several between labels, so that all of it trains in bounded memory.
    """
    taken: list[tuple[int, int, str]] = []
    for kind, s, e in base_spans(text):
        at = bisect.bisect_left(taken, (s, e))
        if (not at or taken[at - 1][1] <= s) and (at == len(taken) or e <= taken[at][0]):
            taken.insert(at, (s, e, kind))
    for start, end in stretches(text, hits):
        own = taken[bisect.bisect_left(taken, (start,)) : bisect.bisect_left(taken, (end,))]
        atoms = [(m.start(), m.end()) for m in ATOM.finditer(text, start, end)]
        begin = 0
        while begin < len(atoms):
            stop = min(begin + TRAIN_ATOMS, len(atoms))
            if stop < len(atoms):  # not inside a label
                at = bisect.bisect_left(own, (atoms[stop][0],)) - 1
                while at >= 0 and stop < len(atoms) and own[at][1] > atoms[stop][0]:
                    stop += 1
            lattice = Lattice(text, atoms[begin][0], atoms[stop - 1][1])
            first, last = ({a[k]: i + k for i, a in enumerate(lattice.atoms)} for k in (0, 1))
            yield lattice, {(first[s], last[e]): k for s, e, k in own if s in first and e in last}
            begin = stop


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rows: int = TRAIN_ROWS, segments: int = TRAIN_SEGMENTS) -> SpanModel:
    """Fit on the ``rows`` documents with digits or @ that come first in the order of a hash of id and text (equal rows count once).

    Two passes choose them: one estimates how many there are, the next keeps those below a bound on the hash, some half more than
    wanted, of which an exact cut is taken. All lines of theirs with digits or @ are labelled; of their lattices those that come
    first in the order of a hash of what they hold train, about ``segments`` candidate segments, so that few very long texts do not
    set the time. The fit runs in one task; the driver gets the weights.
    """
    chosen = docs.select(F.xxhash64(F.lit(9), id_column, text_column).alias("_h"), F.col(text_column).alias("_text"))
    chosen = chosen.where(F.col("_text").rlike("[@0-9]"))
    found = chosen.agg(F.approx_count_distinct("_h")).first()[0]
    if found > 1.5 * rows:
        chosen = chosen.where(F.col("_h") < F.lit(int(1.5 * rows / found * 2.0**64) - (1 << 63)))
    sample = chosen.groupBy("_h").agg(F.min("_text").alias("_text")).orderBy("_h").limit(rows)
    lines = F.regexp_extract_all("_text", F.lit(r"([^\n]*[@0-9][^\n]*)"), F.lit(1))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: list[tuple[bytes, int, int, tuple]] = []  # a heap with the largest hash on top
        size = 0
        for number, x in enumerate(x for batch in batches for text, hits in scanned(batch.column(0)) for x in labelled(text, hits)):
            many = sum(1 for i in range(len(x[0].atoms)) for _ in x[0].candidates(i))
            hashed = hashlib.sha256(repr((x[0].classes, sorted(x[1].items()))).encode()).digest()
            heapq.heappush(drawn, (bytes(255 - b for b in hashed), number, many, x))
            size += many
            while size - drawn[0][2] >= segments:
                size -= heapq.heappop(drawn)[2]
        model = SpanModel()
        model.fit([x for *_, x in sorted(drawn, reverse=True) if x[0].atoms])
        weights = [(k, f, float(w)) for (k, f), w in model.weights.items()]
        columns = [pa.array([w[i] for w in weights], t) for i, t in enumerate((pa.string(), pa.string(), pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["kind", "feature", "weight"])

    fitted = sample.select(F.array_join(lines, "\n").alias("_lines")).coalesce(1).mapInArrow(fit, "kind string, feature string, weight double")
    return SpanModel({(r["kind"], r["feature"]): r["weight"] for r in fitted.collect()})


def spans_of(text: str, hits: np.ndarray, model: SpanModel) -> list[sp.Span]:
    """Pattern spans by kind and start, then what the model adds, by start."""
    if not len(hits):
        return []
    base = base_spans(text)
    order = sorted((s, e) for _, s, e in base)
    reach = list(accumulate((e for _, e in order), max))  # the furthest end of the pattern spans up to each
    more = []
    for start, end in stretches(text, hits):
        lattice = Lattice(text, start, end)
        for kind, i, j, odds in model.decode(lattice) if lattice.atoms else ():
            s, e = lattice.atoms[i][0], lattice.atoms[j - 1][1]
            before = bisect.bisect_left(order, (e,))
            if odds >= LEAST_ODDS and not (before and reach[before - 1] > s):
                more.append((f"model_{kind}", s, e))
    return base + more


def find(docs: DataFrame, model: SpanModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id`` and ``spans`` (kind, start, end) of every row."""
    narrow = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    weights = dict(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = SpanModel(weights)
        for part in blocks(batches, 1):
            rows = [
                [{"kind": k, "start": s, "end": e} for k, s, e in spans_of(text, hits, own)]
                for text, hits in scanned(part.column(1))
            ]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, kind)], ["_id", "spans"])

    return narrow.mapInArrow(run, f"_id {narrow.schema['_id'].dataType.simpleString()}, spans {sp.SPANS}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = F.filter("spans", lambda s: ~s["kind"].startswith("model_"))
    return sp.digest(find(docs, train(docs)), KINDS, base, F.col("spans"))

"""Secret scans: fixed patterns and a pair of character Markov models.

The patterns find assignments, access keys and long hexadecimal runs. Beyond them, every run of key characters is
scored by the log-likelihood ratio of two first-order Markov models over characters: random strings against ordinary
identifiers. Pattern spans are cut out of a run; what is left of it is scored piece by piece, and all its pieces together, so that
a key around a hexadecimal stretch goes with it. Both models are trained on labelled samples: the values (without their keywords)
that the patterns found in the corpus count as random (mixed with the uniform model, so that key alphabets without samples are
known too), runs that touch no pattern span as ordinary. The transition counts cover all documents; they are sums over the map side, 2 * 67 * 67 numbers in the end.

Spans are in code points. Null and empty texts have no spans; texts are scanned whole, in linear time; rows are
independent, so repeated rows repeat their spans and no key is grouped. Only the id and the text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm import spans as sp
from floodmark.llm.textscan import CodePoints, blocks, byte_class, owner, runs, utf8

NAME = "op8_secret_scan"
SQL = None
KINDS = ("assign", "access", "hex")
MARKOV = "random"
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile("AKIA[A-Z0-9]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Shortest runs that are scored and that train the ordinary model.
LEAST_SCORED, LEAST_TRAINED = 16, 6
#: Log-likelihood ratio, in nats, from which a run is a secret.
LEAST_RATIO = 20.0
#: Weight of the uniform model within the random model; pseudo-count per transition of the ordinary model.
UNIFORM, PSEUDO = 0.5, 0.5

_CODE = np.zeros(256, np.int64)
_CODE[list(ALPHABET.encode())] = np.arange(len(ALPHABET))
_TOKEN, _HEX = byte_class(ALPHABET), byte_class("0123456789abcdef")


def base_spans(text: str, lowered: bytes, hex_spans: list[tuple[int, int]]) -> list[sp.Span]:
    """Pattern spans by start, then kind. ``hex_spans``: hexadecimal runs that are long enough."""
    found = []
    if any(w in lowered for w in WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if b"akia" in lowered:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [("hex", *s) for s in hex_spans]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(column: pa.Array) -> Iterator[tuple[list[sp.Span], np.ndarray, list[tuple[int, int]]]]:
    """For each text: base spans, its runs of key characters as bytes positions and as code points."""
    data, offsets = utf8(column)
    points = CodePoints(data, offsets)
    found = []
    for mask, least in ((_HEX[data], LEAST_HEX), (_TOKEN[data], LEAST_TRAINED)):
        starts, ends = runs(mask, offsets, least)
        rows = owner(starts, offsets)
        cuts = np.searchsorted(rows, np.arange(len(column) + 1))
        found.append((starts, ends, points.of(starts, rows), points.of(ends, rows), cuts))
    lowered = data.tobytes().lower()
    for k, text in enumerate(column.to_pylist()):
        (_, _, hs, he, hc), (ts, te, ps, pe, tc) = found
        hexes = list(zip(hs[hc[k] : hc[k + 1]].tolist(), he[hc[k] : hc[k + 1]].tolist()))
        own = slice(tc[k], tc[k + 1])
        base = base_spans(text or "", lowered[offsets[k] : offsets[k + 1]], hexes)
        yield base, data, (ts[own], te[own], ps[own], pe[own])


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def _values(text: str, base: list[sp.Span]) -> list[tuple[int, int]]:
    """The pattern spans without the keywords of assignments, put together."""
    return _union([(ASSIGN.match(text, s, e).start(2), e) if kind == "assign" else (s, e) for kind, s, e in base])


def _pieces(spans: list[tuple[int, int]], runs_of: tuple[np.ndarray, ...], inside: bool) -> tuple[np.ndarray, ...]:
    """Parts of the runs inside (or outside) disjoint spans, as bytes and code points, with the run of each."""
    out: list[tuple[int, int, int, int, int]] = []
    ts, te, ps, pe = runs_of
    marks = [0, *(x for s in spans for x in s), int(pe.max(initial=0)) + 1] if not inside else [x for s in spans for x in s]
    for s, e in zip(marks[::2], marks[1::2]):
        for k in range(int(np.searchsorted(pe, s, "right")), int(np.searchsorted(ps, e, "left"))):
            a, b, shift = max(s, int(ps[k])), min(e, int(pe[k])), int(ts[k] - ps[k])  # runs are ASCII
            if a < b:
                out.append((a + shift, b + shift, a, b, k))
    return tuple(np.array([x[i] for x in out], np.int64) for i in range(5))


def _outside(base: list[sp.Span], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of the runs (code points) touch no base span."""
    free = np.ones(len(starts), bool)
    for _, s, e in base:
        free[np.searchsorted(ends, s, "right") : np.searchsorted(starts, e, "left")] = False
    return free


def _transitions(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Codes of the transitions inside the runs, run after run."""
    lengths = ends - starts - 1
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    return _CODE[data[at]] * len(ALPHABET) + _CODE[data[at + 1]]


def train(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Log-likelihood ratios (random over ordinary) of all transitions, from the labelled runs of every text."""
    size = len(ALPHABET)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size * size), np.int64)
        for part in blocks(batches, 0):
            plain, labelled = [], []
            for text, (base, data, own) in zip(part.column(0).to_pylist(), scan(part.column(0))):
                free = _outside(base, *own[2:])
                plain.append((own[0][free], own[1][free]))
                if base:
                    labelled.append(_pieces(_values(text, base), own, True)[:2])
            for row, chosen in enumerate((plain, labelled)):
                starts, ends = (np.concatenate([np.zeros(0, np.int64), *(c[k] for c in chosen)]) for k in (0, 1))
                if len(starts):
                    sums[row] += np.bincount(_transitions(data, starts, ends), minlength=size * size)
        which, pair = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(pair), pa.array(sums[which, pair])], ["kind", "pair", "n"])

    totals = np.zeros((2, size * size))
    counted = docs.select(text_column).mapInArrow(count, "kind long, pair long, n long")
    for r in counted.groupBy("kind", "pair").agg(F.sum("n").alias("n")).collect():  # at most 2 * 67 * 67 rows
        totals[r["kind"], r["pair"]] = r["n"]
    ordinary, random = totals.reshape(2, size, size)
    ordinary = (ordinary + PSEUDO) / (ordinary + PSEUDO).sum(1, keepdims=True)
    random = (1 - UNIFORM) * (random + 1 / size) / (random + 1 / size).sum(1, keepdims=True) + UNIFORM / size
    return np.log(random / ordinary).ravel()


def find(docs: DataFrame, ratios: np.ndarray, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id`` and ``spans`` (kind, start, end) of every row, by start, then kind."""
    narrow = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, 1):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([_dicts(x) for x in spans_of(part.column(1), ratios)], kind)], ["_id", "spans"]
            )

    return narrow.mapInArrow(run, f"_id {narrow.schema['_id'].dataType.simpleString()}, spans {sp.SPANS}")


def _dicts(spans: list[sp.Span]) -> list[dict]:
    return [{"kind": k, "start": s, "end": e} for k, s, e in spans]


def spans_of(column: pa.Array, ratios: np.ndarray) -> Iterator[list[sp.Span]]:
    """All spans of each text: those of the patterns and the runs whose likelihood ratio says random."""
    for base, data, own in scan(column):
        long = own[1] - own[0] >= LEAST_SCORED
        if not long.any():
            yield base
            continue
        own = tuple(x[long] for x in own)
        if base:
            ts, te, ps, pe, run = _pieces(_union([(s, e) for _, s, e in base]), own, False)
        else:
            (ts, te, ps, pe), run = own, np.arange(len(own[0]))
        many = te - ts - 1
        scores, some = np.zeros(len(ts)), many > 0
        if some.any():
            starts = np.cumsum(many[some]) - many[some]
            scores[some] = np.add.reduceat(ratios[_transitions(data, ts[some], te[some])], starts)
        together, length = np.bincount(run, scores, len(own[0])), np.bincount(run, te - ts, len(own[0]))
        alone = (scores >= LEAST_RATIO) & (te - ts >= LEAST_SCORED)
        found = alone | ((together >= LEAST_RATIO) & (length >= LEAST_SCORED))[run]
        more = [(MARKOV, s, e) for s, e in zip(ps[found].tolist(), pe[found].tolist())]
        yield sorted(base + more, key=lambda s: (s[1], (*KINDS, MARKOV).index(s[0])))


def redact(docs: DataFrame, mark: str = "[secret]", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with every span of a secret replaced by ``mark``; other columns and rows stay as they are."""
    ratios = train(docs, text_column)
    narrow = docs.select(*docs.columns)
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, at):
            texts = part.column(at).to_pylist()
            for k, found in enumerate(spans_of(part.column(at), ratios)):
                if found:
                    texts[k] = _replaced(texts[k], found, mark)
            columns = [pa.array(texts, part.schema[i].type) if i == at else part.column(i) for i in range(part.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return narrow.mapInArrow(run, narrow.schema)


def _replaced(text: str, found: list[sp.Span], mark: str) -> str:
    out, done = [], 0
    for _, start, end in found:
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = F.filter("spans", lambda s: s["kind"] != MARKOV)
    return sp.digest(find(docs, train(docs)), KINDS, base, F.col("spans"))

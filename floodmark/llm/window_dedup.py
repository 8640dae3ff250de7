"""Repeated passages by difference-cover anchors.

A passage is a window of ``WINDOW`` words; a word goes if it lies in a window whose words also start earlier.
Positions of a document are taken modulo ``PERIOD``. The cover ``COVER`` holds every difference modulo the period,
so for two positions of one passage some shift below the period moves both onto cover positions. Anchors are therefore
hashes of WINDOW - PERIOD + 1 words at cover positions only (4 of 13), and any two equal windows share an aligned anchor.

Anchors that occur once settle most of the text. Around the others, windows that hold a repeated anchor are extended to
their full length: 96-bit hashes of all their words, the earliest position of each wins, all later ones are marked. The marks
of a document are turned into words that go. Both rounds exchange packed positions, see ``occurrences``.

Null texts have no words. Rows of a null id are kept whole and compared with nothing; rows repeated under one id do not
count against each other. Only the id (an integer) and the text are read; texts of any length are one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm import occurrences as oc
from floodmark.llm import wordhash as wh
from floodmark.llm.textscan import utf8

NAME = "op5_difference_cover"
SQL = r"""
WITH words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM words, unnest(range(1, len(w) - 18)) r(i)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + d AS i FROM later, unnest(range(20)) r(d)),
single AS (SELECT doc_id, i, w[i] AS x FROM words, unnest(range(1, len(w) + 1)) r(i)),
stay AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS kept
  FROM single ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN stay USING (doc_id)
"""
WINDOW = 20
#: A perfect difference set: every remainder is a difference of two members.
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1


def anchors(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed anchors of all documents."""
    cover = np.isin(np.arange(PERIOD), COVER)

    def work(chunk: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = utf8(chunk.column(1))
        hashes, cuts = wh.words(data, offsets)
        at, rows = wh.windows(hashes, cuts, ANCHOR)
        place = at - cuts[rows]
        chosen = cover[place % PERIOD]
        at, rows, place = at[chosen], rows[chosen], place[chosen]
        keys, ids = wh.window_hashes(hashes, at, ANCHOR), chunk.column(0).to_numpy()[rows]
        heads, settled = oc.settle(ids, place, [keys], every=True)
        yield from oc.packed(ids, place, keys, None, settled, heads, buckets)

    return oc.mapped(docs, 1, work)


def windows(texts: DataFrame, near: DataFrame, buckets: int, groups: int) -> DataFrame:
    """Packed windows around the repeated anchors (``near``)."""

    def work(docs: pa.Table, anchors_near: pa.Table) -> pa.Table:
        known = oc.Marks(anchors_near)
        batches = docs.select(["_id", "_text"]).filter(pc.is_in(docs.column("_id"), pa.array(np.unique(known.ids)))).to_batches()
        out = [r for chunk in oc.chunks(iter(batches), 1) for r in around(chunk, known)]
        return pa.Table.from_batches(out, schema=oc.SCHEMA)

    def around(chunk: pa.RecordBatch, known: oc.Marks) -> Iterator[pa.RecordBatch]:
        data, offsets = utf8(chunk.column(1))
        hashes, cuts = wh.words(data, offsets)
        edges = np.zeros(len(hashes) + 1, np.int32)
        for k, row_id in enumerate(chunk.column(0).to_pylist()):
            at, n = known.of(row_id), cuts[k + 1] - cuts[k] - WINDOW + 1
            first, last = np.maximum(at + ANCHOR - WINDOW, 0), np.minimum(at + 1, n)
            some = first < last
            np.add.at(edges, cuts[k] + first[some], 1)
            np.add.at(edges, cuts[k] + last[some], -1)
        at = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
        rows = np.searchsorted(cuts, at, "right") - 1
        keys = wh.window_hashes(hashes, at, WINDOW)
        rest = (wh.window_hashes(wh.words(data, offsets, second=True)[0], at, WINDOW) >> np.uint64(32)).astype(np.uint32)
        ids, place = chunk.column(0).to_numpy()[rows], at - cuts[rows]
        heads, settled = oc.settle(ids, place, [keys, rest], every=False)
        yield from oc.packed(ids, place, keys, rest, settled, heads, buckets)

    return oc.grouped(texts, groups).cogroup(near.groupBy("_group")).applyInArrow(work, oc.DDL)


def remove_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id``, ``n_words``, ``n_removed`` and ``kept`` (the words that stay, joined by one space) of every row."""
    texts = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("_text"))
    buckets = groups = oc.parts(texts, "_text", oc.BUCKET_BYTES)
    near = oc.resolve(anchors(texts, buckets), True, groups)
    found = oc.resolve(windows(texts, near, buckets, groups), False, groups)

    def cut(own: pa.Table, gone: pa.Table) -> pa.Table:
        known, rows = oc.Marks(gone), []
        for row_id, text in zip(own.column("_id").to_pylist(), own.column("_text").to_pylist()):
            split = (text or "").encode().split()
            n, at = len(split), known.of(row_id)
            if len(at):
                edges = np.zeros(n + WINDOW + 1, np.int32)
                np.add.at(edges, at, 1)
                np.add.at(edges, at + WINDOW, -1)
                split = list(compress(split, (np.cumsum(edges)[:n] == 0).tolist()))
            rows.append((n, n - len(split), b" ".join(split).decode()))
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.table([own.column("_id"), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names=["_id", "n_words", "n_removed", "kept"])

    schema = "_id long, n_words long, n_removed long, kept string"
    return oc.grouped(texts, groups).cogroup(found.groupBy("_group")).applyInArrow(cut, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

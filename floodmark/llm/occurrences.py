"""Exchange of hashed text positions between tasks: many positions a row, packed by bucket.

A map task turns a chunk of texts into keys with positions (document id, offset). Within the chunk equal keys are
settled at once; one position per distinct key goes on to the key's bucket, so a key that a third of all
documents hold reaches its bucket once per chunk. Buckets cut the key space evenly and their number follows the input, so
a bucket fits a task. What a bucket finds goes back to groups of documents (by a hash of the id), packed again, so
the exchanges hold rows per pair of bucket and group and not per position.

Ids are integers; rows without an id are left out of every comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from floodmark.llm.textscan import utf8
from floodmark.plans.sizing import size_in_bytes

#: Text bytes per chunk of a map task; file bytes of the input per bucket.
CHUNK_BYTES, BUCKET_BYTES = 8 << 20, 8 << 20
#: Estimates from here on stand for an unknown size.
UNKNOWN_SIZE = 1 << 50
FIELDS = [("_bucket", pa.int32()), ("_settled", pa.bool_()), *((c, pa.binary()) for c in ("_ids", "_counts", "_offsets", "_keys", "_rest"))]
SCHEMA = pa.schema(FIELDS)
DDL = "_bucket int, _settled boolean, _ids binary, _counts binary, _offsets binary, _keys binary, _rest binary"
MARKS = "_group int, _ids binary, _counts binary, _offsets binary"


def input_bytes(docs: DataFrame, text_column: str) -> int:
    """Bytes of the input as Catalyst estimates them; inputs of unknown size are measured by one aggregate."""
    size = size_in_bytes(docs)
    if size < UNKNOWN_SIZE:
        return size
    return docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0


def parts(docs: DataFrame, text_column: str, per_part: int) -> int:
    """Number of buckets or groups: the session's shuffle partitions, or more so that each covers ``per_part`` bytes."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-input_bytes(docs, text_column) // per_part))


def chunks(batches: Iterator[pa.RecordBatch], text: int, most_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches put together, or cut, to about ``most_bytes`` of text; rows in the order of ids, null ids left out."""
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        table = table.filter(table.column(0).is_valid())
        order = np.argsort(table.column(0).to_numpy(), kind="stable")
        table = table.take(pa.array(order)).combine_chunks()
        return pa.RecordBatch.from_arrays([c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns], schema=table.schema)

    for batch in batches:
        _, offsets = utf8(batch.column(text))
        start = 0
        while start < batch.num_rows:
            room = most_bytes - size
            stop = max(int(np.searchsorted(offsets, offsets[start] + max(room, 0), "right")) - 1, start + (not held))
            stop = min(stop, batch.num_rows)
            if stop > start:
                held.append(batch.slice(start, stop - start))
                size += int(offsets[stop] - offsets[start])
            if stop < batch.num_rows:
                yield flush()
                held, size = [], 0
            start = stop
    if held:
        yield flush()


def settle(ids: np.ndarray, offsets: np.ndarray, keys: list[np.ndarray], every: bool) -> tuple[np.ndarray, np.ndarray]:
    """First position of every key, and the positions that are settled: those of keys that occur more than once
    (``every``), or of these all but the first. Input stands in the order of (id, offset)."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in keys:
        k = k[order]
        same &= k[1:] == k[:-1]
    first = np.concatenate([[True], ~same]) if len(order) else np.zeros(0, bool)
    run = np.cumsum(first) - 1
    heads = order[first]
    if every:
        many = np.bincount(run, minlength=len(heads)) > 1
        return heads, order[many[run]]
    head = heads[run]
    # rows that repeat an id do not count against themselves
    later = ~first & ((ids[order] != ids[head]) | (offsets[order] != offsets[head]))
    return heads, order[later]


def packed(
    ids: np.ndarray, offsets: np.ndarray, keys: np.ndarray, rest: np.ndarray | None, settled: np.ndarray, heads: np.ndarray, buckets: int
) -> Iterator[pa.RecordBatch]:
    """Rows of ``SCHEMA``: key heads by bucket, settled positions by document."""
    rows: dict[str, list] = {name: [] for name, _ in FIELDS}

    def add(bucket: int, done: bool, at: np.ndarray, key: bytes, more: bytes) -> None:
        own = ids[at]
        cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        for name, value in zip(rows, (bucket, done, own[cuts].tobytes(), np.diff(np.append(cuts, len(at))).astype(np.int32).tobytes(), offsets[at].astype(np.int32).tobytes(), key, more)):
            rows[name].append(value)

    heads = np.sort(heads)
    bucket = (keys[heads] >> np.uint64(32)).astype(np.int64) * buckets >> 32
    order = np.argsort(bucket, kind="stable")
    heads, bucket = heads[order], bucket[order]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        at = heads[cuts[b] : cuts[b + 1]]
        add(int(b), False, at, keys[at].tobytes(), b"" if rest is None else rest[at].tobytes())
    if len(settled):
        settled = np.sort(settled)
        add(int(ids[settled[0]] % buckets), True, settled, b"", b"")
    yield pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, t in FIELDS], schema=SCHEMA)


def unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets of packed rows."""
    ids, counts, offsets = (b"".join(table.column(c).to_pylist()) for c in ("_ids", "_counts", "_offsets"))
    return np.repeat(np.frombuffer(ids, np.int64), np.frombuffer(counts, np.int32)), np.frombuffer(offsets, np.int32)


def group_column(ids: Column, groups: int) -> Column:
    folded = ids.bitwiseXOR(F.shiftright(ids, 15)).bitwiseXOR(F.shiftright(ids, 31))
    return F.pmod(folded, F.lit(groups)).cast("int")


def group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    """``group_column`` for arrays."""
    return np.mod(ids ^ (ids >> 15) ^ (ids >> 31), groups)


def grouped(texts: DataFrame, groups: int) -> GroupedData:
    return texts.withColumn("_group", group_column(F.col("_id"), groups)).groupBy("_group")


def runs_of(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def marks(ids: np.ndarray, offsets: np.ndarray, groups: int) -> pa.Table:
    """One row per group of documents with its ids and their offsets."""
    group = group_of(ids, groups)
    order = np.lexsort((offsets, ids, group))
    ids, offsets, group = ids[order], offsets[order].astype(np.int32), group[order]
    rows = []
    bounds = np.append(runs_of(group), len(group))
    for a, b in zip(bounds[:-1], bounds[1:]):
        own = runs_of(ids[a:b])
        counts = np.diff(np.append(own, b - a)).astype(np.int32)
        rows.append((int(group[a]), ids[a:b][own].tobytes(), counts.tobytes(), offsets[a:b].tobytes()))
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["_group", "_ids", "_counts", "_offsets"])


def resolve(occurrences: DataFrame, every: bool, groups: int) -> DataFrame:
    """Rows of ``MARKS``: positions whose key occurs elsewhere (``every``) or, otherwise, at an earlier position."""

    def run(table: pa.Table) -> pa.Table:
        done = table.column("_settled").to_numpy().astype(bool)
        own = table.filter(pa.array(~done))
        ids, offsets = unpacked(own)
        keys = [np.frombuffer(b"".join(own.column("_keys").to_pylist()), np.uint64)]
        rest = b"".join(own.column("_rest").to_pylist())
        order = np.lexsort((offsets, ids))
        if rest:
            keys.append(np.frombuffer(rest, np.uint32)[order])
        keys[0] = keys[0][order]
        ids, offsets = ids[order], offsets[order]
        _, found = settle(ids, offsets, keys, every)
        more, at = unpacked(table.filter(pa.array(done)))
        return marks(np.concatenate([ids[found], more]), np.concatenate([offsets[found], at]), groups)

    return occurrences.groupBy("_bucket").applyInArrow(run, MARKS)


class Marks:
    """Offsets by document id, from the rows of a group."""

    def __init__(self, table: pa.Table):
        ids, offsets = unpacked(table)
        order = np.lexsort((offsets, ids))
        self.ids, self.offsets = ids[order], offsets[order].astype(np.int64)

    def of(self, row_id: int | None) -> np.ndarray:
        if row_id is None:
            return self.offsets[:0]
        return self.offsets[np.searchsorted(self.ids, row_id) : np.searchsorted(self.ids, row_id, "right")]


def mapped(docs: DataFrame, text: int, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Packed rows of every chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, text):
            yield from work(chunk)

    return docs.mapInArrow(run, DDL)

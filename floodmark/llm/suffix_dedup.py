"""Repeated byte strings by merging the Burrows-Wheeler transforms of shards.

A byte goes if a string of ``LENGTH`` bytes that also starts earlier covers it. Sorting all suffixes in one place is out of
the question, so the text is first dealt out: the smallest hash among the ``GRAM``-byte strings of a window names the
window's bucket. Consecutive windows with the same smallest string form a piece, and equal windows meet in one bucket. Three
exchanges of packed rows follow, all between groups of documents (by a hash of the id) and buckets (by key):

1. keys of all pieces and the number of different pieces; a key that one group alone holds, once, settles its windows as
   unrepeated;
2. the other pieces. Equal pieces are collapsed to their earliest occurrence on either side. For a key with
   several different pieces, the bucket sorts the suffixes of each shard of pieces, merges the shards' transforms by
   interleave refinement (see ``bwt``) and reads the repeated intervals off the blocks at depth LENGTH;
3. intervals that go, back to the documents.

A string of 32 to 99 bytes that everyone shares would fill its key's bucket with its different contexts. A key with more
than ``HOT_PIECES`` different pieces besides the first of each group (which may be the same piece everywhere), or with
more than ``HOT_GROUPS`` groups, is hot: its pieces are dealt out as single windows under the digest of the window, so they
spread, with the same result. A window travels as its digest, without its bytes. So one key brings at most HOT_PIECES +
HOT_GROUPS pieces of up to 168 bytes (4.7 MB; 2.4 MB with the 6,000 groups of 30 GB) to a merge.

Null texts have no bytes. Rows of a null id are kept whole and compared with nothing; rows repeated under one id do not
count against each other. Only the id (an integer) and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm import bwt
from floodmark.llm import wordhash as wh
from floodmark.llm.occurrences import parts
from floodmark.llm.textscan import utf8

NAME = "op3_suffix_array"
SQL = None
LENGTH = 100
GRAM = 32
#: Bytes that are hashed at once.
BLOCK = 1 << 20
#: File bytes of the input per group of documents and per bucket.
GROUP_BYTES, BUCKET_BYTES = 5 << 20, 8 << 20
HOT_PIECES, HOT_GROUPS = 8_192, 20_000
#: Shards of pieces whose transforms are merged, and suffixes merged at once (a key's pieces stay together).
SHARDS, MERGE_SYMBOLS = 4, 1 << 20
_G = np.uint64(0x9E6C63D0876A9A47)
_W = (np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0xD1342543DE82EF95))


class Pieces:
    """Pieces of a group: first and last window (places in the joined texts), document row and key."""

    def __init__(self, docs: pa.Table):
        docs = docs.filter(docs.column("_id").is_valid())
        docs = docs.take(pa.array(np.argsort(docs.column("_id").to_numpy(), kind="stable")))
        texts = docs.column("_text").combine_chunks() if docs.num_rows else pa.array([], pa.string())
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) and texts.num_chunks else texts
        self.ids = docs.column("_id").to_numpy()
        self.data, self.offsets = utf8(texts)
        self.first = self.last = self.row = np.zeros(0, np.int64)
        self.key = np.zeros(0, np.uint64)
        if len(self.data) >= LENGTH:
            self._find()

    def _find(self) -> None:
        """Pieces of the windows, some BLOCK of them at a time; a piece also ends where a block does."""
        found = []
        for begin in range(0, len(self.data) - LENGTH + 1, BLOCK):
            part = self.data[begin : begin + BLOCK + LENGTH - 1]
            places = np.arange(begin, begin + len(part) - LENGTH + 1)
            rows = np.searchsorted(self.offsets, places, "right") - 1
            inside = places + LENGTH <= self.offsets[rows + 1]
            if inside.any():
                at, keys = _minimizers(part)
                found.append(self._runs(at[inside], keys, places[inside], rows[inside]))
        if found:
            self.first, self.last, self.row, self.key = (np.concatenate([f[k] for f in found]) for k in range(4))

    @staticmethod
    def _runs(at: np.ndarray, keys: np.ndarray, places: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        new = np.concatenate([[True], (at[1:] != at[:-1]) | (rows[1:] != rows[:-1])])
        begin = np.flatnonzero(new)
        stop = np.append(begin[1:], len(at)) - 1
        return places[begin], places[stop], rows[begin], keys[at[begin]]

    def variety(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys in order, and how many different pieces each has besides the first."""
        keys, inverse, counts = np.unique(self.key, return_inverse=True, return_counts=True)
        again = np.flatnonzero(counts[inverse] > 1)
        digest = prints(self.data, self.first[again], self.last[again] + LENGTH)[0]
        different = again[np.unique(digest, return_index=True)[1]]
        return keys, np.maximum(np.bincount(inverse[different], minlength=len(keys)) - 1, 0).astype(np.uint32)

    def keep(self, chosen: np.ndarray) -> None:
        self.first, self.last, self.row, self.key = (x[chosen] for x in (self.first, self.last, self.row, self.key))

    def spread(self, hot: np.ndarray) -> None:
        """The pieces ``hot`` become single windows, each under a key of its own text."""
        n = self.last[hot] - self.first[hot] + 1
        one = np.repeat(self.first[hot] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        key = prints(self.data, one, one + LENGTH)[0]
        row = np.repeat(self.row[hot], n)
        self.first, self.last = np.concatenate([self.first[~hot], one]), np.concatenate([self.last[~hot], one])
        self.row, self.key = np.concatenate([self.row[~hot], row]), np.concatenate([self.key[~hot], key])

    def prints(self) -> list[np.ndarray]:
        return prints(self.data, self.first, self.last + LENGTH)


def _minimizers(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window the place of its smallest string (the leftmost one), and the keys of all strings."""
    grams = np.arange(len(part) - GRAM + 1)
    hashes = wh.mix(wh.stretches(wh.BYTE[part], grams, grams + GRAM, _G))
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | grams.astype(np.uint64)  # order value, then the place
    span, width = 1, LENGTH - GRAM + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: span - width], least[width - span :])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64), wh.mix(hashes ^ _G)


def prints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """A 128-bit digest and the length of every stretch, some BLOCK bytes at a time."""
    order = np.argsort(starts, kind="stable")
    out = [np.zeros(len(starts), np.uint64) for _ in _W]
    begin = 0
    while begin < len(order):
        low = starts[order[begin]]
        stop = int(np.searchsorted(starts[order], low + BLOCK, "left"))
        chosen = order[begin:stop]
        values = wh.BYTE[data[low : ends[chosen].max()]]
        for digest, base in zip(out, _W):
            digest[chosen] = wh.mix(wh.stretches(values, starts[chosen] - low, ends[chosen] - low, base))
        begin = stop
    return [*out, ends - starts]


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets cut the keys evenly and in their order."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side: sorted numbers then compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def unplaned(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _grouped(texts: DataFrame, groups: int) -> DataFrame:
    return texts.withColumn("_group", F.pmod(F.xxhash64("_id"), F.lit(groups)).cast("int")).groupBy("_group")


def piece_keys(texts: DataFrame, groups: int, buckets: int) -> DataFrame:
    """First exchange: every group's distinct keys with the number of further pieces, by bucket."""

    def run(docs: pa.Table) -> pa.Table:
        keys, more = Pieces(docs).variety()
        cuts = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
        own = np.flatnonzero(np.diff(cuts))
        group = docs.column("_group")[0].as_py()
        values = (pa.array([planes(v[cuts[b] : cuts[b + 1]]) for b in own], pa.binary()) for v in (keys, more))
        return pa.table([pa.array([group] * len(own), pa.int32()), pa.array(own, pa.int32()), *values], names=["_group", "_bucket", "_keys", "_more"])

    return _grouped(texts, groups).applyInArrow(run, "_group int, _bucket int, _keys binary, _more binary")


def shared_keys(keys: DataFrame) -> DataFrame:
    """Answer to the first exchange: for each key of a group 0 (no other group holds it), 1 or 2 (hot)."""

    def run(table: pa.Table) -> pa.Table:
        own = [unplaned(k, np.uint64) for k in table.column("_keys").to_pylist()]
        more = np.concatenate([unplaned(m, np.uint32) for m in table.column("_more").to_pylist()])
        _, inverse, counts = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        hot = (np.bincount(inverse, more) > HOT_PIECES) | (counts > HOT_GROUPS)
        flags = np.where(hot, 2, counts > 1)[inverse].astype(np.uint8)
        parts = np.split(flags, np.cumsum([len(k) for k in own])[:-1])
        return pa.table([table.column("_group"), table.column("_bucket"), pa.array([p.tobytes() for p in parts], pa.binary())], names=["_group", "_bucket", "_flags"])

    return keys.groupBy("_bucket").applyInArrow(run, "_group int, _bucket int, _flags binary")


INTERVALS = "_group int, _ids binary, _starts binary, _ends binary"


def _intervals(group: np.ndarray, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Table:
    """Rows of ``INTERVALS``, overlapping or touching intervals of a document joined."""
    order = np.lexsort((starts, ids, group))
    group, ids, starts, ends = (x[order] for x in (group, ids, starts, ends))
    if len(ids):
        reach = np.maximum.accumulate(ends + np.cumsum(np.concatenate([[False], ids[1:] != ids[:-1]])) * (1 << 40))
        apart = np.concatenate([[True], (ids[1:] != ids[:-1]) | (group[1:] != group[:-1]) | (starts[1:] + (reach[:-1] >> 40 << 40) > reach[:-1])])
        begin = np.flatnonzero(apart)
        stop = np.append(begin[1:], len(ids)) - 1
        group, ids, starts, ends = group[begin], ids[begin], starts[begin], reach[stop] & ((1 << 40) - 1)
    cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(ids) else np.zeros(0, np.int64)
    bounds = list(zip(cuts, np.append(cuts[1:], len(ids))))
    columns = [pa.array([int(group[a]) for a, _ in bounds], pa.int32())]
    for values, kind in ((ids, np.int64), (starts, np.int32), (ends, np.int32)):
        columns.append(pa.array([planes(np.ascontiguousarray(values[a:b], kind)) for a, b in bounds], pa.binary()))
    return pa.table(columns, names=["_group", "_ids", "_starts", "_ends"])


PIECES = "_bucket int, _group int, _ids binary, _starts binary, _sizes binary, _keys binary, _bytes binary"


def shared_pieces(texts: DataFrame, flags: DataFrame, groups: int, buckets: int) -> DataFrame:
    """Second exchange: pieces of shared keys, by bucket. Rows without keys hold the intervals that a group settled itself,
    rows without sizes hold single windows with the second half of their digests as bytes."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        columns = [[] for _ in range(7)]
        if docs.num_rows:
            found = Pieces(docs)
            keys, inverse, counts = np.unique(found.key, return_inverse=True, return_counts=True)
            raw = answers.take(pa.array(np.argsort(answers.column("_bucket").to_numpy()))).column("_flags").to_pylist()
            flag = np.frombuffer(b"".join(raw), np.uint8)
            flag = np.maximum(flag, counts > 1)[inverse]
            found.keep(flag > 0)
            found.spread(flag[flag > 0] == 2)
            _deal(found, docs.column("_group")[0].as_py(), buckets, columns)
        kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 5
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split(" ")[0] for f in PIECES.split(", ")])

    return _grouped(texts, groups).cogroup(flags.groupBy("_group")).applyInArrow(run, PIECES)


def _deal(found: Pieces, group: int, buckets: int, columns: list[list]) -> None:
    """Rows of the pieces that are first of their kind in the group; the others are settled."""
    ids, starts = found.ids[found.row], found.first - found.offsets[found.row]
    digests = found.prints()
    heads, later = _twins(ids, starts, digests)
    done = _intervals(np.zeros(len(later), np.int64), ids[later], starts[later], starts[later] + digests[2][later])
    if done.num_rows:
        for column, value in zip(columns, (group % buckets, group, *(done.column(c)[0].as_py() for c in ("_ids", "_starts", "_ends")), None, None)):
            column.append(value)
    bucket = bucket_of(found.key[heads], buckets)
    heads = heads[np.lexsort((starts[heads], ids[heads], bucket))]
    cuts = np.searchsorted(bucket_of(found.key[heads], buckets), np.arange(buckets + 1))
    single = found.key == digests[0]
    for b in np.flatnonzero(np.diff(cuts)):
        both = heads[cuts[b] : cuts[b + 1]]
        for at, windows in ((both[~single[both]], False), (both[single[both]], True)):
            if not len(at):
                continue
            if windows:
                sizes, raw = None, planes(digests[1][at])
            else:
                sizes = digests[2][at]
                places = np.repeat(found.first[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                sizes, raw = planes(sizes.astype(np.int32)), found.data[places].tobytes()
            values = (int(b), group, planes(ids[at]), planes(starts[at].astype(np.int32)), sizes, planes(found.key[at]), raw)
            for column, value in zip(columns, values):
                column.append(value)


def _twins(ids: np.ndarray, starts: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The earliest of each kind in the order of ``values``, and all others that are not the same place again."""
    order = np.lexsort((starts, ids, *values))
    same = np.zeros(len(order), bool)
    same[1:] = np.logical_and.reduce([v[order][1:] == v[order][:-1] for v in values])
    head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))] if len(order) else order
    return order[~same], order[same & ((ids[order] != ids[head]) | (starts[order] != starts[head]))]


def repeats(pieces: DataFrame) -> DataFrame:
    """Intervals that go, by group of documents."""

    def run(table: pa.Table) -> pa.Table:
        own = table.filter(table.column("_keys").is_valid())
        windows = own.filter(own.column("_sizes").is_null())
        own = own.filter(own.column("_sizes").is_valid())
        settled = table.filter(table.column("_keys").is_null())
        ready = []
        for g, i, s, e in zip(*(settled.column(c).to_pylist() for c in ("_group", "_ids", "_starts", "_sizes"))):
            i = unplaned(i, np.int64)
            ready.append((np.full(len(i), g), i, unplaned(s, np.int32).astype(np.int64), unplaned(e, np.int32).astype(np.int64)))
        if own.num_rows:
            ready += _repeated(own)
        if windows.num_rows:
            ready.append(_repeated_windows(windows))
        if not ready:
            return _intervals(*(np.zeros(0, np.int64) for _ in range(4)))
        return _intervals(*(np.concatenate([r[k] for r in ready]) for k in range(4)))

    return pieces.groupBy("_bucket").applyInArrow(run, INTERVALS)


def _repeated_windows(windows: pa.Table) -> tuple[np.ndarray, ...]:
    """Later occurrences among single windows: equal digests are equal windows."""
    ids, starts, first, second = (
        np.concatenate([unplaned(v, k) for v in windows.column(c).to_pylist()])
        for c, k in (("_ids", np.int64), ("_starts", np.int32), ("_keys", np.uint64), ("_bytes", np.uint64))
    )
    group = np.repeat(np.array(windows.column("_group").to_pylist()), [len(s) // 4 for s in windows.column("_starts").to_pylist()])
    _, later = _twins(ids, starts, [second, first])
    start = starts[later].astype(np.int64)
    return group[later], ids[later], start, start + LENGTH


def _repeated(own: pa.Table) -> list[tuple[np.ndarray, ...]]:
    ids, starts, sizes, keys = (
        np.concatenate([unplaned(v, k) for v in own.column(c).to_pylist()]).astype(t)
        for c, k, t in (("_ids", np.int64, np.int64), ("_starts", np.int32, np.int64), ("_sizes", np.int32, np.int64), ("_keys", np.uint64, np.uint64))
    )
    group = np.repeat(np.array(own.column("_group").to_pylist()), [len(s) // 4 for s in own.column("_sizes").to_pylist()])
    text = np.frombuffer(b"".join(own.column("_bytes").to_pylist()), np.uint8)
    at = np.cumsum(sizes) - sizes
    digests = prints(text, at, at + sizes)
    heads, later = _twins(ids, starts, [*digests, keys])
    out = [(group[later], ids[later], starts[later], starts[later] + sizes[later])]
    # keys with several different pieces: their strings go into shards
    new = np.concatenate([[True], keys[heads][1:] != keys[heads][:-1]])
    run = np.cumsum(new) - 1
    several = np.bincount(run)[run] > 1
    heads, run = heads[several], run[several]
    cost = np.cumsum(sizes[heads])
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(heads) else np.zeros(0, np.int64)
    begin = 0
    while begin < len(first):
        floor = cost[first[begin] - 1] if first[begin] else 0
        stop = max(begin + 1, int(np.searchsorted(cost[np.append(first[1:], len(heads)) - 1], floor + MERGE_SYMBOLS, "right")))
        batch = heads[first[begin] : first[stop] if stop < len(first) else len(heads)]
        out.append(_merged(batch, group, ids, starts, sizes, at, text))
        begin = stop
    return out


def _merged(batch: np.ndarray, group, ids, starts, sizes, at, text) -> tuple[np.ndarray, ...]:
    """Later occurrences among the windows of different pieces, by a merge of the shards' transforms."""
    length = sizes[batch]
    offset = np.cumsum(length) - length
    symbols = text[np.repeat(at[batch] - offset, length) + np.arange(length.sum())]
    shards = np.arange(len(batch)) * SHARDS // len(batch)
    place, block = bwt.repeated_blocks(length, symbols, shards, LENGTH)
    piece = np.searchsorted(offset, place, "right") - 1
    owner = batch[piece]
    start = starts[owner] + place - offset[piece]
    order = np.lexsort((start, ids[owner], block))
    owner, start, block = owner[order], start[order], block[order]
    head = np.maximum.accumulate(np.where(np.concatenate([[True], block[1:] != block[:-1]]), np.arange(len(block)), 0)) if len(block) else block
    later = (ids[owner] != ids[owner[head]]) | (start != start[head])
    owner, start = owner[later], start[later]
    return group[owner], ids[owner], start, start + LENGTH


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the remaining bytes) of every row."""
    texts = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("_text"))
    buckets, groups = (parts(texts, "_text", n) for n in (BUCKET_BYTES, GROUP_BYTES))
    flags = shared_keys(piece_keys(texts, groups, buckets))
    found = repeats(shared_pieces(texts, flags, groups, buckets))

    def cut(own: pa.Table, gone: pa.Table) -> pa.Table:
        spans: dict[int, list[np.ndarray]] = {}
        if gone.num_rows:
            ids, starts, ends = (
                np.concatenate([unplaned(v, k) for v in gone.column(c).to_pylist()])
                for c, k in (("_ids", np.int64), ("_starts", np.int32), ("_ends", np.int32))
            )
            order = np.lexsort((starts, ids))
            ids, pairs = ids[order], np.stack([starts[order], ends[order]], 1)
            cuts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            spans = dict(zip(ids[cuts].tolist(), np.split(pairs, cuts[1:])))
        rows = [_cut((t or "").encode(), spans.get(i)) for i, t in zip(own.column("_id").to_pylist(), own.column("_text").to_pylist())]
        return pa.table(
            [own.column("_id"), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)), pa.array([r[3] for r in rows], pa.binary())],
            names=["_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )

    schema = "_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return _grouped(texts, groups).cogroup(found.groupBy("_group")).applyInArrow(cut, schema)


def _cut(raw: bytes, spans: np.ndarray | None) -> tuple[int, int, int, bytes]:
    if spans is None:
        return len(raw), 0, 0, raw
    edges = np.zeros(len(raw) + 1, np.int32)
    np.add.at(edges, spans[:, 0], 1)
    np.add.at(edges, spans[:, 1], -1)
    gone = np.cumsum(edges)[:-1] > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return len(raw), int(gone.sum()), runs, np.frombuffer(raw, np.uint8)[~gone].tobytes()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

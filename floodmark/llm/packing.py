"""Best-fit packing with a matching of large items.

Three steps. (1) Documents become token counts and checksums per piece; only documents over the capacity are cut, the
first piece taking the remainder. (2) A histogram of piece lengths, at most one counter per length up to the
capacity, is planned on the driver: lengths over a third of the capacity are matched greedily, longest first, each
with the longest partner that fits, so at most two share a bin; smaller lengths fill the remaining gaps best-fit, then
bins of their own. The plan works on classes (length, gap) with multiplicities; its size depends on the capacity and
not on the number of pieces. (3) Each piece takes the place that its rank among the pieces of its length has
in the plan. Ranks are exact: counts per (length, shard) are summed up over the shards, so that a length
that a third of all pieces share is ranked in many tasks.

Null and empty texts have the end id alone (length 1). Rows with the same id are packed each for itself. An empty
table gives an empty result. Columns other than the id and text are not read.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from floodmark.llm.memo import ChunkMemo
from floodmark.llm.textscan import blocks, byte_class, owner, utf8
from floodmark.plans.staging import stage

NAME = "op10_best_fit_packing"
SQL = None
CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
#: Pieces that one task ranks, about.
SHARD_ROWS = 200_000

_SPACE = byte_class(" \n\t\r")
#: Bytes that every other white space begins with or is.
_SUSPECT = np.isin(np.arange(256), [0x0B, 0x0C, *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3])

Interval = tuple[int, int, int, int, int]  # length, first rank, number of ranks, first bin, offset


class ByteTokenizer:
    """Token ids of the tokenizers library with a memo of chunks.

    A chunk is white space with the run of other characters behind it. The vocabulary's pattern never lets a token
    cross the border before white space, and looks behind nothing, so chunks are encoded alone. Texts with
    white space beyond the four usual characters go to the library whole. The vocabulary's one added token,
    ``<|endoftext|>``, holds no white space and takes none from its sides, so it lies within a chunk; as the library
    does by default, it becomes its own id (13 bytes) and splits the chunk before the pattern runs.
    """

    OTHER_SPACE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        resize = getattr(self.library.model, "_resize_cache", None)
        if resize is not None:
            resize(0)  # the memo holds what comes back; the library's own cache only costs time on new chunks
        names = sorted(self.library.get_vocab().items(), key=lambda x: x[1])
        self.widths = np.zeros(names[-1][1] + 1, np.int64)  # one character of a byte-level token is one byte
        self.widths[[i for _, i in names]] = [len(t) for t, _ in names]
        self.memo = ChunkMemo(self._encode)

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """Chunks are joined for the library, and its ids are cut where a chunk's bytes end.

        A chunk without leading white space gets a line break ahead, which is a token of its own and is cut off.
        """
        out: list[bytes] = []
        for at in range(0, len(chunks), 4096):
            group = chunks[at : at + 4096]
            alone = [k for k, c in enumerate(group) if c.isspace() or self.OTHER_SPACE(c)]
            padded = [c if c[0] in " \n\t\r" else "\n" + c for c in group]
            for k in alone:
                padded[k] = ""
            ids = self._ids("".join(padded))
            raw = np.cumsum([len(c) if c.isascii() else len(c.encode()) for c in padded])
            stops = np.searchsorted(np.cumsum(self.widths[ids]), raw, "left") + (raw > 0)
            starts = np.append(0, stops[:-1]) + [len(p) > len(c) for p, c in zip(padded, group)]
            joined = ids.tobytes()
            cut = [joined[x:y] for x, y in zip((4 * starts).tolist(), (4 * stops).tolist())]
            for k in alone:
                cut[k] = self._ids(group[k]).tobytes()
            out += cut
        return out

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, and the n + 1 offsets of the texts into them.

        Chunks are cut, and equal ones found, in the column's buffer; Python sees the distinct chunks of a block.
        """
        data, offsets = utf8(column)
        space = _SPACE[data]
        begin = np.zeros(len(data) + 1, bool)
        begin[1:-1] = space[1:] & ~space[:-1]
        for k in np.unique(owner(np.flatnonzero(_SUSPECT[data]), offsets)):
            low, high = offsets[k], offsets[k + 1]
            if self.OTHER_SPACE(data[low:high].tobytes().decode()):
                begin[low:high] = False
        begin[offsets[:-1]] = True
        starts = np.flatnonzero(begin[: len(data)])
        bounds = np.append(starts, len(data)).astype(np.int64)
        chunks = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        distinct = chunks.dictionary_encode()
        found = distinct.dictionary.to_pylist()
        parts = list(map(self.memo.fill(set(found)).__getitem__, found))
        sizes = np.array([len(p) for p in parts], np.int64) // 4
        flat, first = np.frombuffer(b"".join(parts), "<u4"), np.cumsum(sizes) - sizes
        index = distinct.indices.to_numpy()
        counts = sizes[index]
        ends = np.cumsum(counts)
        ids = flat[np.repeat(first[index] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.append(0, ends)[np.searchsorted(starts, offsets)]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteTokenizer:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return ByteTokenizer(path)


def pieces(
    docs: DataFrame, path: str, keep: list[str], text_column: str = "text", capacity: int = CAPACITY, with_ids: bool = False,
    block: int = 4 << 20,
) -> DataFrame:
    """One row per piece: columns ``keep``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``."""
    narrow = docs.select(*keep, F.col(text_column).alias("_text"))
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode
        for part in blocks(batches, len(keep), block):
            row, number, begun, sizes, sums, ids = [], [], [], [], [], []
            tokens_of, cuts = encode(part.column(len(keep)))
            for k in range(part.num_rows):
                tokens = tokens_of[cuts[k] : cuts[k + 1]].tobytes() + end
                n = len(tokens) // 4
                start = 0
                for p in range(-(-n // capacity)):
                    stop = min(n, ((n - 1) % capacity + 1) + p * capacity)
                    cut = tokens[4 * start : 4 * stop]
                    row.append(k), number.append(p), begun.append(start), sizes.append(stop - start)
                    sums.append(zlib.crc32(cut))
                    if with_ids:
                        ids.append(cut)
                    start = stop
            out = [part.column(i).take(pa.array(row, pa.int64())) for i in range(len(keep))]
            out += [pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (begun, sizes, sums))]
            names = [*keep, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    more = ", ids binary" if with_ids else ""
    return narrow.mapInArrow(run, f"{kept}, piece int, start long, length long, ids_crc32 long{more}")


class Gaps:
    """Bins with room, in classes of equal gap: ``gap -> [(first bin, bins, used)]`` and the gaps in order."""

    def __init__(self):
        self.classes: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        self.order: list[int] = []

    def add(self, gap: int, first: int, bins: int, used: int) -> None:
        if gap > 0 and bins > 0:
            if not self.classes[gap]:
                bisect.insort(self.order, gap)
            self.classes[gap].append((first, bins, used))

    def take(self, least: int) -> tuple[int, int, int, int] | None:
        """The class with the smallest gap that has room for ``least``."""
        at = bisect.bisect_left(self.order, least)
        if at == len(self.order):
            return None
        gap = self.order[at]
        found = self.classes[gap].pop()
        if not self.classes[gap]:
            self.order.pop(at)
        return (gap, *found)


def match_large(counts: dict[int, int], capacity: int, gaps: Gaps) -> tuple[list[Interval], int]:
    """Lengths over a third of the capacity: longest first, with the longest partner that fits. Returns the next bin."""
    left = {n: c for n, c in counts.items() if 3 * n > capacity and n < capacity}
    order, used, plan, bins = sorted(left), defaultdict(int), [], 0

    def place(length: int, many: int, offset: int) -> None:
        plan.append((length, used[length], many, bins, offset))
        used[length] += many
        left[length] -= many

    while order:
        long = order[-1]
        if not left[long]:
            order.pop()
            continue
        at = bisect.bisect_right(order, capacity - long) - 1
        while at >= 0 and left[order[at]] < 1 + (order[at] == long):  # the last one of a length has no twin
            if not left[order[at]]:
                order.pop(at)
            at -= 1
        mate = order[at] if at >= 0 else 0
        many = left[long] // 2 if mate == long else min(left[long], left[mate]) if mate else left[long]
        place(long, many, 0)
        if mate:
            place(mate, many, long)
        gaps.add(capacity - long - mate, bins, many, long + mate)
        bins += many
    return plan, bins


def fill_small(counts: dict[int, int], capacity: int, gaps: Gaps, bins: int) -> tuple[list[Interval], int]:
    """Lengths up to a third of the capacity, longest first, into the tightest gap; then into new bins."""
    plan: list[Interval] = []
    for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        rank, left = 0, counts[length]
        while left:
            found = gaps.take(length)
            if found is None:
                per_bin = capacity // length
                found = (capacity, bins, -(-left // per_bin), 0)
                bins += found[2]
            gap, first, many, used = found
            per_bin = gap // length
            full = min(many, left // per_bin)
            for k in range(per_bin if full else 0):
                plan.append((length, rank + k * full, full, first, used + k * length))
            gaps.add(gap - per_bin * length, first, full, used + per_bin * length)
            rank, left = rank + full * per_bin, left - full * per_bin
            rest = left if full < many else 0  # fewer than a bin takes: all into the next one
            for k in range(rest):
                plan.append((length, rank + k, 1, first + full, used + k * length))
            if rest:
                gaps.add(gap - rest * length, first + full, 1, used + rest * length)
            gaps.add(gap, first + full + bool(rest), many - full - bool(rest), used)
            rank, left = rank + rest, left - rest
    return plan, bins


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Interval], int]:
    """Places for every (length, rank): the rank's distance from the interval's first rank is added to its first bin."""
    gaps = Gaps()
    full = counts.get(capacity, 0)
    plan, bins = match_large(counts, capacity, gaps)
    small, bins = fill_small(counts, capacity, gaps, bins)
    plan += small
    if full:
        plan.append((capacity, 0, full, bins, 0))
        bins += full
    return plan, bins


def pack(parts: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (a staged or otherwise repeatable table of pieces) with ``sequence_id`` and ``offset``."""
    spark = parts.sparkSession
    by_length = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    plan, _ = plan_bins(by_length, capacity)
    shards = max(1, -(-sum(by_length.values()) // SHARD_ROWS)) * 8
    sharded = parts.withColumn("_shard", F.pmod(F.xxhash64(*order), F.lit(shards)).cast("int"))
    sizes = sharded.groupBy("length", "_shard").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "_shard", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_shard").orderBy(*order)
    ranked = sharded.withColumn("_row", F.row_number().over(within)).join(starts, ["length", "_shard"])
    ranked = ranked.withColumn("_rank", F.col("_row") - 1 + F.col("_before"))
    places = spark.createDataFrame(
        [(n, [(r, m, b, o) for _, r, m, b, o in sorted(rows)]) for n, rows in _grouped(plan).items()],
        "length long, _places array<struct<rank:long,many:long,bin:long,offset:long>>",
    )
    # one row per length with its intervals in rank order: the table is bounded by the capacity, not by the corpus
    placed = ranked.join(F.broadcast(places), "length").withColumn(
        "_at", F.filter("_places", lambda x: (x["rank"] <= F.col("_rank")) & (F.col("_rank") < x["rank"] + x["many"]))[0]
    )
    return placed.select(
        *parts.columns,
        (F.col("_at.bin") + F.col("_rank") - F.col("_at.rank")).alias("sequence_id"),
        F.col("_at.offset").alias("offset"),
    )


def _grouped(plan: list[Interval]) -> dict[int, list[Interval]]:
    out: dict[int, list[Interval]] = defaultdict(list)
    for interval in plan:
        out[interval[0]].append(interval)
    return out


def pack_documents(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokenise, cut and pack. Pieces (some 40 bytes a row) are staged, so texts are tokenised once."""
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("_input"))
    parts = stage(pieces(narrow, path, ["doc_id"], "_input"), "pieces")
    return pack(parts, ["doc_id", "piece", "ids_crc32"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(VOCABULARY))

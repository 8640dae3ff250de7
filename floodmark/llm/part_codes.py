"""Vectors compressed to codes of parts, with tries over the distinct parts.

Components become whole numbers ``floor(SCALE * x)``; a vector is cut into ``PARTS`` consecutive parts, each coded by its nearest entry of
its position's codebook. The distinct parts of a position, in lexicographic order with their multiplicities, are a trie whose
levels are the dimensions. A traversal keeps, for every node on the path, the squared distances of the node's prefix to all entries; parts
with a common prefix share them, and a leaf takes the least one and adds its multiplicity to the sums of that entry. The
traversal goes depth-first over blocks of leaves, carries the path from block to block, and does the nodes of one level of a
block in one numpy step.

The table of distinct parts is built once: equal parts are counted (so a vector that a third of all rows hold is one leaf), dealt to
tasks by ranges of (position, part) and staged in that order. Each round reads it and sends home, per position and
entry, a count and a sum per dimension. The last assignment runs over the vectors themselves, with a trie per batch.

All arithmetic is exact: 64-bit where no distance can pass them, Python's integers otherwise; sums travel in 32-bit digits. A
part travels as 8-byte big-endian numbers whose bytes sort like the numbers.

Rows whose vector is null or holds a null or non-finite component are left out, and so are vectors of another length than the first
one's (smallest id), which no entry can be compared with. A length that ``PARTS`` does not divide gives parts that differ by one component.
Fewer rows than ``ENTRIES`` give as many entries; ties of ids are broken by the vector; null ids come last. Repeated rows
count each. Errors beyond 64 bits are reported as the largest 64-bit number. An empty table gives an empty result. Columns
other than id, vector and label are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.plans.sizing import size_in_bytes, skew_join
from floodmark.plans.staging import stage, staged

NAME = "op11_part_codes"
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Leaves of one block of the traversal; bytes of the input per task.
BLOCK_LEAVES, TASK_BYTES = 1 << 15, 32 << 20
LARGEST = (1 << 63) - 1

Codebooks = list[list[list[int]]]  # by part, entry, position


def cuts_of(length: int) -> list[int]:
    return [length * p // PARTS for p in range(PARTS + 1)]


def grid(values: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x) / SCALE``, which is exact; numbers from 2**53 on are whole already. No negative zeros."""
    small = np.abs(values) < 2.0**53
    return np.where(small, np.floor(np.where(small, values, 0) * SCALE) / SCALE, values) + 0.0


def to_keys(values: np.ndarray) -> np.ndarray:
    """Rows of numbers as rows of bytes in the same order."""
    raw = np.ascontiguousarray(values, np.float64).view(np.uint64)
    flipped = np.where(raw >> np.uint64(63), ~raw, raw | np.uint64(1 << 63))
    return flipped.astype(">u8").view(np.uint8).reshape(len(values), -1)


def from_keys(keys: np.ndarray) -> np.ndarray:
    raw = np.ascontiguousarray(keys).view(">u8").astype(np.uint64)
    return np.where(raw >> np.uint64(63), raw & np.uint64((1 << 63) - 1), ~raw).view(np.float64)


def whole(values: np.ndarray, limit: int) -> np.ndarray:
    """Whole numbers of grid values: 64-bit while all stay below ``limit``, Python's otherwise."""
    if not values.size or np.abs(values).max() * SCALE < limit:
        return (values * SCALE).astype(np.int64)
    flat = [int(v) * SCALE if abs(v) >= 2.0**53 else int(v * SCALE) for v in values.ravel().tolist()]
    return np.array([*flat, None], object)[:-1].reshape(values.shape)


class Trie:
    """Depth-first traversal over blocks of leaves in lexicographic order, for one codebook."""

    def __init__(self, entries: list[list[int]]):
        width = len(entries[0])
        self.limit = math.isqrt((1 << 61) // max(width, 1))
        small = all(abs(v) < self.limit for e in entries for v in e)
        self.entries = np.array(entries, np.int64 if small else object).reshape(len(entries), width)
        self.path: list[np.ndarray] = []
        self.last: np.ndarray | None = None

    def assign(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry (ties: the lowest) and squared distance of a block of distinct leaves, which follows the last block."""
        n, width = leaves.shape
        entries = self.entries
        if leaves.dtype == object or entries.dtype == object:
            leaves, entries = leaves.astype(object), entries.astype(object)
        differs = np.ones((n, width + 1), bool)
        differs[1:, :width] = leaves[1:] != leaves[:-1]
        if self.last is not None:
            differs[0, :width] = leaves[0] != self.last
        shared = differs.argmax(axis=1)  # levels that a leaf has in common with the one before
        if self.last is None:
            shared[0] = 0
        above = np.zeros((1, len(entries)), entries.dtype)
        parent = np.zeros(n, np.int64)
        path = []
        for d in range(width):
            opens = shared <= d
            opens[0] = True  # the first leaf's node, or the one carried over
            rows = np.flatnonzero(opens)
            sums = above[parent[rows]] + (leaves[rows, d][:, None] - entries[None, :, d]) ** 2
            if shared[0] > d:
                sums[0] = self.path[d]
            path.append(sums[-1])
            above, parent = sums, np.cumsum(opens) - 1
        self.path, self.last = path, leaves[-1]
        if not width:
            return np.zeros(n, np.int64), np.zeros(n, np.int64)
        near = above.argmin(axis=1)[parent]
        return near, above[parent, near]


def kept(vectors: DataFrame, id_column: str, vector_column: str, *more: Column) -> DataFrame:
    """``_id``, ``_v`` (double) and further columns of the rows with whole vectors."""
    component = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(id_column).alias("_id"), F.col(vector_column).cast("array<double>").alias("_v"), *more)
    return rows.where(F.col("_v").isNotNull() & ~F.exists("_v", component))


def first_rows(rows: DataFrame, many: int) -> list[np.ndarray]:
    """The vectors of the ``many`` smallest ids, ascending. Ids go to the driver before vectors, and only ``many`` of each task."""
    ids = [r["_id"] for r in rows.select("_id").orderBy(F.col("_id").asc_nulls_last()).limit(many).collect()]
    if len(ids) == many and ids[-1] is not None:
        rows = rows.where(F.col("_id") <= F.lit(ids[-1]))
    found = rows.select("_id", "_v").orderBy(F.col("_id").asc_nulls_last(), "_v").limit(many).collect()
    return [np.array(r["_v"], float) for r in found]


def matrix(column: pa.Array) -> np.ndarray:
    """Grid values of a list column without nulls whose lists have one length."""
    return grid(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(len(column), -1)


def distinct_parts(rows: DataFrame, cuts: list[int], tasks: int) -> DataFrame:
    """``part``, ``key`` and ``n`` (multiplicity) of all distinct parts, in lexicographic order within a task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column(0))
            for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if not len(values):
                    continue
                raw = to_keys(values[:, a:b])
                keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * (b - a)), len(raw), [None, pa.py_buffer(raw.tobytes())]) if b > a else pa.array([b""] * len(raw))
                found = pc.value_counts(keys.cast(pa.binary()))
                names = pa.array(np.full(len(found), p, np.int32))
                yield pa.RecordBatch.from_arrays([names, found.field(0), found.field(1)], ["part", "key", "n"])

    parts = rows.select("_v").mapInArrow(cut, "part int, key binary, n long")
    counted = parts.groupBy("part", "key").agg(F.sum("n").alias("n"))
    return counted.repartitionByRange(tasks, "part", "key").sortWithinPartitions("part", "key")


def digits(value: int) -> Iterator[tuple[int, int]]:
    """Places and signed 32-bit digits of a number."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield place, sign * (value & 0xFFFFFFFF)
        value, place = value >> 32, place + 1


def entry_sums(table: DataFrame, codebooks: Codebooks) -> dict[tuple[int, int], list[int]]:
    """For every (part, entry) in use: how many parts it is nearest to, and their sum per position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], list[int]] = {}
        tries: dict[int, Trie] = {}
        for batch in batches:
            names = batch.column(0).to_numpy()
            counts = batch.column(2).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(names)) + 1).tolist(), len(names)]
            for start, stop in zip(edges, edges[1:]):
                for a in range(start, stop, BLOCK_LEAVES):
                    b = min(a + BLOCK_LEAVES, stop)
                    p = int(names[a])
                    trie = tries.setdefault(p, Trie(codebooks[p]))
                    keys = np.frombuffer(b"".join(batch.column(1).slice(a, b - a).to_pylist()), np.uint8)
                    leaves = whole(from_keys(keys.reshape(b - a, -1)), trie.limit)
                    near, _ = trie.assign(leaves)
                    many = counts[a:b]
                    if leaves.dtype == np.int64 and int(np.abs(leaves).max(initial=0)) * int(many.sum()) >> 62:
                        leaves = leaves.astype(object)
                    for e in np.unique(near).tolist():
                        own = near == e
                        sums = (leaves[own] * many[own].astype(leaves.dtype)[:, None]).sum(axis=0).tolist()
                        held = totals.setdefault((p, e), [0] * (len(sums) + 1))
                        for k, v in enumerate([int(many[own].sum()), *sums]):
                            held[k] += int(v)
        rows = [(p, e, k, place, d) for (p, e), held in totals.items() for k, v in enumerate(held) for place, d in digits(v)]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["part", "entry", "k", "place", "digit"])

    digits_of = table.mapInArrow(run, "part int, entry int, k int, place int, digit long")
    found: dict[tuple[int, int], list[int]] = {}
    for r in digits_of.groupBy("part", "entry", "k", "place").agg(F.sum("digit").alias("digit")).collect():  # numbers of one model
        held = found.setdefault((r["part"], r["entry"]), [0] * (len(codebooks[r["part"]][0]) + 1))
        held[r["k"]] += r["digit"] << (32 * r["place"])
    return found


def fit(rows: DataFrame, first: list[np.ndarray], rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after ``rounds`` rounds, from the first rows' parts; ``rows`` as ``kept`` gives them."""
    cuts = cuts_of(len(first[0]))
    start = [whole(grid(v[None, :]), 0)[0].tolist() for v in first]
    books = [[v[a:b] for v in start] for a, b in zip(cuts, cuts[1:])]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = size_in_bytes(rows)
    if size < 1 << 50:
        tasks = max(tasks, size // TASK_BYTES)
    with staged(distinct_parts(rows, cuts, tasks), "parts") as table:
        for _ in range(rounds):
            for (p, e), (many, *sums) in entry_sums(table, books).items():
                books[p][e] = [s // many for s in sums]
    return books


def encode(rows: DataFrame, books: Codebooks, *more: str) -> DataFrame:
    """``_id``, ``code``, ``error`` and the columns ``more`` of rows that ``kept`` gives."""
    cuts = np.cumsum([0] + [len(b[0]) for b in books]).tolist()
    names = ["_id", *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = matrix(batch.column(0))
            codes, error = np.zeros((n, len(books)), np.uint8), np.zeros(n, object)
            for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a == b:
                    continue
                keys = to_keys(values[:, a:b]).view(f"S{8 * (b - a)}").ravel()
                _, at, back = np.unique(keys, return_index=True, return_inverse=True)
                trie = Trie(books[p])
                leaves = whole(values[at, a:b], trie.limit)
                found = [trie.assign(leaves[k : k + BLOCK_LEAVES]) for k in range(0, len(leaves), BLOCK_LEAVES)]
                codes[:, p] = np.concatenate([f[0] for f in found])[back]
                error += np.concatenate([f[1] for f in found])[back]
            text = codes.tobytes().hex()
            width = 2 * len(books)
            out = [pa.array([text[k * width : (k + 1) * width] for k in range(n)]), pa.array([min(int(x), LARGEST) for x in error], pa.int64())]
            own = [batch.column(k + 1) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*own, *out], [*names, "code", "error"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.select("_v", *names).mapInArrow(run, f"{kinds}, code string, error long")


def with_label_error(coded: DataFrame, label: str) -> DataFrame:
    """``label_error``: ``error`` summed over the rows of a label, nulls together. A frequent label is summed before it is shuffled."""
    keyed = coded.withColumns({"_null": F.col(label).isNull(), "_key": F.coalesce(F.col(label).cast("string"), F.lit(""))})
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    sums = keyed.groupBy("_null", "_key").agg(total.alias("label_error"))
    return skew_join(keyed, sums, ["_null", "_key"], "inner").drop("_null", "_key")


def compress(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", rounds: int = ROUNDS
) -> tuple[DataFrame, Codebooks]:
    """``_id``, ``label``, ``code``, ``error``, ``label_error`` of every row with a whole vector, and the codebooks."""
    rows = kept(vectors, id_column, vector_column, F.col(label_column).alias("_label"))
    first = first_rows(rows, ENTRIES)
    if not first:
        kinds = rows.schema
        empty = f"_id {kinds['_id'].dataType.simpleString()}, label {kinds['_label'].dataType.simpleString()}"
        return rows.sparkSession.createDataFrame([], f"{empty}, code string, error long, label_error long"), []
    rows = rows.where(F.size("_v") == len(first[0]))
    first = [v for v in first if len(v) == len(first[0])]
    if len(first) < ENTRIES:
        first = first_rows(rows, ENTRIES)
    books = fit(rows, first, rounds)
    coded = stage(encode(rows, books, "_label"), "codes")
    return with_label_error(coded, "_label").withColumnRenamed("_label", "label"), books


def digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select(F.col("_id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same rounds over rows (vector, part, position), spelled out one after the other."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""x AS MATERIALIZED (
  SELECT vec_id, g.i // (len(v) // {PARTS}) AS p, g.i % (len(v) // {PARTS}) AS i, v[g.i + 1] AS x
  FROM kept, (SELECT unnest(range(4096)) AS i) g WHERE g.i < len(v))""",
        f"""c0 AS MATERIALIZED (
  SELECT p, e, i, x FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept) USING (vec_id) WHERE e < {ENTRIES})""",
    ]
    near = """a{0} AS MATERIALIZED (
  SELECT vec_id, p, min(d) AS d, min_by(e, d * 64 + e) AS e
  FROM (SELECT vec_id, p, e, sum((x.x - c.x) * (x.x - c.x))::BIGINT AS d FROM x JOIN c{0} c USING (p, i) GROUP BY vec_id, p, e)
  GROUP BY vec_id, p)"""
    update = """c{1} AS MATERIALIZED (
  SELECT p, e, i, coalesce(n.x, c.x) AS x FROM c{0} c
  LEFT JOIN (SELECT p, e, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x FROM x JOIN a{0} USING (vec_id, p) GROUP BY p, e, i) n USING (p, e, i))"""
    for k in range(ROUNDS):
        steps += [near.format(k), update.format(k, k + 1)]
    steps.append(near.format(ROUNDS))
    steps.append("""coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{0} GROUP BY vec_id)""".format(ROUNDS))
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) FROM c{ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


SQL = _sql()

"""Near duplicates by an inverted join over MinHash signature coordinates.

1. Every document becomes a set of word shingles (64-bit hashes) and a signature of ``COORDINATES`` minima. Equal sets
   (by a 128-bit digest and the size) are one node from here on, so exact copies cost nothing more.
2. Each node is posted under its (coordinate, value) pairs. A pair that one node alone holds cannot collide, and a link
   at the threshold collides in at least ``T`` coordinates but for a chance below ``MISS``. So a node with fewer than T
   shared pairs is skipped, and of m shared pairs, ordered rarest first, only the first m - T + 1 are joined: two nodes
   with T collisions meet in that prefix. This skips the long posting lists unless a node has nothing rarer.
3. Collisions are counted on a longer signature and links are confirmed on the full sets. First each posting list is
   joined to its smallest node only (a star), which connects most of a group of copies with as many pairs as members.
   Then, only in lists that still hold several components, the nodes outside the list's largest component are compared
   with the others, in tiles of bounded size; a tile emits only the pairs that pass the count. No pair is given up:
   pairs within one component are the only ones left out.
4. Components come from alternating star contraction. Links and labels stay in tables.

Texts without words are linked with nothing; null counts as empty. Rows that share an id count as one document. A
null id names no node: such a row has the component of its equal set, if a row with an id has that set, and null otherwise. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm import wordhash as wh
from floodmark.llm.components import components
from floodmark.llm.textscan import blocks, utf8
from floodmark.plans.staging import stage

NAME = "op4_minhash_near_dedup"
SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM words, unnest(range(1, greatest(len(w) - 1, 2))) r(i) WHERE len(w) > 0
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM shared x JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * x.n >= 85 * (p.n + q.n - x.n)
), ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, w.b FROM reach r JOIN ways w ON w.a = r.other
)
SELECT r.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id, r.doc_id = min(r.other) AS kept
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""
COORDINATES, LONG_COORDINATES, SHORT_COORDINATES = 32, 1024, 256
#: Highest chance, per link at the threshold, that a count of collisions misses it.
MISS = 1e-8
#: Nodes on a side of a tile.
TILE = 1024
_C64 = wh.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
_C32 = (wh.mix(np.arange(1, LONG_COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)) | np.uint64(1)).astype(np.uint32)


@lru_cache
def least_matches(coordinates: int, percent: int) -> int:
    """The largest T with P[Binomial(coordinates, percent / 100) < T] <= MISS."""
    p, total = percent / 100, 0.0
    for t in range(coordinates + 1):
        total += comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if total > MISS:
            return max(t, 1)
    return coordinates


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``size`` make one shingle."""
    data, offsets = utf8(column)
    hashes, cuts = wh.words(data, offsets, lower=True)
    at, rows = wh.windows(hashes, cuts, size)
    shingles = wh.window_hashes(hashes, at, size)
    bounds = np.searchsorted(rows, np.arange(len(column) + 1))
    out = []
    for k in range(len(column)):
        n = cuts[k + 1] - cuts[k]
        if 0 < n < size:
            out.append(wh.window_hashes(hashes[cuts[k] : cuts[k + 1]], np.zeros(1, np.int64), int(n)) ^ np.uint64(n))
        else:
            out.append(np.unique(shingles[bounds[k] : bounds[k + 1]]))
    return out


def minima(values: np.ndarray, constants: np.ndarray) -> np.ndarray:
    """Smallest value of every coordinate's hash, in slices of bounded memory. Its low bits tell the shingle."""
    best = np.full(len(constants), np.iinfo(constants.dtype).max, constants.dtype)
    for at in range(0, len(values), 512):
        part = values[at : at + 512]
        np.minimum(best, ((part[None, :] ^ constants[:, None]) * constants[:, None]).min(1), out=best)
    return best


def _digest(values: np.ndarray) -> tuple[int, int]:
    return tuple(int(wh.mix(values ^ c).sum().view(np.int64)) for c in _C64[:2])


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """``_id``, set size ``_n``, set digest ``_d1``, ``_d2`` and ``_tokens``: (coordinate, value) pairs as numbers."""
    kind = docs.schema["_id"].dataType.simpleString()
    place = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, 1, 2 << 20):
            sets = shingle_sets(part.column(1), size)
            digests = [_digest(s) for s in sets]
            tokens = [((minima(wh.mix(s), _C64) & np.uint64(0xFFFFFFFF)) | place).view(np.int64) if len(s) else [] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), *(pa.array([d[k] for d in digests], pa.int64()) for k in (0, 1)), pa.array(tokens, pa.list_(pa.int64()))],
                ["_id", "_n", "_d1", "_d2", "_tokens"],
            )

    return docs.mapInArrow(run, f"_id {kind}, _n long, _d1 long, _d2 long, _tokens array<long>")


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """``_id``, digest, ``_set`` (sorted hashes as bytes) and ``_long`` (one byte per coordinate of the long signature)."""
    kind = docs.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, 1, 2 << 20):
            sets = shingle_sets(part.column(1), size)
            digests = [_digest(s) for s in sets]
            longs = [minima((wh.mix(s) >> np.uint64(32)).astype(np.uint32), _C32).astype(np.uint8).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array([d[k] for d in digests], pa.int64()) for k in (0, 1)), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(longs, pa.binary())],
                ["_id", "_d1", "_d2", "_set", "_long"],
            )

    return docs.mapInArrow(run, f"_id {kind}, _d1 long, _d2 long, _set binary, _long binary")


def prefixes(nodes: DataFrame, least: int) -> DataFrame:
    """``_node`` and ``_prefix``: its rarest shared pairs, as many as T collisions need."""
    posted = nodes.select("_node", F.explode("_tokens").alias("_token"))
    shared = posted.groupBy("_token").agg(F.count("*").alias("_df")).where("_df > 1")
    held = posted.join(shared, "_token").groupBy("_node").agg(F.sort_array(F.collect_list(F.struct("_df", "_token"))).alias("_held"))
    held = held.where(F.size("_held") >= least)
    rare = F.slice("_held", F.lit(1), F.size("_held") - (least - 1))
    return held.select("_node", F.transform(rare, lambda x: x["_token"]).alias("_prefix"))


def _filtered(pairs: DataFrame, left: str, right: str, keep) -> DataFrame:
    """Pairs of binaries for which ``keep`` (two lists of byte strings -> mask) holds; the binaries are dropped."""
    names = [c for c in pairs.columns if c not in (left, right)]
    schema = pairs.select(*names).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = keep(batch.column(left).to_pylist(), batch.column(right).to_pylist()) if batch.num_rows else []
            yield batch.select(names).filter(pa.array(mask, pa.bool_()))

    return pairs.mapInArrow(run, schema)


def _colliding(long: np.ndarray, others: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of ``others`` collide often enough with ``long`` (one row, or a row each); a part is counted first."""
    part = slice(0, SHORT_COORDINATES)
    enough = (others[:, part] == long[..., part]).sum(1) >= least_matches(SHORT_COORDINATES, percent)
    at = np.flatnonzero(enough)
    rest = long[at] if long.ndim > 1 else long
    enough[at] = (others[at] == rest).sum(1) >= least_matches(LONG_COORDINATES, percent)
    return enough


def _longs(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint8).reshape(-1, LONG_COORDINATES)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, counted: bool) -> DataFrame:
    """Pairs (``_a``, ``_b``) whose full sets reach the threshold; collisions come first unless they are ``counted``."""

    def collide(a: list[bytes], b: list[bytes]) -> np.ndarray:
        return _colliding(_longs(a), _longs(b), percent)

    def alike(a: list[bytes], b: list[bytes]) -> list[bool]:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return out

    for column, keep in (("_long", collide), ("_set", alike))[counted:]:
        a, b = (sets.select(F.col("_node").alias(k), F.col(column).alias(f"{k}x")) for k in ("_a", "_b"))
        # staged, so that a task never holds the Python workers of two filters
        pairs = stage(_filtered(pairs.join(a, "_a").join(b, "_b"), "_ax", "_bx", keep), "pairs")
    return pairs


def stars(posted: DataFrame) -> DataFrame:
    """Each posting list's smallest node paired with its other nodes."""
    hubs = posted.groupBy("_token").agg(F.min("_node").alias("_a"), F.count("*").alias("_many")).where("_many > 1")
    pairs = posted.join(hubs, "_token").where("_node <> _a")
    return pairs.select("_a", F.col("_node").alias("_b")).distinct()


def across(posted: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes from different components that share a list and pass the count of collisions.

    In each list the nodes outside its largest component are laid out against all nodes, in tiles of about TILE x TILE.
    """
    own = posted.join(labels.withColumnRenamed("node", "_node"), "_node", "left")
    own = own.select("_token", "_node", F.coalesce("component", "_node").alias("_label"))
    sizes = own.groupBy("_token", "_label").agg(F.count("*").alias("_k"))
    lists = sizes.groupBy("_token").agg(F.sum("_k").alias("_all"), F.max(F.struct("_k", "_label")).alias("_main"))
    lists = lists.where("_main._k < _all").select(
        "_token",
        F.col("_main._label").alias("_largest"),
        F.ceil((F.col("_all") - F.col("_main._k")) / TILE).cast("int").alias("_rows"),
        F.ceil(F.col("_all") / TILE).cast("int").alias("_cols"),
    )
    nodes = own.join(lists, "_token").join(sets.select("_node", "_long", "_prefix"), "_node")
    slot = F.xxhash64("_node")
    small = nodes.where("_label <> _largest").withColumns({"_r": F.pmod(slot, "_rows"), "_c": F.explode(F.sequence(F.lit(0).cast("long"), F.col("_cols") - F.lit(1).cast("long"))), "_side": F.lit(0)})
    every = nodes.withColumns({"_c": F.pmod(slot, "_cols"), "_r": F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - F.lit(1).cast("long"))), "_side": F.lit(1)})
    columns = ["_token", "_r", "_c", "_side", "_node", "_label", "_long", "_prefix"]
    tiles = small.select(*columns).unionByName(every.select(*columns))
    node_type = tiles.schema["_node"].dataType.simpleString()

    def compare(tile: pa.Table) -> pa.Table:
        tile = tile.combine_chunks()
        side = tile.column("_side").to_numpy()
        token = tile.column("_token")[0].as_py()
        labels = tile.column("_label").to_pylist()
        codes = np.unique(np.array(labels, dtype=object).astype(str), return_inverse=True)[1]
        long = _longs(tile.column("_long").to_pylist())
        node, prefix = tile.column("_node").to_pylist(), tile.column("_prefix").to_pylist()
        rows, cols = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        found: set[tuple] = set()
        for i in rows:
            other = cols[codes[cols] != codes[i]]
            for j in other[_colliding(long[i], long[other], percent)]:
                if min(set(prefix[i]) & set(prefix[j])) == token:  # the other lists that both are in leave the pair to this one
                    found.add((min(node[i], node[j]), max(node[i], node[j])))
        kind = tile.schema.field("_node").type
        return pa.table([pa.array([p[k] for p in found], kind) for k in (0, 1)], names=["_a", "_b"])

    return tiles.groupBy("_token", "_r", "_c").applyInArrow(compare, f"_a {node_type}, _b {node_type}").distinct()


def near_groups(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id``, ``n_shingles`` and ``component_id`` of every row: documents are linked when
    100 * intersection >= percent * union of their sets of ``size``-word shingles."""
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    signed = stage(signatures(texts, size), "signatures")
    key = ["_d1", "_d2", "_n"]
    nodes = signed.where("_n > 0").groupBy(*key).agg(F.min("_id").alias("_node"), F.max("_tokens").alias("_tokens"))
    nodes = stage(nodes.where("_node is not null"), "nodes")
    chosen = stage(prefixes(nodes, least_matches(COORDINATES, percent)), "prefixes")
    wanted = chosen.join(nodes.select("_node", "_d1", "_d2"), "_node")
    sets = full_sets(texts.join(chosen.select(F.col("_node").alias("_id")), "_id", "left_semi"), size)
    sets = sets.withColumnRenamed("_id", "_node").join(wanted, ["_node", "_d1", "_d2"]).drop("_d1", "_d2")
    sets = stage(sets.dropDuplicates(["_node"]), "sets")
    posted = chosen.select("_node", F.explode("_prefix").alias("_token"))
    links = confirmed(stars(posted), sets, percent, counted=False)
    labels = components(links, "_a", "_b")
    more = confirmed(stage(across(posted, sets, labels, percent), "tile-pairs"), sets, percent, counted=True)
    labels = components(links.unionByName(more), "_a", "_b")
    found = signed.select("_id", *key).join(nodes.select(*key, "_node"), key, "left")
    found = found.join(labels.select(F.col("node").alias("_node"), "component"), "_node", "left")
    return found.select("_id", F.col("_n").alias("n_shingles"), F.coalesce("component", "_node", "_id").alias("component_id"))


def dedup(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, with all their columns."""
    names = [F.col(c) for c in docs.columns]
    gone = near_groups(docs, size, percent, id_column, text_column).where("_id <> component_id")
    gone = gone.select(F.col("_id").alias("__gone_id")).distinct()
    return docs.join(gone, F.col(id_column) == F.col("__gone_id"), "left_anti").select(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, 85)
    return found.select(F.col("_id").alias("doc_id"), "n_shingles", "component_id", (F.col("_id") == F.col("component_id")).alias("kept"))

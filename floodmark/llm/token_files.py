"""Token ids as binary files: bit-packed blocks with offsets, written in the order of the document ids.

``packed_tokens`` is a data source that Spark writes and reads. Every partition becomes one shard file:

    "FMTOKENS", version and bits per id (two 32-bit numbers)
    blocks of up to ``BLOCK_IDS`` ids, each packed to the fewest bits that hold the vocabulary (``bitpack``)
    index: byte offset and CRC-32 of every block, ids of the documents, which of them are null, end of each in ids
    trailer: numbers of ids, documents and blocks, ids per block, place of the index, "FMTOKENS"

Documents lie one behind the other and cross blocks freely, so a reader finds any document, or any stretch of ids, from the index
and unpacks the blocks that hold it. The commit on the driver lists the shards of the tasks that Spark
accepted, with their sizes, in ``_shards.json``; files of lost or repeated attempts are not listed and so never
read. All numbers are little-endian. Folders may be local, shared, or any store that pyarrow opens by its URI.

``write_tokens`` deals documents to shards by ranges of the id (equal ids further by row, so that a repeated id cannot fill one
shard), sorts, encodes and writes. Reading gives every document's first position among all ids.

Null and empty texts have the end id alone. Null document ids come first and stay null. Repeated ids keep all their rows, next
to each other. An empty table gives an empty folder listing and reads back empty. Columns other than id and text are not
read, whatever their names. A text of any length is encoded whole, in one task.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from floodmark.llm import bitpack
from floodmark.llm.occurrences import parts
from floodmark.llm.textscan import blocks
from floodmark.llm.word_codec import tokenizer
from floodmark.plans.staging import scratch_path

NAME = "op13_token_files"
SQL = None
VOCABULARY = "word_bpe_49k.json"
END_ID = 1
FORMAT = "packed_tokens"
MAGIC, VERSION = b"FMTOKENS", 1
_HEAD, _TRAILER = struct.Struct("<8sII"), struct.Struct("<QQQQQ8s")
#: Ids of a block (a multiple of the packing group); file bytes of the input per shard; documents per batch that a reader gives.
BLOCK_IDS, SHARD_BYTES, READ_DOCS = 1 << 16, 32 << 20, 2048
LISTING = "_shards.json"
SCHEMA = "doc_id long, start long, n_tokens long, ids binary"


def file_system(path: str):
    """pyarrow's file system of a folder, and the folder's path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


class ShardWriter:
    """One shard file, written block by block; memory holds a block and the index."""

    def __init__(self, out, bits: int):
        self.out, self.bits, self.held, self.size = out, bits, [], 0
        self.offsets, self.sums, self.ids, self.nulls, self.ends, self.tokens = [], [], [], [], [], 0
        out.write(_HEAD.pack(MAGIC, VERSION, bits))
        self.at = _HEAD.size

    def add(self, ids: np.ndarray, doc_ids: pa.Array, cuts: np.ndarray) -> None:
        """Documents with their ids, document ``k`` in ``ids[cuts[k]:cuts[k + 1]]``."""
        self.nulls.append(doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
        self.ids.append(doc_ids.fill_null(0).to_numpy().astype("<i8"))
        self.ends.append((self.tokens + cuts[1:]).astype("<u8"))
        self.tokens += int(cuts[-1])
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= BLOCK_IDS:
            self._flush(self.size // BLOCK_IDS * BLOCK_IDS)

    def _flush(self, many: int) -> None:
        ids = np.concatenate(self.held)
        for a in range(0, many, BLOCK_IDS):
            block = bitpack.pack(ids[a : min(a + BLOCK_IDS, many)], self.bits)
            self.offsets.append(self.at)
            self.sums.append(zlib.crc32(block))
            self.out.write(block)
            self.at += len(block)
        self.held, self.size = [ids[many:]], len(ids) - many

    def close(self) -> None:
        if self.size:
            self._flush(self.size)
        index = [np.array([*self.offsets, self.at], "<u8"), np.array(self.sums, "<u4")]
        index += [np.concatenate(x) if x else np.zeros(0, t) for x, t in ((self.ids, "<i8"), (self.nulls, "u1"), (self.ends, "<u8"))]
        for part in index:
            self.out.write(part.tobytes())
        documents = sum(map(len, self.ids))
        self.out.write(_TRAILER.pack(self.tokens, documents, len(self.sums), BLOCK_IDS, self.at, MAGIC))
        self.out.close()


class Shard:
    """Random access to a shard file: the index is read once, blocks when asked for."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        magic, version, self.bits = _HEAD.unpack(file.read_at(_HEAD.size, 0))
        self.n_tokens, self.n_docs, n_blocks, self.block_ids, at, end = _TRAILER.unpack(file.read_at(_TRAILER.size, size - _TRAILER.size))
        if magic != MAGIC or end != MAGIC or version != VERSION:
            raise ValueError("not a shard of packed tokens, or of another version")
        raw, place = file.read_at(size - _TRAILER.size - at, at), 0
        out = []
        for kind, count in (("<u8", n_blocks + 1), ("<u4", n_blocks), ("<i8", self.n_docs), ("u1", self.n_docs), ("<u8", self.n_docs)):
            out.append(np.frombuffer(raw, kind, count, place))
            place += out[-1].nbytes
        self.offsets, self.sums, self.doc_ids, self.nulls, ends = out
        self.cuts = np.append(0, ends.astype(np.int64))

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids from position ``start`` up to ``stop``, from the blocks that hold them."""
        if not 0 <= start <= stop <= self.n_tokens:
            raise IndexError(f"ids {start} to {stop} of {self.n_tokens}")
        if start == stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        base = int(self.offsets[first])
        raw = memoryview(self.file.read_at(int(self.offsets[last + 1]) - base, base))
        found = []
        for b in range(first, last + 1):
            block = raw[int(self.offsets[b]) - base : int(self.offsets[b + 1]) - base]
            if zlib.crc32(block) != self.sums[b]:
                raise ValueError(f"block {b} is damaged")
            found.append(bitpack.unpack(block, min(self.block_ids, self.n_tokens - b * self.block_ids), self.bits))
        return np.concatenate(found)[start - first * self.block_ids : stop - first * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        """Ids of the shard's ``k``-th document."""
        return self.tokens(int(self.cuts[k]), int(self.cuts[k + 1]))

    def batches(self, before: int) -> Iterator[pa.RecordBatch]:
        """All documents as rows of ``SCHEMA``; ``before`` ids precede the shard."""
        a = 0
        while a < self.n_docs:  # some documents, or ids of about four blocks, at a time
            b = int(np.searchsorted(self.cuts, self.cuts[a] + 4 * self.block_ids, "right")) - 1
            b = min(max(b, a + 1), a + READ_DOCS, self.n_docs)
            own = self.cuts[a : b + 1]
            data = self.tokens(int(own[0]), int(own[-1])).astype("<u4").tobytes()
            bounds = 4 * (own - own[0])
            ids = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
            columns = [
                pa.array(self.doc_ids[a:b], pa.int64(), mask=self.nulls[a:b].astype(bool)), pa.array(before + own[:-1]),
                pa.array(np.diff(own)), ids.cast(pa.binary()) if len(data) < 1 << 31 else ids,
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])
            a = b


@dataclass
class Written(WriterCommitMessage):
    partition: int
    file: str = ""
    documents: int = 0
    tokens: int = 0


@dataclass
class Part(InputPartition):
    """A shard and the number of ids before it."""

    file: str
    before: int


class TokenWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.bits = bitpack.width_of(int(options["vocabulary"]))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = file_system(self.path)
        partition = TaskContext.get().partitionId()
        name, shard = f"shard-{partition:06d}-{uuid.uuid4().hex}.tokens", None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if shard is None:
                system.create_dir(folder, recursive=True)
                shard = ShardWriter(system.open_output_stream(f"{folder}/{name}"), self.bits)
            packed = batch.column("ids").cast(pa.large_binary()).fill_null(b"")
            bounds = np.frombuffer(packed.buffers()[1], np.int64)[packed.offset : packed.offset + len(packed) + 1]
            raw = packed.buffers()[2]
            ids = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]].view("<u4") if raw is not None and bounds[-1] > bounds[0] else np.zeros(0, "<u4")
            shard.add(ids, batch.column("doc_id").cast(pa.int64()), (bounds - bounds[0]) // 4)
        if shard is None:
            return Written(partition)
        shard.close()
        return Written(partition, name, sum(map(len, shard.ids)), shard.tokens)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = file_system(self.path)
        system.create_dir(folder, recursive=True)
        listing = f"{folder}/{LISTING}"
        if not self.overwrite and system.get_file_info(listing).is_file:
            raise FileExistsError(f"{self.path} holds tokens already")
        done = sorted((m for m in messages if m is not None and m.file), key=lambda m: m.partition)
        shards = [{"file": m.file, "documents": m.documents, "tokens": m.tokens} for m in done]
        with system.open_output_stream(f"{listing}.new") as out:
            out.write(json.dumps({"version": VERSION, "bits": self.bits, "shards": shards}).encode())
        system.move(f"{listing}.new", listing)

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = file_system(self.path)
        for m in messages:
            if m is not None and m.file:
                system.delete_file(f"{folder}/{m.file}")


class TokenReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[Part]:
        system, folder = file_system(self.path)
        with system.open_input_stream(f"{folder}/{LISTING}") as listing:
            shards = json.loads(listing.read())["shards"]
        before = np.cumsum([0] + [s["tokens"] for s in shards]).tolist()
        return [Part(s["file"], n) for s, n in zip(shards, before)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a folder without shards is read as one empty partition
            return
        system, folder = file_system(self.path)
        with system.open_input_file(f"{folder}/{partition.file}") as file:
            yield from Shard(file).batches(partition.before)


class PackedTokens(DataSource):
    """Options: ``path``; ``vocabulary`` (number of ids) for writing. Modes append (to a folder without tokens) and overwrite."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        return TokenWriter(self.options, overwrite)

    def reader(self, schema) -> TokenReader:
        return TokenReader(self.options)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian 32-bit numbers with the end id) of rows (doc_id, text), in their order."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for part in blocks(batches, 1, 4 << 20):
            ids, cuts = own.encode(part.column(1))
            raw, at = ids.astype("<u4").tobytes(), (4 * cuts).tolist()
            rows = [raw[a:b] + end for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.binary())], ["doc_id", "ids"])

    return docs.mapInArrow(run, "doc_id long, ids binary")


def write_tokens(docs: DataFrame, path: str, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Write ``docs`` to the folder ``path`` in ascending order of the id (an integer)."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("_text"))
    shards = parts(narrow, "_text", SHARD_BYTES)
    dealt = narrow.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(shards, "doc_id", "_row")
    ordered = dealt.sortWithinPartitions("doc_id", "_row").select("doc_id", "_text")
    spark.dataSource.register(PackedTokens)
    size = tokenizer(vocabulary).vocabulary
    encode(ordered, vocabulary).write.format(FORMAT).option("vocabulary", size).mode("append").save(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``SCHEMA`` of a folder of token files."""
    spark.dataSource.register(PackedTokens)
    return spark.read.format(FORMAT).load(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path(VOCABULARY))
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

"""First lines of the files of a folder, without reading the files.

``first_lines`` is a data source whose partitions are groups of files: a task opens each of its files through pyarrow's file system
for the folder's URI (local, shared, or a store that pyarrow knows) and reads blocks of a few kilobytes until a line ends. Paths
stay in a table; the driver lists the folder only.

Columns: ``source_path`` (as Spark's file metadata names it), ``source_bytes``, ``header`` (null for an empty or unreadable file),
``bytes_read`` and ``loss`` (why a file could not be read, else null). Compressed files (.gz, .bz2, .zst) are
unpacked as far as needed. As in Spark's own scans, names that begin with ``_`` or ``.`` are left out, and of folders below the given
one only those named like partitions (``key=value``) are entered.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "first_lines"
SCHEMA = "source_path string, source_bytes long, header string, bytes_read long, loss string"
#: Bytes read at a time, files of a partition, longest first line.
STEP_BYTES, FILES_PER_PART, LONGEST = 4096, 256, 1 << 24
CODECS = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd"}


def file_system(path: str):
    """pyarrow's file system of a path, the path in it, and the prefix that Spark puts before paths of it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + unquote(path[5:]).lstrip("/")
    system, inner = fs.FileSystem.from_uri(path)
    if isinstance(system, fs.LocalFileSystem):
        return system, inner, "file:"
    scheme, _, rest = path.partition("://")
    prefix = f"{scheme}://" + ("" if inner.startswith(rest.split("/")[0]) else rest.split("/")[0])
    return system, inner, prefix


def listable(path: str) -> bool:
    """Whether a path can be listed here: no pattern, and a file system that pyarrow opens by its URI."""
    scheme = path.partition("://")[0] if "://" in path else path.partition(":")[0] if path.startswith("file:") else "file"
    return scheme in ("file", "hdfs", "s3", "gs") and not any(c in path for c in "*?[{")


def seen(inner: str) -> bool:
    """Whether Spark's scans read a file, by its path within the folder."""
    *folders, name = inner.strip("/").split("/")
    return all("=" in f for f in folders) and not name.startswith(("_", "."))


def first_line(stream) -> tuple[str | None, int]:
    """The first line of an open stream without its end, and the bytes read for it; nothing for an empty stream."""
    held = b""
    while len(held) < LONGEST:
        more = stream.read(STEP_BYTES)
        held += more
        if not more or b"\n" in more or b"\r" in more[:-1]:
            break
    if not held:
        return None, 0
    line = held.split(b"\n", 1)[0].split(b"\r", 1)[0]
    return line.decode("utf-8", "replace"), len(held)


@dataclass
class Files(InputPartition):
    """A group of files: paths in the file system and their sizes."""

    files: list


class HeaderReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folders = [unquote(p) for p in options["folders"].split("\n")]

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        found = []
        for folder in self.folders:
            system, inner, _ = file_system(folder)
            info = system.get_file_info(inner)
            listed = [info] if info.is_file else system.get_file_info(fs.FileSelector(inner, recursive=True))
            found += [(folder, f.path, f.size) for f in listed if f.is_file and seen(f.path[len(inner) :])]
        found.sort()
        return [Files(found[at : at + FILES_PER_PART]) for at in range(0, len(found), FILES_PER_PART)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        rows, own = [], partition.files if partition is not None else []
        for folder, path, size in own:
            system, _, prefix = file_system(folder)
            header, read, loss = None, 0, None
            try:
                codec = CODECS.get(posixpath.splitext(path)[1])
                with system.open_input_stream(path, compression=codec, buffer_size=None) as stream:
                    header, read = first_line(stream)
            except (OSError, ValueError) as error:  # the file's own trouble, reported beside the others
                loss = str(error).strip().splitlines()[0][:300]
            rows.append((prefix + quote(path, safe="/:+=@,~!$&'()*;"), size, header, read, loss))
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())
        names = ["source_path", "source_bytes", "header", "bytes_read", "loss"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)


class FirstLines(DataSource):
    """Option ``folders``: folders or files, percent-encoded, one a line."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HeaderReader:
        return HeaderReader(self.options)


def first_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows of ``SCHEMA`` for every file of a folder (or of several folders and files)."""
    spark.dataSource.register(FirstLines)
    folders = [path] if isinstance(path, str) else path
    return spark.read.format(FORMAT).option("folders", "\n".join(quote(p, safe="/:") for p in folders)).load()

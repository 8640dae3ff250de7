"""Vectorised scans over the UTF-8 buffers of Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def blocks(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose text column holds about ``most_bytes`` (at least one row, so one long text, each)."""
    for batch in batches:
        _, offsets = utf8(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most_bytes, "right")) - 1)
            stop = min(stop, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets into them; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n, first = len(column), column.offset
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[first : first + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_class(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


def runs(mask: np.ndarray, offsets: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True of at least ``least`` bytes; runs end where a text ends."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.zeros(len(mask) + 2, np.int8)
    padded[1:-1] = mask
    edges = np.flatnonzero(np.diff(padded))
    starts, ends = edges[::2], edges[1::2]
    inner = np.unique(offsets[1:-1])
    inner = inner[(inner > 0) & (inner < len(mask))]
    inner = inner[mask[inner - 1] & mask[inner]]
    if len(inner):
        starts, ends = np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))
    long = ends - starts >= least
    return starts[long], ends[long]


def owner(at: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the text in which each byte position lies."""
    return np.searchsorted(offsets, at, "right") - 1


class CodePoints:
    """Code point offsets of byte positions within their texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.before = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=self.before[1:])
        self.base = self.before[offsets[:-1]]

    def of(self, at: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.before[at] - self.base[row]

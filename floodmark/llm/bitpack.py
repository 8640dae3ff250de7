"""Fixed-width bit packing of ids and its inverse, in numpy.

Ids of ``bits`` bits lie one behind the other in a little-endian bit stream. 64 ids fill exactly ``bits`` 64-bit words, so ids
are packed in groups of 64, all groups side by side: lane ``j`` of every group goes to the same word and shift. The last group
is filled with zeros. Whatever is a multiple of 64 ids can be read without anything before it.
"""

from __future__ import annotations

import numpy as np

#: Ids of a group.
LANES = 64


def width_of(vocabulary: int) -> int:
    """Least bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def packed_bytes(ids: int, bits: int) -> int:
    """Bytes that ``ids`` ids take, with the filled last group."""
    return -(-ids // LANES) * bits * 8


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Packed bytes of unsigned ids; an id that needs more than ``bits`` bits raises."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} needs more than {bits} bits")
    groups = -(-len(ids) // LANES)
    lanes = np.zeros((LANES, groups), np.uint64)
    filled = np.zeros(groups * LANES, np.uint64)
    filled[: len(ids)] = ids
    lanes[:] = filled.reshape(groups, LANES).T
    words = np.zeros((bits, groups), np.uint64)
    for j in range(LANES):
        word, shift = divmod(j * bits, 64)
        words[word] |= lanes[j] << np.uint64(shift)
        if shift + bits > 64:
            words[word + 1] |= lanes[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").tobytes()


def unpack(data: bytes | memoryview, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of packed bytes, as unsigned 32-bit numbers."""
    words = np.ascontiguousarray(np.frombuffer(data, "<u8").reshape(-1, bits).T)
    mask = np.uint64((1 << bits) - 1)
    lanes = np.empty((LANES, words.shape[1]), np.uint32)
    for j in range(LANES):
        word, shift = divmod(j * bits, 64)
        value = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[word + 1] << np.uint64(64 - shift))
        lanes[j] = value & mask
    return lanes.T.reshape(-1)[:count]

"""CRC-32 of any stretch of a byte string from two running values.

The CRC register is linear over GF(2). With ``P[i]`` the register after the first ``i`` bytes (started at zero), the register of the
bytes ``a`` to ``b`` alone is ``P[b]`` with ``P[a]``, moved on by ``b - a`` zero bytes, cancelled out. Moving on is a linear
map too; its tables, one per byte of the register, are kept for every length below 256 and for 256 times every power of two.

The running values themselves are computed once per byte, in ``LANES`` equal lanes side by side, whose start values are then added.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

POLYNOMIAL = 0xEDB88320
_ONES, _BYTE, _EIGHT = np.uint32(0xFFFFFFFF), np.uint32(0xFF), np.uint32(8)
LANES = 4096


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return table


_TABLE = _byte_table()


def _next(register: np.ndarray) -> np.ndarray:
    """The register after one more zero byte."""
    return (register >> _EIGHT) ^ _TABLE[register & _BYTE]


def _apply(tables: np.ndarray, base: np.ndarray | int, register: np.ndarray) -> np.ndarray:
    """A map given by four tables of 256, which begin at ``base`` of the flat ``tables``."""
    out = tables[base + (register & _BYTE)]
    for k in (1, 2, 3):
        out = out ^ tables[base + 256 * k + ((register >> np.uint32(8 * k)) & _BYTE)]
    return out


@lru_cache(maxsize=1)
def _short() -> np.ndarray:
    """Tables of the moves by 0 to 255 bytes, 1024 numbers each."""
    column = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32)[:, None])).reshape(-1)
    rows = [column]
    for _ in range(255):
        rows.append(_next(rows[-1]))
    return np.concatenate(rows)


@lru_cache(maxsize=64)
def _long(power: int) -> np.ndarray:
    """Tables of the move by ``256 << power`` bytes."""
    if power:
        half = _long(power - 1)
        return _apply(half, 0, half)
    return _next(_short()[255 * 1024 :])


def moved(register: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Every register moved on by its number of zero bytes."""
    out = _apply(_short(), (lengths & 255) * 1024, register)
    far, power = lengths >> 8, 0
    while far.any():
        some = np.flatnonzero(far & 1)
        out[some] = _apply(_long(power), 0, out[some])
        far, power = far >> 1, power + 1
    return out


def running(data: np.ndarray) -> np.ndarray:
    """The n + 1 running values of a byte string."""
    n = len(data)
    steps = -(-n // LANES)
    if not steps:
        return np.zeros(1, np.uint32)
    padded = np.zeros(LANES * steps, np.uint8)
    padded[:n] = data
    columns = np.ascontiguousarray(padded.reshape(LANES, steps).T)
    out = np.empty((steps, LANES), np.uint32)
    register = np.zeros(LANES, np.uint32)
    for k in range(steps):
        register = (register >> _EIGHT) ^ _TABLE[(register ^ columns[k]) & _BYTE]
        out[k] = register
    # what a lane starts with is the end of the one before, moved on by a lane
    t0, t1, t2, t3 = moved(_short()[:1024], np.full(1024, steps)).reshape(4, 256).tolist()
    starts, carry = [], 0
    for end in register.tolist():
        starts.append(carry)
        carry = end ^ t0[carry & 255] ^ t1[carry >> 8 & 255] ^ t2[carry >> 16 & 255] ^ t3[carry >> 24]
    start = np.array(starts, np.uint32)
    for k in range(steps):
        start = _next(start)
        out[k] ^= start
    return np.append(np.uint32(0), out.T.reshape(-1)[:n])


def of_stretches(prefixes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of the bytes from each start to its end."""
    return prefixes[ends] ^ moved(prefixes[starts] ^ _ONES, ends - starts) ^ _ONES

"""Vectorised 64-bit hashes of words and of word sequences in UTF-8 buffers.

A word is a run of bytes other than ASCII white space. Its hash sums its 8-byte blocks, each mixed with its place first, so
no two words are equal by the algebra of a polynomial; a second hash mixes other numbers in. A window's hash combines
those of its halves, again through the mix. Blocks of texts need a handful of numpy passes. Hashes depend on the bytes alone and
agree between tasks, runs and machines. ``stretches`` (polynomials modulo 2**64 over random byte values) serves short strings
of bounded length only: from 1,024 bytes on there are strings on which it fails for every base.
"""

from __future__ import annotations

import numpy as np

from floodmark.llm.textscan import runs

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_R, _S1, _S2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _R)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base and of its inverse."""
    known = _powers.get(int(base))
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        tables = []
        for factor in (base, inverse):
            table = np.full(size, factor, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table))
        _powers[int(base)] = known = tuple(tables)
    return known


def stretches(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hash of every stretch ``values[start:end]``."""
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def _blocked(part: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: np.uint64) -> np.ndarray:
    """Hash of every word from its 8-byte blocks (the last one filled with zeros) and its length."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    many = (lengths + 7) // 8
    first = np.cumsum(many) - many
    word = np.repeat(np.arange(len(starts)), many)
    place = np.arange(len(word)) - first[word]
    padded = np.concatenate([part, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(part) + 1, "<u8", padded, strides=(1,))
    block = eights[starts[word] + 8 * place] & _TAIL[np.minimum(lengths[word] - 8 * place, 8)]
    spot = mix((place + 1).astype(np.uint64) * seed)
    sums = np.add.reduceat(mix((block ^ spot) * seed), first)
    return mix(sums + lengths.astype(np.uint64) * _R)


def words(
    data: np.ndarray, offsets: np.ndarray, lower: bool = False, second: bool = False, block: int = 1 << 20
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the n + 1 offsets of the texts into them; whole texts of about ``block`` bytes at a time."""
    hashes, cuts, n, row = [], [np.zeros(1, np.int64)], 0, 0
    while row < len(offsets) - 1:
        stop = max(int(np.searchsorted(offsets, offsets[row] + block, "right")) - 1, row + 1)
        part, own = data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        starts, ends = runs(~_SPACE[part], own)
        hashes.append(_blocked(_LOWER[part] if lower else part, starts, ends, _S2 if second else _S1))
        cuts.append(n + np.searchsorted(starts, own[1:]))
        n, row = n + len(starts), stop
    return np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate(cuts)


def windows(hashes: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``size`` words within one text, and the text of each."""
    counts = np.maximum(np.diff(offsets) - (size - 1), 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return np.arange(len(rows)) - first[rows] + offsets[:-1][rows], rows


def window_hashes(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each of ``at``: doubled spans of words, put together as the size's bits say."""
    if not len(at):
        return np.zeros(0, np.uint64)
    span, level, done, out = 1, hashes, 0, np.full(len(at), size, np.uint64)
    while True:
        if size & span:
            out = mix(out * _S1 + level[at + done])
            done += span
        if done == size:
            return out
        level = mix(level[:-span] * _S2 + level[span:])
        span *= 2

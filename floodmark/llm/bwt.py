"""Burrows-Wheeler transforms of string collections, merged by interleave refinement.

A shard is a set of strings with its suffixes sorted; its transform gives, for every suffix in order, the STEP symbols in
front of it and the place of the suffix that starts there. Merging starts from an interleave that lists whole shards one
after the other. A step follows the transforms: all suffixes move STEP symbols to the left and are dealt out stably by these
symbols, so an interleave that was right for the first h symbols is right for h + STEP. No suffix is compared or sorted
again. Blocks of the interleave are suffixes not told apart so far; the step in which a border appears gives the common
prefix, and the blocks left at the end are the repeated intervals. A suffix that is alone in its block, or too short, stays
so in all further steps and is left out of them.
"""

from __future__ import annotations

import numpy as np

STEP = 4


def step_keys(text: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Dense ranks of the STEP symbols from every suffix on (a string's end sorts before every byte)."""
    left = ends[owner] - np.arange(len(text))
    keys = np.zeros(len(text), np.uint64)
    padded = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(STEP, np.uint64)])
    for k in range(STEP):
        keys = (keys << np.uint64(9)) | np.where(left > k, padded[k : k + len(text)], np.uint64(0))
    return np.unique(keys, return_inverse=True)[1]


def suffix_order(first: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Suffixes of one shard in order, equal ones by place (prefix doubling from STEP-symbol ranks)."""
    n, h = len(first), STEP
    place = np.arange(n)
    inside = ends[owner]
    longest = int((inside - place).max(initial=0))
    rank = np.unique(first, return_inverse=True)[1]
    while h < longest and (not n or rank.max() + 1 < n):
        ahead = place + h
        behind = np.where(ahead < inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        both = rank * (n + 2) + behind
        order = np.argsort(both)
        both = both[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(both[1:] != both[:-1])])
        h *= 2
    return np.argsort(rank, kind="stable")


def repeated_blocks(lengths: np.ndarray, text: np.ndarray, shards: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share their first ``depth`` symbols with another one: places in ``text`` and block numbers.

    ``lengths``: of the strings that follow each other in ``text``; ``shards``: the shard of every string. ``depth`` is
    a multiple of STEP. Strings are at least STEP long.
    """
    ends = np.cumsum(lengths)
    starts = ends - lengths
    owner = np.repeat(np.arange(len(lengths)), lengths)
    keys = step_keys(text, ends, owner)
    small = keys.max(initial=0) < 1 << 16
    keys = keys.astype(np.uint16 if small else np.uint32)  # 16-bit keys are dealt out by a radix sort
    # the shards' sorted suffixes one after the other, and their transforms: symbols in front, and where they lead
    order = []
    for shard in np.unique(shards):
        own = np.flatnonzero(shards[owner] == shard)
        chosen = shards == shard
        local_ends = np.cumsum(lengths[chosen])
        local_owner = np.repeat(np.arange(len(local_ends)), lengths[chosen])
        order.append(own[suffix_order(keys[own], local_ends, local_owner)])
    order = np.concatenate(order).astype(np.int32) if order else np.zeros(0, np.int32)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    moves = order - starts[owner[order]] >= STEP
    ahead = np.maximum(order - STEP, 0)
    in_front, leads_to = keys[ahead], rank[ahead]
    # the first STEP symbols: the suffixes that have them, dealt out by their own symbols
    interleave = np.flatnonzero(ends[owner[order]] - order >= STEP).astype(np.int32)
    symbols, blocks = keys[order[interleave]], np.zeros(len(interleave), np.int32)
    for h in range(STEP, depth + 1, STEP):
        if h > STEP:
            moving = moves[interleave]
            source = interleave[moving]
            symbols, interleave, blocks = in_front[source], leads_to[source], blocks[moving]
        dealt = np.argsort(symbols, kind="stable")
        symbols, interleave, blocks = symbols[dealt], interleave[dealt], blocks[dealt]
        border = np.ones(len(dealt) + 1, bool)
        border[1:-1] = (symbols[1:] != symbols[:-1]) | (blocks[1:] != blocks[:-1])
        twins = ~(border[:-1] & border[1:])
        interleave, blocks = interleave[twins], np.cumsum(border[:-1], dtype=np.int32)[twins]
        if not len(interleave):
            break
    return order[interleave].astype(np.int64), blocks

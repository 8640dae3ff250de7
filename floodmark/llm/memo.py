"""A bounded memo for text chunks that repeat within and across Arrow batches of a Python worker."""

from __future__ import annotations

from collections.abc import Callable


class ChunkMemo(dict):
    """Maps a chunk of text to its encoded bytes; misses of a whole batch are encoded together.

    Two generations bound the memory: when the young one is full it becomes the old one, from which chunks in
    use come back. What is forgotten is encoded again, so the bound never changes a result.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = 300_000, longest: int = 200):
        self.encode, self.limit, self.longest, self.old, self.long = encode, limit, longest, {}, []

    def fill(self, chunks: set[str]) -> ChunkMemo:
        """Hold the encoded bytes of ``chunks``; those over ``longest`` characters only until the next call."""
        for chunk in self.long:
            self.pop(chunk, None)
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
        missing = list(chunks.difference(self))
        if missing and self.old:
            kept = self.old
            self.update((c, kept[c]) for c in missing if c in kept)
            missing = [c for c in missing if c not in kept]
        if missing:
            self.update(zip(missing, self.encode(missing)))
        self.long = [c for c in missing if len(c) > self.longest]
        return self

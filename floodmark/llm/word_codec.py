"""Token ids of a word-level BPE vocabulary of the tokenizers library, with a memo of chunks.

The vocabulary drops white space, and its pattern parts letters from digits and other characters, so a text may be cut
wherever no pattern match, no composition of characters and no added token can lie across the cut. Cuts are made at ASCII white
space, around ASCII digits, and between letters and ASCII punctuation; what is between them is encoded alone by the
library. Apostrophes (contractions) and ``<``, ``|`` and ``>`` (added tokens, which keep their own ids as the
library does by default) never get a cut. Chunks of Latin-1 characters without these three are lower-cased first, as the
vocabulary would; others may compose or be added tokens.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from floodmark.llm.textscan import byte_class, utf8

_SPACE = byte_class(" \t\n\x0b\x0c\r")
_DIGIT = byte_class("0123456789")
_LETTER = byte_class("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_MARK = byte_class('!"#$%&()*+,-./:;=?@[\\]^_`{}~')
_ASCII = np.arange(256) < 128
#: Bytes of a chunk that must keep its case.
_CASED = byte_class("<|") | (np.arange(256) >= 0xC4)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: Chunks that one generation of the memo holds, and the longest ones it keeps.
MEMO_CHUNKS, MEMO_LENGTH = 300_000, 200
#: How the vocabulary marks the last token of a word.
WORD_END = "</w>"


class WordTokenizer:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        resize = getattr(self.library.model, "_resize_cache", None)
        if resize is not None:
            resize(0)  # the memo holds what comes back
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        self.last = np.zeros(self.vocabulary, bool)
        self.last[[i for t, i in self.library.get_vocab(with_added_tokens=False).items() if t.endswith(WORD_END)]] = True
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def known(self, chunks: list[str]) -> list[bytes]:
        """Encoded chunks. Two generations bound the memo; what was forgotten is encoded again."""
        if len(self.memo) > MEMO_CHUNKS:
            self.memo, self.older = {}, self.memo
        out = list(map(self.memo.get, chunks))
        new, older = [], self.older.get
        for k in [k for k, x in enumerate(out) if x is None]:
            found = out[k] = older(chunks[k])
            if found is None:
                new.append(k)
            else:
                self.memo[chunks[k]] = found
        for k, x in zip(new, self._encode([chunks[k] for k in new])):
            out[k] = x
            if len(chunks[k]) <= MEMO_LENGTH:
                self.memo[chunks[k]] = x
        return out

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """Single words are joined for the library, whose ids are cut behind every word's last one; others go alone."""
        out: list[bytes] = [b""] * len(chunks)
        words = [k for k, c in enumerate(chunks) if c.isalpha() and max(c) < "\u0100"]
        rest = set(range(len(chunks))).difference(words)
        for at in range(0, len(words), 4096):
            group = words[at : at + 4096]
            ids = self._ids([" ".join([chunks[k] for k in group])])[0]
            stops = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            if len(stops) != len(group):  # not one word each, for some vocabulary: all alone
                rest.update(group)
                continue
            joined = ids.tobytes()
            for k, a, b in zip(group, [0, *stops], stops):
                out[k] = joined[a:b]
        alone = sorted(rest)
        for k, ids in zip(alone, self._ids([chunks[k] for k in alone])):
            out[k] = ids.tobytes()
        return out

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, and the n + 1 offsets of the texts into them."""
        data, offsets = utf8(column)
        starts, ends = chunk_bounds(data, offsets)
        text = lowered(data, starts, ends)[_inside(starts, ends, len(data))]
        bounds = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
        chunks = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(text)])
        distinct = chunks.dictionary_encode()
        found = distinct.dictionary.to_pylist()
        parts = self.known(found)
        sizes = np.array([len(p) for p in parts], np.int64) // 4
        flat, first = np.frombuffer(b"".join(parts), "<u4"), np.cumsum(sizes) - sizes
        index = distinct.indices.to_numpy()
        counts = sizes[index]
        stops = np.cumsum(counts)
        ids = flat[np.repeat(first[index] - (stops - counts), counts) + np.arange(stops[-1] if len(stops) else 0)]
        return ids, np.append(0, stops)[np.searchsorted(starts, offsets)]


def chunk_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of all texts; white space lies between them."""
    n = len(data)
    space = _SPACE[data]
    digit, letter, mark, ascii_ = _DIGIT[data], _LETTER[data], _MARK[data], _ASCII[data]
    left, right = slice(0, max(n - 1, 0)), slice(1, n)
    ends_letter = letter.copy()  # also the last bytes of Latin-1 letters
    ends_letter[1:] |= (data[left] == 0xC3) & (data[right] != 0x97) & (data[right] != 0xB7)
    cut = np.zeros(n + 1, bool)
    cut[1:n] = (digit[left] & ascii_[right]) | (digit[right] & (ascii_[left] | ends_letter[left]))
    cut[1:n] |= (ends_letter[left] & mark[right]) | (mark[left] & letter[right]) | space[left]
    cut[offsets] = True
    begin = cut[:n] & ~space
    ends = np.zeros(n + 1, bool)  # position behind the last byte of a chunk
    ends[1 : n + 1] = ~space
    ends[1:n] &= cut[1:n] | space[right]
    return np.flatnonzero(begin), np.flatnonzero(ends)


def lowered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes with A to Z in lower case, but for the chunks that must keep their case."""
    out = _LOWER[data]
    for k in np.unique(np.searchsorted(starts, np.flatnonzero(_CASED[data]), "right") - 1).tolist():
        out[starts[k] : ends[k]] = data[starts[k] : ends[k]]
    return out


def _inside(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    edges = np.zeros(n + 1, np.int8)
    edges[starts] += 1
    edges[ends] -= 1
    return np.cumsum(edges[:n], dtype=np.int8).astype(bool)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)

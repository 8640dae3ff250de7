"""Encoding and decoding with a merge-type SentencePiece vocabulary.

A text is normalised (identity, spaces escaped, one dummy prefix), split before every run of escaped spaces and each
chunk is encoded by an agenda of adjacent symbol pairs: the pair whose merged piece has the best score is merged
first, the leftmost of equal ones, until no pair forms a piece. No piece of the vocabulary holds an escaped space
behind another character, so no merge crosses a chunk border and chunks are independent; vocabularies for which
that does not hold are encoded as one chunk per text. All chunks unseen by the worker run their agendas side by side
in numpy, one merge per chunk and round. Symbols without a piece fall back to their UTF-8 bytes.

Every Arrow batch is checked against the sentencepiece library; a difference raises an error. ``verify="chunks"`` compares
ids and decoded text of every chunk that the worker has not met before, which covers all texts since chunks are
independent; ``verify="texts"`` encodes and decodes every whole text a second time.

Null and empty texts have only the begin and end ids. The map is row by row, without a shuffle; a text of any length
is one row. Repeated rows give repeated results. Columns other than the id and text are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm.memo import ChunkMemo
from floodmark.llm.textscan import blocks

NAME = "op1_sentencepiece"
SQL = None
SPACE = "▁"
NONE = -1
MODEL = "piece_bpe_32k.model"


class PieceModel:
    """Vocabulary tables of a merge-type model, read through the library's own accessors."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.vocab_size()
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        pieces, self.bytes_of, surfaces = {}, np.zeros(256, np.int64), []
        for i in range(size):
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(text[1:-1], 16)
                self.bytes_of[value] = i
                surfaces.append(bytes([value]))
            elif sp.is_control(i):
                surfaces.append(b"")
            else:
                surfaces.append((" ⁇ " if sp.is_unknown(i) else text.replace(SPACE, " ")).encode())
                if not sp.is_unknown(i):
                    pieces[text] = i
        self.surfaces = surfaces
        self.raw = frozenset(int(i) for i in self.bytes_of)
        self.single = {p: i for p, i in pieces.items() if len(p) == 1}
        self.by_point = np.full(0x110000, NONE, np.int32)
        self.by_point[[ord(p) for p in self.single]] = list(self.single.values())
        self.splits = all(SPACE not in p.lstrip(SPACE) for p in pieces)
        # the agenda's table: pair of symbols -> merged piece and its rank (best score first)
        pairs = [(pieces[p[:k]] * size + pieces[p[k:]], i) for p, i in pieces.items() for k in range(1, len(p)) if p[:k] in pieces and p[k:] in pieces]
        pairs.sort()
        self.size = size
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ids = np.array([i for _, i in pairs], np.int64)
        scores = np.array([sp.get_score(i) for i in range(size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.memo = ChunkMemo(self.checked_chunks)

    def checked_chunks(self, chunks: list[str], together: int = 512) -> list[bytes]:
        """Encoded chunks, compared with the library: chunks in a row make a text whose ids and decoded text are known."""
        encoded = self.encode_chunks(chunks)
        spaces = [k for k, c in enumerate(chunks) if not c.strip(SPACE)]  # these end a text and stand alone
        alone, others = set(spaces), range(len(chunks))
        others = [k for k in others if k not in alone] if alone else others
        groups = [[k] for k in spaces] + [others[at : at + together] for at in range(0, len(others), together)]
        for group in groups if self.splits else ():
            text = "".join(chunks[k] for k in group)[1:].replace(SPACE, " ")  # the library adds the first one by itself
            ids = b"".join(encoded[k] for k in group)
            if text:
                _compare(self, [text], [ids], [self.decode(np.frombuffer(ids, "<u4"))], marks=False)
        return encoded

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece of every adjacent pair, NONE where they form none."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ids[at], NONE)

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each chunk; long chunks get agendas of their own."""
        out: list[bytes] = [b""] * len(chunks)
        group, held = [], 0
        for k in sorted(range(len(chunks)), key=lambda k: len(chunks[k])):
            if group and (held > 1 << 19 or len(chunks[k]) > 2 * len(chunks[group[0]]) + 8):
                self._agenda(chunks, group, out)
                group, held = [], 0
            if len(chunks[k]) > 2000:
                out[k] = self._heap(chunks[k])
            else:
                group.append(k)
                held += len(chunks[k])
        if group:
            self._agenda(chunks, group, out)
        return out

    def _agenda(self, chunks: list[str], group: list[int], out: list[bytes]) -> None:
        """Side by side: in every round each chunk takes the best pair from its agenda.

        ``after`` links live symbols; ``agenda`` holds rank * span + position of the pair that starts at a symbol.
        """
        texts = [chunks[k] for k in group]
        lengths = np.array([len(t) for t in texts])
        width = int(lengths.max()) + 1
        alive = np.arange(width)[None, :] < lengths[:, None]
        symbols = np.full((len(texts), width), NONE, np.int64)
        symbols[alive] = self.by_point[np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)]
        span, idle = width, np.iinfo(np.int32).max
        after = np.tile(np.arange(1, width + 1), (len(texts), 1))
        before = np.tile(np.arange(-1, width - 1), (len(texts), 1))
        made = np.full((len(texts), width), NONE, np.int64)
        made[:, :-1] = self.merged(symbols[:, :-1], symbols[:, 1:])
        agenda = np.where(made >= 0, self.rank[made] * span + np.arange(width), idle).astype(np.int32)
        rows = np.arange(len(texts))
        while len(rows):
            at = agenda[rows].argmin(1)
            rows, at = (x[agenda[rows, at] != idle] for x in (rows, at))
            if not len(rows):
                break
            gone = after[rows, at]
            symbols[rows, at] = made[rows, at]
            alive[rows, gone] = False
            agenda[rows, gone] = idle
            following = after[rows, gone]
            after[rows, at] = following
            before[rows, np.minimum(following, width - 1)] = at
            for left_at, right_at in ((at, following), (before[rows, at], at)):
                ok = (left_at >= 0) & (right_at < width)
                l, r = np.where(ok, left_at, 0), np.where(ok, right_at, 0)
                piece = np.where(ok & alive[rows, r], self.merged(symbols[rows, l], symbols[rows, r]), NONE)
                value = np.where(piece >= 0, self.rank[piece] * span + l, idle)
                made[rows[ok], l[ok]], agenda[rows[ok], l[ok]] = piece[ok], value[ok]
        joined, cuts = symbols[alive].astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(4 * alive.sum(1))]).tolist()
        for row, k in enumerate(group):
            out[k] = joined[cuts[row] : cuts[row + 1]]
        for row in np.flatnonzero((alive & (symbols < 0)).any(1)).tolist():
            out[group[row]] = self._with_bytes(symbols[row][alive[row]], np.flatnonzero(alive[row]), texts[row])

    def _heap(self, text: str) -> bytes:
        """One long chunk: the same agenda in a heap, n log n in the length."""
        import heapq

        single, n = self.single, len(text)
        symbols = [single.get(c, NONE) for c in text]
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        table = dict(zip(self.pair_keys.tolist(), self.pair_ids.tolist())) if not hasattr(self, "_table") else self._table
        self._table, size, rank, agenda = table, self.size, self.rank, []

        def push(left: int, right: int) -> None:
            if left >= 0 and right < n and symbols[left] >= 0 and symbols[right] >= 0:
                piece = table.get(symbols[left] * size + symbols[right])
                if piece is not None:
                    heapq.heappush(agenda, (int(rank[piece]), left, right, symbols[left], symbols[right], piece))

        for i in range(n - 1):
            push(i, i + 1)
        while agenda:
            _, left, right, a, b, piece = heapq.heappop(agenda)
            if not (alive[left] and alive[right] and after[left] == right and symbols[left] == a and symbols[right] == b):
                continue
            symbols[left], alive[right], after[left] = piece, False, after[right]
            if after[left] < n:
                before[after[left]] = left
            push(left, after[left])
            push(before[left], left)
        where = np.flatnonzero(alive)
        ids = np.array([symbols[i] for i in where], np.int64)
        return self._with_bytes(ids, where, text)

    def _with_bytes(self, ids: np.ndarray, where: np.ndarray, text: str) -> bytes:
        """Byte pieces for the symbols that have no piece."""
        out: list[int] = []
        for i, at in zip(ids.tolist(), where.tolist()):
            out.extend([i] if i >= 0 else self.bytes_of[list(text[at].encode())].tolist())
        return np.array(out, "<u4").tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids with begin and end of each text."""
        split = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        rows = []
        for text in texts:
            text = SPACE + text.replace(" ", SPACE) if text else ""
            rows.append(split(text) if self.splits else [text] if text else [])
        known = self.memo.fill(set().union(*rows)).__getitem__
        return [begin + b"".join(map(known, row)) + end for row in rows]

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids: surfaces joined, byte pieces read as UTF-8, the dummy prefix taken off."""
        joined = b"".join(map(self.surfaces.__getitem__, ids.tolist()))
        try:
            text = joined.decode()
        except UnicodeDecodeError:
            text = self._decode_bytewise(ids)
        first = next((i for i in ids[:8].tolist() if self.surfaces[i]), NONE)  # behind begin marks
        return text[1:] if text.startswith(" ") and first not in self.raw else text

    def _decode_bytewise(self, ids: np.ndarray) -> str:
        """Invalid byte sequences give one replacement character per byte; runs of byte pieces stand alone."""
        out, run = [], bytearray()

        def flush() -> None:
            rest = bytes(run)
            while rest:
                try:
                    out.append(rest.decode())
                    rest = b""
                except UnicodeDecodeError as bad:
                    out.append(rest[: bad.start].decode() + "�")
                    rest = rest[bad.start + 1 :]
            run.clear()

        for i in ids.tolist():
            if i in self.raw:
                run += self.surfaces[i]
            else:
                flush()
                out.append(self.surfaces[i].decode())
        flush()
        return "".join(out)


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def encode(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", verify: str = "chunks", block: int = 4 << 20
) -> DataFrame:
    """``_id``, ``ids`` (little-endian unsigned 32-bit, begin and end included) and ``decoded`` of every row.

    About ``block`` bytes of text (one row at least) are held as ids at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for part in blocks(batches, 1, block):
            texts = [t or "" for t in part.column(1).to_pylist()]
            encoded = pieces.encode_batch(texts)
            decoded = [pieces.decode(np.frombuffer(e, "<u4")) for e in encoded]
            if verify == "texts" or not pieces.splits:
                _compare(pieces, texts, encoded, decoded)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(encoded, pa.binary()), pa.array(decoded, pa.string())], ["_id", "ids", "decoded"]
            )

    narrow = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"_id {kind}, ids binary, decoded string")


def _compare(pieces: PieceModel, texts: list[str], encoded: list[bytes], decoded: list[str], marks: bool = True) -> None:
    """The library's ids (with begin and end, if ``marks``) and its text of them must be ours."""
    theirs = pieces.library.encode(texts, add_bos=marks, add_eos=marks, num_threads=1)
    for text, ours, ids in zip(texts, encoded, theirs):
        if array("I", ids).tobytes() != ours:  # four bytes, little-endian on the platforms the library runs on
            raise ValueError(f"ids differ from the library's for {text[:80]!r}")
    for ours, other in zip(decoded, pieces.library.decode(theirs, num_threads=1)):
        if ours != other:
            raise ValueError(f"decoded text differs from the library's: {ours[:80]!r}")


def digest(encoded: DataFrame) -> DataFrame:
    """Counts and digests of encoded rows (JVM expressions over the operator's output)."""
    return encoded.select(
        F.col("_id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(MODEL)))

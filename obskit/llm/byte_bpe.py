"""Byte-level BPE by monoid tree reduction.

A text is cut by a pattern into pieces that merge apart. A piece is encoded as a tree: both halves of its bytes are
encoded, then joined. ``join`` re-encodes a window of tokens around the boundary and doubles it until the first and the
last token of the window come out as they went in, on each side that has tokens outside the window.

Then the tokens outside stand. Merging takes the pair of lowest rank, leftmost first, and where no merge crosses a
boundary the two sides merge as if apart. Let t be the window's first token, p the boundary before it and q the one
after it. The left half merged without crossing p, the window without crossing q. Up to the first merge of the whole
that crosses p or q, its merges left of q are those of the left half, which never crosses p, and its merges right of p
are those of the window, which never crosses q; so there is no first one. The right end is alike. Nothing about the
vocabulary is used, so this holds for any ranks. A whole piece that is a token is that token, whatever merges would give.

Decoding is the same reduction with concatenation as its operation.

Defined cases: a null text counts as empty; an empty text has no tokens; repeated rows get the same tokens; texts
of any length are encoded whole, piece by piece; an unknown id makes decoding fail; an empty table gives no rows; other
columns pass through, but one named like the new column is replaced.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pieces import _with_row, chunks

#: Bytes that a leaf of the tree merges at once, and tokens that a leaf of decoding concatenates.
LEAF, RUN = 32, 1024
#: Stands for "no such token"; larger than any rank.
NONE = 1 << 62


class ByteBpe:
    """A vocabulary {bytes: rank}; ids are ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.spelled = {i: b for b, i in ranks.items()}
        self.single = [ranks.get(bytes([c])) for c in range(256)]
        #: Which token two neighbours make, by both ids in one number.
        self.pairs = {(ranks[t[:i]] << 32) | ranks[t[i:]]: rank for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.known = _Known(self)

    @classmethod
    def parse(cls, lines: bytes, pattern: str) -> ByteBpe:
        pairs = (line.split() for line in lines.splitlines() if line)
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def merged(self, data: bytes) -> list[int]:
        """Tokens of ``data`` by merging from single bytes: always the pair of lowest rank, the leftmost of equal ones."""
        return self._scanned(data) if len(data) <= 2 * LEAF else self._queued(data)

    def _scanned(self, data: bytes) -> list[int]:
        rank = self.pairs.get
        ids = [self.single[c] for c in data]
        made = [rank(a << 32 | b, NONE) for a, b in zip(ids, ids[1:])]
        while made and (least := min(made)) < NONE:
            i = made.index(least)
            ids[i] = least
            del ids[i + 1], made[i]
            if i:
                made[i - 1] = rank(ids[i - 1] << 32 | least, NONE)
            if i < len(made):
                made[i] = rank(least << 32 | ids[i + 1], NONE)
        return ids

    def _queued(self, data: bytes) -> list[int]:
        """The same with a heap, for long windows: tokens stand at their first byte."""
        n, rank = len(data), self.pairs.get
        ids = [self.single[c] for c in data]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            made, at, a, b = heapq.heappop(heap)
            other = after[at]
            if other >= n or ids[at] != a or ids[other] != b:
                continue  # one of the two has been merged since
            ids[at], ids[other], after[at] = made, None, after[other]
            if (right := after[at]) < n:
                before[right] = at
                if (r := rank(made << 32 | ids[right])) is not None:
                    heapq.heappush(heap, (r, at, made, ids[right]))
            if (left := before[at]) >= 0 and (r := rank(ids[left] << 32 | made)) is not None:
                heapq.heappush(heap, (r, left, ids[left], made))
        return [i for i in ids if i is not None]

    def join(self, left: list[int], right: list[int], window: int = 2) -> list[int]:
        """The tokens of two neighbouring byte strings together, from the tokens of each."""
        while True:
            a, b = left[-window:], right[:window]
            again = self.merged(b"".join(map(self.spelled.__getitem__, a + b)))
            outside, beyond = len(left) - len(a), len(right) - len(b)
            if (not outside or again[0] == a[0]) and (not beyond or again[-1] == b[-1]):
                return left[:outside] + again + right[len(b) :]
            window *= 2

    def tokens(self, data: bytes) -> list[int]:
        """Both halves encoded, then joined. The left half is the largest power of two of leaves."""
        if len(data) <= LEAF:
            return self.merged(data)
        half = LEAF << (((len(data) - 1) // LEAF).bit_length() - 1)
        return self.join(self.tokens(data[:half]), self.tokens(data[half:]))

    def piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.tokens(data)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.pattern.findall(text))), dtype=np.int32)

    def decode(self, ids: list[int]) -> bytes:
        spelled = list(map(self.spelled.__getitem__, ids))
        parts = [b"".join(spelled[i : i + RUN]) for i in range(0, len(spelled), RUN)]
        while len(parts) > 1:
            parts = [b"".join(parts[i : i + 2]) for i in range(0, len(parts), 2)]
        return parts[0] if parts else b""


class _Known(dict):
    """Ids of pieces seen before, as bytes of int32; forgets all when it holds too many, and never holds a long one."""

    def __init__(self, bpe: ByteBpe, most: int = 500_000, longest: int = 64):
        self.bpe, self.most, self.longest = bpe, most, longest

    def __missing__(self, piece: str) -> bytes:
        ids = array("i", self.bpe.piece(piece.encode())).tobytes()
        if len(piece) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[piece] = ids
        return ids


#: The vocabulary a worker process has parsed last, by the broadcast it came from.
_last: dict[int, ByteBpe] = {}


def _vocabulary(shared: Broadcast) -> ByteBpe:
    lines, pattern, token = shared.value
    if token not in _last:
        _last.clear()
        _last[token] = ByteBpe.parse(lines, pattern)
    return _last[token]


def _shared(df: DataFrame, path: str | None, pattern: str) -> Broadcast:
    """The rank file, one line a token, goes to every executor once."""
    with open(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        lines = f.read()
    return df.sparkSession.sparkContext.broadcast((lines, pattern, hash((lines, pattern))))


def encode(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN, into: str = "token_ids") -> DataFrame:
    """Add ``into`` array<int>: the tokens of ``text`` by the ranks of the file ``path``, without special tokens."""
    shared = _shared(docs, path, pattern)
    rows, unpack = _with_row(docs, into, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _vocabulary(shared)
        for b in batches:
            for lo, hi in chunks(pc.binary_length(b.column("text")).to_pylist()):
                part = b.slice(lo, hi - lo)
                found = [bpe.encode(t) for t in part.column("text").to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(ids) for ids in found])])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found), pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("row"), ids], names=["row", "new"])

    return unpack(rows.mapInArrow(each, T.StructType([rows.schema["row"], T.StructField("new", T.ArrayType(T.IntegerType()))])))


def decode(tokens: DataFrame, ids: str = "token_ids", path: str | None = None, into: str = "decoded") -> DataFrame:
    """Add ``into`` binary: the bytes that ``ids`` stand for (null: none)."""
    shared = _shared(tokens, path, "")
    rows, unpack = _with_row(tokens, into, F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>")).alias("ids"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _vocabulary(shared)
        for b in batches:
            for lo, hi in chunks([4 * n for n in pc.list_value_length(b.column("ids")).to_pylist()]):
                part = b.slice(lo, hi - lo)
                column = part.column("ids")
                offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
                said = [bpe.decode(flat[i:j].tolist()) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(said, pa.binary())], names=["row", "new"])

    return unpack(rows.mapInArrow(each, T.StructType([rows.schema["row"], T.StructField("new", T.BinaryType())])))

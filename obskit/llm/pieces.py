"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

The vocabulary comes from a model file and is never trained. Encoding works as the model's own: a text gets a
leading space, characters become symbols (bytes where the vocabulary has no character), and an agenda merges the
adjacent pair whose union ranks best, leftmost first, until none is left. With dropout, a candidate merge is
skipped for good when its keyed hash (seed, document key, place of the unit in the text, span) falls below the rate:
every occurrence of a word is cut on its own, and every run repeats itself.

No piece spans a space that follows something else, so texts are cut into units (spaces and the word after them).
Each distinct unit of a batch is merged once without dropout, which also tells the candidates its agenda looks at; an
occurrence that skips none of these has that result, and any other goes through its own agenda. Short units run
together in numpy, one agenda pop per unit and round; long ones each use a heap. Both pop in the same order.

Defined cases: a null text encodes as an empty one, without tokens; a literal U+2581 goes by its bytes, so that
decoding can tell it from a space; rows of equal key and text encode alike; other columns pass through, but one
named as the new column is replaced.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNIT = re.compile(r" *[^ \n]+| +|\n")
NEVER = np.int32(1 << 30)
LONG = 64


class Vocabulary:
    """Tables over a model: characters to ids, pairs of ids to the id of their union, ids to bytes."""

    _cache: dict[int, Vocabulary] = {}

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = {p: i for i, p in enumerate(pieces) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        self.bytes_at = next(i for i in range(n) if sp.is_byte(i))
        self.piece_bytes = [p.replace("▁", " ").encode() for p in pieces]
        for i in range(n):
            if sp.is_byte(i):
                self.piece_bytes[i] = bytes([i - self.bytes_at])
        self.chars = np.full(0x110000, -1, dtype=np.int32)
        for p, i in plain.items():
            if len(p) == 1:
                self.chars[ord(p)] = i
        self.chars[ord(" ")], self.chars[0x2581] = self.chars[0x2581], -1
        rank = {i: r for r, i in enumerate(sorted(plain.values(), key=lambda i: -sp.get_score(i)))}
        pairs = {(plain[p[:k]] << 16) | plain[p[k:]]: i for p, i in plain.items() for k in range(1, len(p)) if p[:k] in plain and p[k:] in plain}
        self.id_of_rank = np.array(sorted(rank, key=rank.get), dtype=np.int32)
        self._fill(np.array(list(pairs), dtype=np.uint64), np.array([rank[i] for i in pairs.values()], dtype=np.int32))

    @classmethod
    def of(cls, model: bytes) -> Vocabulary:
        key = hash(model)
        if key not in cls._cache:
            cls._cache[key] = cls(model)
        return cls._cache[key]

    def _fill(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """An open-addressed table, as numpy can look many pairs up at once."""
        self.bits = 19
        self.slots, self.values = np.full((1 << self.bits) + 64, np.uint64(1 << 63)), np.full((1 << self.bits) + 64, NEVER)
        self.reach = 0
        for key, at, r in zip(keys, self._home(keys).tolist(), ranks):
            step = 0
            while self.slots[at + step] != np.uint64(1 << 63):
                step += 1
            self.slots[at + step], self.values[at + step] = key, r
            self.reach = max(self.reach, step)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's union, NEVER if there is none."""
        keys = (left.astype(np.uint64) << np.uint64(16)) | right.astype(np.uint64)
        at, out = self._home(keys), np.full(keys.shape, NEVER, dtype=np.int32)
        todo = np.arange(keys.size)
        flat, home, res = keys.ravel(), at.ravel(), out.reshape(-1)
        for step in range(self.reach + 1):
            spot = home[todo] + step
            there = self.slots[spot]
            hit = there == flat[todo]
            res[todo[hit]] = self.values[spot[hit]]
            todo = todo[~hit & (there != np.uint64(1 << 63))]
            if not todo.size:
                break
        return out

    def symbols(self, unit: str) -> list[int]:
        out: list[int] = []
        for c in unit:
            i = int(self.chars[ord(c)])
            out.extend([i] if i >= 0 else [self.bytes_at + b for b in c.encode()])
        return out


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over uint64 (fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _dropped(unit: np.ndarray, start: np.ndarray, end: np.ndarray, limit: np.uint64) -> np.ndarray:
    """Whether a candidate merge of symbols [start, end) of a keyed unit is skipped."""
    span = (start.astype(np.uint64) << np.uint64(32)) | end.astype(np.uint64)
    return _mix(unit ^ _mix(span + np.uint64(0x9E3779B97F4A7C15))) < limit


def merge_one(vocab: Vocabulary, ids: list[int], key: int, limit: int, seen: list[tuple[int, int]] | None = None) -> list[int]:
    """The agenda over one unit, with a heap. ``seen`` gets the spans of its candidates."""
    n = len(ids)
    ids, nxt, prv, end, version = list(ids), list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1)), [0] * n
    heap: list[tuple[int, int, int, int]] = []

    def push(lefts: list[int]) -> None:
        lefts = [i for i in lefts if i >= 0 and nxt[i] < n]
        if not lefts:
            return
        ranks = vocab.rank(np.array([ids[i] for i in lefts]), np.array([ids[nxt[i]] for i in lefts]))
        skip = _dropped(np.full(len(lefts), key, dtype=np.uint64), np.array(lefts), np.array([end[nxt[i]] for i in lefts]), np.uint64(limit)) if limit else np.zeros(len(lefts), bool)
        for i, r, s in zip(lefts, ranks.tolist(), skip.tolist()):
            if r < NEVER and seen is not None:
                seen.append((i, end[nxt[i]]))
            if r < NEVER and not s:
                heapq.heappush(heap, (r, i, version[i], version[nxt[i]]))

    push(list(range(n)))
    dead = [False] * n
    while heap:
        r, i, a, b = heapq.heappop(heap)
        if dead[i] or version[i] != a or nxt[i] >= n or version[nxt[i]] != b:
            continue
        j = nxt[i]
        ids[i], end[i], nxt[i], dead[j] = int(vocab.id_of_rank[r]), end[j], nxt[j], True
        version[i] += 1
        version[j] += 1
        if nxt[i] < n:
            prv[nxt[i]] = i
        push([prv[i], i])
    return [x for x, d in zip(ids, dead) if not d]


def merge_many(vocab: Vocabulary, ids: np.ndarray, keys: np.ndarray, limit: int, seen: list[tuple[np.ndarray, ...]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The agenda over many units, rows of ``ids`` padded with -1: each round pops every unit's best candidate.

    Returns the tokens row by row, and how many each row has. ``seen`` gets the rows and spans of the candidates.
    """
    n, width = ids.shape
    ids = ids.copy()
    alive = ids >= 0
    if width > 1:
        col = np.arange(width, dtype=np.int32)
        nxt, prv, end = np.tile(col + 1, (n, 1)), np.tile(col - 1, (n, 1)), np.tile(col + 1, (n, 1))
        stop = alive.sum(axis=1).astype(np.int32)
        ranks = np.full((n, width), NEVER, dtype=np.int32)
        r, c = np.nonzero(alive[:, 1:])
        ranks[r, c] = vocab.rank(ids[r, c], ids[r, c + 1])
        if limit or seen is not None:
            r, c = np.nonzero(ranks < NEVER)
            if seen is not None:
                seen.append((r, c, c + 2))
        if limit:
            skip = _dropped(keys[r], c, c + 2, np.uint64(limit))
            ranks[r[skip], c[skip]] = NEVER
        rows = np.arange(n)
        while rows.size:
            here = ranks if rows.size == n else ranks[rows]
            at = here.argmin(axis=1)
            best = here[np.arange(rows.size), at]
            going = best < NEVER
            rows, at, best = rows[going], at[going], best[going]
            if not rows.size:
                break
            gone = nxt[rows, at]
            ids[rows, at] = vocab.id_of_rank[best]
            alive[rows, gone], ranks[rows, gone] = False, NEVER
            end[rows, at], after = end[rows, gone], nxt[rows, gone]
            nxt[rows, at] = after
            inside = after < stop[rows]
            prv[rows[inside], after[inside]] = at[inside]
            ranks[rows, at] = NEVER
            for r, left in ((rows[inside], at[inside]), (rows, prv[rows, at])):
                ok = left >= 0
                r, left = r[ok], left[ok]
                right = nxt[r, left]
                new = vocab.rank(ids[r, left], ids[r, right])
                if seen is not None:
                    real = new < NEVER
                    seen.append((r[real], left[real], end[r[real], right[real]]))
                if limit:
                    new[_dropped(keys[r], left, end[r, right], np.uint64(limit))] = NEVER
                ranks[r, left] = new
    return ids[alive], alive.sum(axis=1)


class _Units:
    """The distinct units of a batch, and the agenda over any selection of them."""

    WIDTHS = (1, 2, 4, 6, 8, 10, 12, 16, 24, 32, LONG)

    def __init__(self, vocab: Vocabulary, units: list[str]) -> None:
        self.vocab, self.units = vocab, units
        self.codes = vocab.chars[np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32)]
        self.lengths = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.easy = self.lengths <= LONG
        self.easy[np.searchsorted(self.begins, np.flatnonzero(self.codes < 0), side="right") - 1] = False

    def merge(self, which: np.ndarray, keys: np.ndarray, limit: int, seen: list[tuple[np.ndarray, ...]] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of the units ``which`` under ``keys``: a pool, and where each one's begin and how many they are.

        ``seen`` gets (positions in ``which``, span starts, span ends) of the candidates.
        """
        starts, sizes = np.zeros(len(which), dtype=np.int64), np.zeros(len(which), dtype=np.int64)
        pool, held, low = [], 0, 0

        def put(at: np.ndarray, tokens: np.ndarray, size: np.ndarray) -> None:
            nonlocal held
            sizes[at], starts[at] = size, held + np.cumsum(size) - size
            pool.append(tokens)
            held += len(tokens)

        easy, lengths = self.easy[which], self.lengths[which]
        for width in self.WIDTHS:
            pick = np.flatnonzero(easy & (lengths > low) & (lengths <= width))
            low = width
            for at in range(0, len(pick), 65536):
                part = pick[at : at + 65536]
                own = which[part]
                grid = self.begins[own, None] + np.arange(width)
                inside = np.arange(width) < self.lengths[own, None]
                ids = np.where(inside, self.codes[np.minimum(grid, len(self.codes) - 1)], -1)
                found: list[tuple[np.ndarray, ...]] | None = None if seen is None else []
                put(part, *merge_many(self.vocab, ids, keys[part], limit, found))
                if seen is not None:
                    seen += [(part[r], a, b) for r, a, b in found]
        for i in np.flatnonzero(~easy).tolist():
            spans: list[tuple[int, int]] | None = None if seen is None else []
            tokens = merge_one(self.vocab, self.vocab.symbols(self.units[which[i]]), int(keys[i]), limit, spans)
            put(np.array([i]), np.array(tokens, dtype=np.int32), np.array([len(tokens)]))
            if spans:
                seen.append((np.full(len(spans), i), *np.array(spans).T))
        return np.concatenate(pool) if pool else np.zeros(0, dtype=np.int32), starts, sizes


def encode_texts(vocab: Vocabulary, texts: list[str], keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts in a row, and the number of tokens of each text. ``keys`` (uint64): one for each text."""
    limit = min(int(dropout * 2.0**64), 2**64 - 1)
    known: dict[str, int] = {}
    used: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for n, text in enumerate(texts):
        if text:
            found = UNIT.findall(" " + text)
            used += [known.setdefault(u, len(known)) for u in found]
            counts[n] = len(found)
    use = np.array(used, dtype=np.int64)
    units = _Units(vocab, list(known))
    seen: list[tuple[np.ndarray, ...]] | None = [] if limit else None
    every = np.arange(len(known))
    pool, starts, sizes = units.merge(every, np.zeros(len(known), dtype=np.uint64), 0, seen)
    starts, sizes = starts[use], sizes[use]
    if limit and seen:
        place = np.arange(len(use)) - np.repeat(np.cumsum(counts) - counts, counts)
        own = _mix(np.repeat(keys, counts) + (place + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        unit, first, last = (np.concatenate(c) for c in zip(*seen))
        order = np.argsort(unit, kind="stable")
        first, last = first[order], last[order]
        per = np.bincount(unit, minlength=len(known))
        begin = np.cumsum(per) - per
        again = np.zeros(len(use), dtype=bool)
        for at in range(0, len(use), 65536):
            u = use[at : at + 65536]
            spans, row = _ragged(begin[u], per[u]), np.repeat(np.arange(len(u)), per[u])
            again[at + row[_dropped(own[at + row], first[spans], last[spans], np.uint64(limit))]] = True
        redo = np.flatnonzero(again)
        more, starts[redo], sizes[redo] = units.merge(use[redo], own[redo], limit)
        starts[redo] += len(pool)
        pool = np.concatenate([pool, more])
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
    return pool[_ragged(starts, sizes)], np.diff(ends)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each run."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(total)


def chunks(sizes: list[int], most: int = 1_000_000, rows: int = 2048) -> Iterator[tuple[int, int]]:
    """[from, to) runs of rows with about ``most`` bytes at most, which bounds what a task holds."""
    at, held = 0, 0
    for i, s in enumerate(sizes):
        if i > at and (held + s > most or i - at >= rows):
            yield at, i
            at, held = i, 0
        held += s
    if at < len(sizes):
        yield at, len(sizes)


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _with_row(df: DataFrame, into: str, *more: Column) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with its columns in a struct ``row`` beside ``more``, and what unpacks it next to the column ``into``."""
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *more)
    kept = [c for c in df.columns if c.lower() != into.lower()]
    return packed, lambda out: out.select(*[F.col("row")[c].alias(c) for c in kept], F.col("new").alias(into))


def encode(docs: DataFrame, text: str = "text", key: str | Sequence[str] = "doc_id", dropout: float = 0.1, seed: int = 1, model: bytes | None = None, into: str = "token_ids") -> DataFrame:
    """Add ``into`` array<int>: the tokens of ``text``. ``dropout`` 0 gives the model's own segmentation.

    ``key`` names the columns that tell rows apart: rows that differ in one of them are cut differently.
    """
    model = model or read_model()
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ([key] if isinstance(key, str) else key)]
    rows, unpack = _with_row(docs, into, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.xxhash64(*parts, F.lit(seed)).alias("key"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary.of(model)
        for b in batches:
            for lo, hi in chunks(pa.compute.binary_length(b.column("text")).to_pylist()):
                part = b.slice(lo, hi - lo)
                tokens, size = encode_texts(vocab, part.column("text").to_pylist(), part.column("key").to_numpy().view(np.uint64), dropout)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(tokens, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("row"), ids], names=["row", "new"])

    return unpack(rows.mapInArrow(each, T.StructType([rows.schema["row"], T.StructField("new", T.ArrayType(T.IntegerType()))])))


def decode(tokens: DataFrame, ids: str = "token_ids", model: bytes | None = None, into: str = "decoded") -> DataFrame:
    """Add ``into`` string: the text that ``ids`` stand for (null: an empty one). Works for any segmentation of a text."""
    model = model or read_model()
    rows, unpack = _with_row(tokens, into, F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>")).alias("ids"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = Vocabulary.of(model).piece_bytes.__getitem__
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                col = part.column("ids")
                offsets, flat = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)
                texts = [b"".join(map(piece, flat[i:j].tolist()))[1:].decode() for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string())], names=["row", "new"])

    return unpack(rows.mapInArrow(each, T.StructType([rows.schema["row"], T.StructField("new", T.StringType())])))

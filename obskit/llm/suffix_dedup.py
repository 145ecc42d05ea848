"""Removal of repeated passages with suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier (a smaller document id, or the same
document and an earlier start) goes. Sorting all suffixes of a corpus together would not scale, so:

1. Prefilter: each document is winnowed. Every window of LENGTH bytes picks the least hash among its GRAM-byte
   strings, its anchor. Equal windows pick equal anchors, so windows whose anchor hash is unique in the corpus repeat
   nowhere and need no sorting. The windows that picked one anchor are a stretch.
2. Each block of documents is a shard: what is left of its texts gets a suffix array (Larsson-Sadakane refinement in
   numpy) and common prefixes (Kasai, in lanes). Windows in a run of prefixes of LENGTH or more are equal; all but the
   first repeat. Stretches that repeat as a whole within their shard go no further.
3. The other stretches meet those of other shards by anchor hash. Shards are merged in sorted runs, pair by pair, by
   binary search of one run in the other: of equal stretches, all but the first repeat as a whole.
4. Anchors left with several different stretches fill shards of their own, with arrays and prefixes as in 2, for
   stretches that agree in part. An anchor too large for one shard has several, merged by binary search of one's first
   windows in the suffix arrays of the others.
5. Repeated starts return to their documents, where intervals are joined and cut out.

Hashes only choose candidates; every removal follows from arrays or a merge, by equal bytes. Texts travel once, in one exchange that all
steps share.

Defined cases: a null text is empty; a null id sorts before all others; rows of equal id count as different
documents, in the order of the input's rows; texts under LENGTH bytes stay whole; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pieces import _ragged, chunks

LENGTH = 100
GRAM = 20
REACH = LENGTH - GRAM + 1
PIECE = 1 << 20
SHARD_BYTES = 2 << 20
_BYTE = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every GRAM-byte string, by doubling: 2, 4, 8, 16, then 16 + 4 bytes."""
    h = {1: _BYTE[data]}
    for n, c in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (4, 0x165667B19E3779F9), (8, 0x27D4EB2F165667C5)):
        h[2 * n] = h[n][:-n] * np.uint64(c) + h[n][n:]
    size = len(data) - GRAM + 1
    x = h[16][:size] * np.uint64(0x85EBCA77C2B2AE63) + h[4][16 : 16 + size]
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of texts joined in ``data`` (at most PIECE + LENGTH bytes), each ending before its ``ends``.

    Returns (hash, anchor, first start, last start): the windows from first to last start picked the anchor.
    """
    starts = len(data) - LENGTH + 1
    if starts <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    h = gram_hashes(data)
    place = np.uint64((1 << 21) - 1)
    v = (h & ~place) | np.arange(len(h), dtype=np.uint64)
    for n in (1, 2, 4, 8, 16, 32):
        v = np.minimum(v[:-n], v[n:])
    v = np.minimum(v[: starts], v[REACH - 64 : REACH - 64 + starts])
    at = (v & place).astype(np.int64)
    text = np.searchsorted(ends, np.arange(starts), side="right")
    whole = np.arange(starts) + LENGTH <= ends[np.minimum(text, len(ends) - 1)]
    start = np.flatnonzero(whole)
    if not len(start):
        return start, start, start, start
    at, text = at[start], text[start]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]]) - 1
    return h[at[first]].view(np.int64), at[first], start[first], start[last]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, hash, spot) rows; ``spot`` packs the first start and the number of starts."""
    for b in batches:
        raw, ids = b.column("text").cast(pa.binary()), b.column("rid").to_numpy()
        sizes = pa.compute.binary_length(raw).to_pylist()
        for lo, hi in chunks(sizes, PIECE // 2, 4096):
            texts = raw.slice(lo, hi - lo).to_pylist()
            whole = b"".join(texts)
            data, ends = np.frombuffer(whole, dtype=np.uint8), np.cumsum(sizes[lo:hi])
            for at in range(0, max(1, len(data)), PIECE):  # a longer text goes piece by piece; windows overlap
                part = data[at : at + PIECE + LENGTH - 1]
                h, _, first, last = anchors(part, np.minimum(ends - at, len(part))) if at else anchors(part, np.minimum(ends, len(part)))
                if len(h):
                    text = np.searchsorted(ends, first + at, side="right")
                    begin = ends[text] - np.array(sizes[lo:hi])[text]
                    spot = ((first + at - begin) << 7) | (last - first + 1)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi][text]), pa.array(h), pa.array(spot, pa.int64())], names=["rid", "hash", "spot"])


_PLACE = pa.struct([("rid", pa.int64()), ("spot", pa.int64())])
_GROUP_SQL = "hash bigint, rid bigint, spot bigint, others array<struct<rid: bigint, spot: bigint>>"


def _anchor_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of each block, one row for each hash: its first place, and the others (null: none) as a list."""
    for b in _anchor_rows(batches):
        rid, h, spot = (b.column(c).to_numpy() for c in ("rid", "hash", "spot"))
        _, lead, member = np.unique(h, return_index=True, return_inverse=True)
        group = lead[member]  # in the order of first places, so that neighbours stay together and compress
        order = np.argsort(group, kind="stable")
        h, rid, spot, group = h[order], rid[order], spot[order], group[order]
        head = np.concatenate([[True], group[1:] != group[:-1]])
        first = np.flatnonzero(head)
        more = np.diff([*first, len(h)]) - 1
        offsets = pa.array(np.concatenate([[0], more.cumsum()]), pa.int32(), mask=np.concatenate([more == 0, [False]]))
        places = pa.StructArray.from_arrays([pa.array(rid[~head]), pa.array(spot[~head])], fields=list(_PLACE))
        columns = [pa.array(h[first]), pa.array(rid[first]), pa.array(spot[first]), pa.ListArray.from_arrays(offsets, places)]
        yield pa.RecordBatch.from_arrays(columns, names=["hash", "rid", "spot", "others"])


_STRETCH = pa.schema([("hash", pa.int64()), ("shard", pa.int64()), ("doc_id", pa.int64()), ("rid", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("stretch", pa.binary())])
_STRETCH_SQL = "hash bigint, shard bigint, doc_id bigint, rid bigint, start bigint, n bigint, stretch binary"
LEAST_ID = -(1 << 63)
#: How many sorted runs the shards that meet in one task are dealt to.
RUNS = 8


def _gather(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices of ``data`` that start at ``begin``, one after another."""
    return data[_ragged(begin, size)]


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a binary column without nulls."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    return np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8), offsets


@dataclass
class Stretches:
    """Runs of windows of one document each: the first window starts at ``start``, ``n`` windows, n + LENGTH - 1 bytes."""

    hash: np.ndarray
    shard: np.ndarray
    doc: np.ndarray
    rid: np.ndarray
    start: np.ndarray
    n: np.ndarray
    data: np.ndarray

    def __len__(self) -> int:
        return len(self.n)

    @property
    def sizes(self) -> np.ndarray:
        return self.n + LENGTH - 1

    @property
    def begin(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def take(self, at: np.ndarray) -> Stretches:
        cut = (c[at] for c in (self.hash, self.shard, self.doc, self.rid, self.start, self.n))
        return Stretches(*cut, _gather(self.data, self.begin[at], self.sizes[at]))

    @staticmethod
    def concat(parts: list[Stretches]) -> Stretches:
        return Stretches(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("hash", "shard", "doc", "rid", "start", "n", "data")))

    @staticmethod
    def read(batch: pa.RecordBatch) -> Stretches:
        data, offsets = _bytes_of(batch.column("stretch"))
        return Stretches(*(batch.column(c).to_numpy() for c in ("hash", "shard", "doc_id", "rid", "start", "n")), data[offsets[0] : offsets[-1]])

    def batches(self, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
        begin, sizes = self.begin, self.sizes
        for at in range(0, len(self), rows):
            size = sizes[at : at + rows]
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            held = self.data[begin[at] : begin[at] + int(offsets[-1])]
            text = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(held))])
            columns = [pa.array(c[at : at + rows], pa.int64()) for c in (self.hash, self.shard, self.doc, self.rid, self.start, self.n)]
            yield pa.RecordBatch.from_arrays([*columns, text], schema=_STRETCH)


def _marks(rid: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Ranges of repeated starts as rows without text, under their document's number in place of a hash."""
    rid, first, last = _runs(rid, first, last)
    for at in range(0, len(rid), 20_000):
        r = pa.array(rid[at : at + 20_000], pa.int64())
        none = pa.nulls(len(r), pa.int64())
        n = pa.array((last - first + 1)[at : at + 20_000], pa.int64())
        yield pa.RecordBatch.from_arrays([r, none, none, r, pa.array(first[at : at + 20_000], pa.int64()), n, pa.nulls(len(r), pa.binary())], schema=_STRETCH)


def _regions(s: Stretches, data: np.ndarray, origin: np.ndarray) -> Iterator[Stretches]:
    """Neighbouring stretches of a document as one, in lots of about SHARD_BYTES. ``s`` is in order of (rid, start)
    and has no bytes yet; those of a document begin at ``origin`` in ``data``."""
    new = np.concatenate([[True], (s.rid[1:] != s.rid[:-1]) | (s.start[1:] != s.start[:-1] + s.n[:-1])])
    head = np.flatnonzero(new)
    count = np.add.reduceat(s.n, head)
    pieces = -(-count // SHARD_BYTES)  # a longer region goes in pieces
    own = np.repeat(head, pieces)
    skip = _ragged(np.zeros(len(head), dtype=np.int64), pieces) * SHARD_BYTES
    start, n = s.start[own] + skip, np.minimum(np.repeat(count, pieces) - skip, SHARD_BYTES)
    for lo, hi in chunks((n + LENGTH - 1).tolist(), SHARD_BYTES, 1 << 30):
        part = slice(lo, hi)
        body = _gather(data, origin[own[part]] + start[part], n[part] + LENGTH - 1)
        yield Stretches(s.hash[own[part]], s.shard[own[part]], s.doc[own[part]], s.rid[own[part]], start[part], n[part], body)


def _stretch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the suffix arrays of a task's shards settle, and the stretches that other shards must see."""
    task, block = TaskContext.get(), 0
    for b in batches:
        raw = b.column("text").cast(pa.binary())
        for lo, hi in chunks(pa.compute.binary_length(raw).to_pylist(), SHARD_BYTES, 2048):
            part = b.slice(lo, hi - lo)
            block += 1
            data, offsets = _bytes_of(raw.slice(lo, hi - lo))
            per = np.array(pa.compute.list_value_length(part.column("hashes")).to_pylist(), dtype=np.int64)
            spot = part.column("spots").flatten().to_numpy()
            rid = np.repeat(part.column("rid").to_numpy(), per)
            doc = np.repeat(part.column("doc_id").fill_null(LEAST_ID).to_numpy(), per)
            order = np.lexsort((spot >> 7, rid))
            shard = np.full(len(spot), ((task.partitionId() if task else 0) << 24) | block, dtype=np.int64)
            s = Stretches(part.column("hashes").flatten().to_numpy()[order], shard, doc[order], rid[order], spot[order] >> 7, spot[order] & 127, data[:0])
            if not len(s):
                continue
            origin = np.repeat(offsets[:-1], per)[order]
            repeated = np.concatenate([Shard(region).windows_repeated() for region in _regions(s, data, origin)])
            whole = np.logical_and.reduceat(repeated, np.cumsum(s.n) - s.n)
            yield from _marks(s.rid[whole], s.start[whole], s.start[whole] + s.n[whole] - 1)
            left = np.flatnonzero(~whole)
            body = _gather(data, origin[left] + s.start[left], s.n[left] + LENGTH - 1)
            yield from Stretches(*(c[left] for c in (s.hash, s.shard, s.doc, s.rid, s.start, s.n)), body).batches()


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, ranks) by Larsson-Sadakane: sort by 8 bytes, then refine groups of equal rank by the rank 8, 16,
    32, ... bytes on, until every group is one suffix."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(n + 1, dtype=np.int64)
    rank[sa], rank[n] = np.maximum.accumulate(np.where(head, np.arange(n), 0)), -1
    h = 8
    while h < n:
        tied = ~head
        tied[:-1] |= ~head[1:]
        spots = np.flatnonzero(tied)
        if not len(spots):
            break
        members = sa[spots]
        pair = (rank[members] << 32) | (rank[np.minimum(members + h, n)] + 1)
        order = np.argsort(pair, kind="stable")
        sa[spots], pair = members[order], pair[order]
        fresh = np.concatenate([[True], pair[1:] != pair[:-1]])
        head[spots[fresh]] = True
        rank[sa[spots]] = np.maximum.accumulate(np.where(fresh, spots, 0))
        h *= 2
    return sa, rank[:n]


def common_prefixes(text: np.ndarray, sa: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Kasai: the common prefix of each suffix with the one before it in ``sa``, up to ``most`` bytes.

    Lanes walk stretches of the text side by side; within a lane a suffix starts from its predecessor's length - 1.
    """
    n = len(text)
    place, before = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    place[sa] = np.arange(n)
    before[sa[0]], before[sa[1:]] = -1, sa[:-1]
    out = np.zeros(n, dtype=np.int64)
    lanes = max(1, min(4096, n // 64))
    step = -(-n // lanes)
    at = np.arange(lanes) * step
    stop = np.minimum(at + step, n)
    live = at < stop
    at, stop = at[live], stop[live]
    have = np.zeros(len(at), dtype=np.int64)
    while len(at):
        other = before[at]
        top = np.minimum(most, n - np.maximum(at, other))
        grow = (other >= 0) & (have < top)
        ok = np.flatnonzero(grow)
        grow[ok] = text[at[ok] + have[ok]] == text[other[ok] + have[ok]]
        done = ~grow
        out[place[at[done]]] = have[done]
        have = np.where(grow, have + 1, np.maximum(have - 1, 0))
        at = at + done
        if (at >= stop).any():
            live = at < stop
            at, stop, have = at[live], stop[live], have[live]
    return out


class Shard:
    """Some stretches, with the windows of LENGTH bytes in them in suffix order."""

    def __init__(self, rows: Stretches) -> None:
        body = rows.data
        self.text = np.concatenate([body, np.zeros(LENGTH, dtype=np.uint8)])
        owner = np.repeat(np.arange(len(rows)), rows.sizes)
        inside = np.arange(len(body)) - rows.begin[owner]
        sa, _ = suffix_array(body)
        prefix = common_prefixes(body, sa)
        is_window = inside < rows.n[owner]
        window = is_window[sa]
        run = np.cumsum(prefix < LENGTH)
        self.sa, run = sa[window], run[window]
        own = owner[self.sa]
        self.docs, self.rids, self.starts = rows.doc[own], rows.rid[own], rows.start[own] + inside[self.sa]
        again = np.concatenate([[False], run[1:] == run[:-1]])
        self.repeated = np.zeros(len(self.sa), dtype=bool)
        tied = np.flatnonzero(again | np.concatenate([again[1:], [False]]))
        order = tied[np.lexsort((self.starts[tied], self.rids[tied], self.docs[tied], run[tied]))]
        self.repeated[order] = np.concatenate([[False], run[order][1:] == run[order][:-1]])[: len(order)]
        self.spot = np.cumsum(is_window) - 1  # the number of a window in the order of the text
        self.views = sliding_window_view(self.text, LENGTH)

    def windows_repeated(self) -> np.ndarray:
        """Whether each window repeats, in the order of the text."""
        out = np.empty(len(self.sa), dtype=bool)
        out[self.spot[self.sa]] = self.repeated
        return out

    def windows(self, at: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(self.views[self.sa[at]]).view(f"S{LENGTH}").ravel()

    def key(self, i: int) -> tuple[int, int, int]:
        return int(self.docs[i]), int(self.rids[i]), int(self.starts[i])

    def merge(self, other: Shard) -> None:
        """Of equal windows that lead in both shards, the later one becomes a repeat. Binary search in ``other``."""
        mine = np.flatnonzero(~self.repeated)
        theirs = np.flatnonzero(~other.repeated)
        for at in range(0, len(mine), 8192):
            part = mine[at : at + 8192]
            want = self.windows(part)
            low, high = np.zeros(len(part), dtype=np.int64), np.full(len(part), len(theirs), dtype=np.int64)
            while (open_ := low < high).any():
                mid = (low + high) // 2
                less = other.windows(theirs[np.minimum(mid, len(theirs) - 1)]) < want
                low, high = np.where(open_ & less, mid + 1, low), np.where(open_ & ~less, mid, high)
            near = np.minimum(low, max(len(theirs) - 1, 0))
            if len(theirs):
                for i in np.flatnonzero((low < len(theirs)) & (other.windows(theirs[near]) == want)).tolist():
                    a, b = int(part[i]), int(theirs[near[i]])
                    if self.key(a) < other.key(b):
                        other.repeated[b] = True
                    else:
                        self.repeated[a] = True

    def marks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rid, first, last) of the runs of repeated windows."""
        starts = self.starts[self.repeated]
        return _runs(self.rids[self.repeated], starts, starts)


def _runs(rid: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of starts that don't overlap, neighbours joined: (rid, first, last)."""
    if not len(rid):
        return rid, first, last
    order = np.lexsort((first, rid))
    rid, first, last = rid[order], first[order], last[order]
    new = np.concatenate([[True], (rid[1:] != rid[:-1]) | (first[1:] > last[:-1] + 1)])
    head = np.flatnonzero(new)
    return rid[head], first[head], last[np.concatenate([head[1:], [len(rid)]]).astype(np.int64) - 1]


def _keys(rows: Stretches) -> np.ndarray:
    """Each stretch under its anchor hash as one string; the count at its end keeps strings from ending in zero bytes."""
    width = 8 + int(rows.sizes.max()) + 1
    out = np.zeros((len(rows), width), dtype=np.uint8)
    out[:, :8] = rows.hash.astype(">i8").view(np.uint8).reshape(-1, 8)
    line = np.repeat(np.arange(len(rows)), rows.sizes)
    out[line, 8 + np.arange(len(rows.data)) - rows.begin[line]] = rows.data
    out[np.arange(len(rows)), 8 + rows.sizes] = rows.n
    return out.view(f"S{width}").ravel()


def merge_runs(rows: Stretches) -> np.ndarray:
    """The first of each group of equal stretches, as positions in the order of (hash, stretch).

    The shards the rows are from are dealt to RUNS runs. A run is sorted; then runs are merged two by two: binary
    search places one's stretches in the other, equal ones meet, and the later one drops out.
    """
    keys = _keys(rows)
    rank = np.empty(len(rows), dtype=np.int64)
    rank[np.lexsort((rows.start, rows.rid, rows.doc))] = np.arange(len(rows))

    def sorted_run(at: np.ndarray) -> np.ndarray:
        at = at[np.argsort(rank[at])]
        at = at[np.argsort(keys[at], kind="stable")]
        return at[np.concatenate([[True], keys[at[1:]] != keys[at[:-1]]])[: len(at)]]

    runs = [sorted_run(np.flatnonzero(rows.shard % RUNS == r)) for r in range(RUNS)]
    while len(runs) > 1:
        merged = []
        for a, b in zip(runs[::2], runs[1::2]):
            if not len(a) or not len(b):
                merged.append(a if len(a) else b)
                continue
            place = np.searchsorted(keys[a], keys[b])
            near = np.minimum(place, len(a) - 1)
            equal = keys[a[near]] == keys[b]
            spot = near[equal]
            a = a.copy()
            a[spot] = np.where(rank[b[equal]] < rank[a[spot]], b[equal], a[spot])
            merged.append(np.insert(a, place[~equal], b[~equal]))
        runs = merged
    return runs[0]


def _repeat_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, first, last) of repeated starts, from a partition sorted by anchor hash."""

    def out(rid: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _runs(rid, first, last)], names=["rid", "first", "last"])

    held: list[Stretches] = []  # complete anchors with several different stretches, for the next shard
    parts: list[Shard] = []  # of the anchor that has outgrown one shard
    outgrown: int | None = None

    def settle(rows: Stretches) -> tuple[Stretches, pa.RecordBatch]:
        """One of each group of equal stretches, and the others as repeats."""
        first = merge_runs(rows)
        gone = np.ones(len(rows), dtype=bool)
        gone[first] = False
        return rows.take(first), out(rows.rid[gone], rows.start[gone], rows.start[gone] + rows.n[gone] - 1)

    def add_part(rows: Stretches) -> None:
        new = Shard(rows)
        for old in parts:
            new.merge(old)
        parts.append(new)

    def close(rows: Stretches) -> Iterator[pa.RecordBatch]:
        """The anchors of ``rows`` are complete."""
        nonlocal parts, outgrown
        rows, found = settle(rows)
        yield found
        if outgrown is not None:
            more = np.flatnonzero(rows.hash == outgrown)
            if len(more):
                add_part(rows.take(more))
                rows = rows.take(np.flatnonzero(rows.hash != outgrown))
            for p in parts:
                yield out(*p.marks())
            parts, outgrown = [], None
        several = np.concatenate([[False], rows.hash[1:] == rows.hash[:-1]])[: len(rows)]
        several |= np.concatenate([several[1:], [False]])[: len(rows)]
        if several.any():
            held.append(rows.take(np.flatnonzero(several)))
        if sum(len(h.data) for h in held) >= SHARD_BYTES:
            yield from flush()

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            yield out(*Shard(Stretches.concat(held)).marks())
            held.clear()

    waiting: list[Stretches] = []
    for b in batches:
        known = b.column("stretch").is_null().to_numpy(zero_copy_only=False)
        if known.any():
            rid, first, n = (b.column(c).to_numpy()[known] for c in ("rid", "start", "n"))
            yield out(rid, first, first + n - 1)
            b = b.filter(pa.array(~known))
        if b.num_rows:
            waiting.append(Stretches.read(b))
        if sum(len(w.data) for w in waiting) < 2 * SHARD_BYTES:
            continue
        rows = Stretches.concat(waiting)
        last = rows.hash[-1]
        done = int(np.searchsorted(rows.hash, last))
        if done:
            yield from close(rows.take(np.arange(done)))
        tail = rows.take(np.arange(done, len(rows)))
        if len(tail.data) >= SHARD_BYTES:
            tail, found = settle(tail)
            yield found
        if len(tail.data) >= SHARD_BYTES:
            outgrown = int(last)
            add_part(tail)
            tail = tail.take(np.zeros(0, dtype=np.int64))
        waiting = [tail] if len(tail) else []
    if waiting:
        yield from close(Stretches.concat(waiting))
    for p in parts:
        yield out(*p.marks())
    yield from flush()


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for b in batches:
        raw = b.column("text").cast(pa.binary())
        for lo, hi in chunks(pa.compute.binary_length(raw).to_pylist(), 8_000_000, 2048):
            part = b.slice(lo, hi - lo)
            spans, kept = [], []
            for text, found in zip(raw.slice(lo, hi - lo).to_pylist(), part.column("marks").to_pylist()):
                joined: list[list[int]] = []
                for m in sorted((m["first"], m["last"]) for m in found or ()):
                    if joined and m[0] <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], m[1] + LENGTH)
                    else:
                        joined.append([m[0], m[1] + LENGTH])
                edges = [0, *(x for s in joined for x in s), len(text)]
                kept.append(b"".join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
                spans.append([{"start": s, "end": e} for s, e in joined])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(map(len, raw.slice(lo, hi - lo).to_pylist()), pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans array<struct<start, end>> (the maximal removed runs) and kept binary, of every row."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("rid")).repartition(n, "rid")
    found = rows.select("rid", "text", "doc_id").mapInArrow(_anchor_groups, _GROUP_SQL)
    places = F.when(F.col("others").isNull(), 1).otherwise(F.size("others") + 1)
    counted = found.withColumn("_n", F.sum(places).over(Window.partitionBy("hash"))).filter("_n > 1")
    place = F.struct("rid", "spot")
    repeated = counted.select("hash", F.inline(F.when(F.col("others").isNull(), F.array(place)).otherwise(F.concat(F.array(place), "others"))))
    by_doc = repeated.groupBy("rid").agg(F.collect_list(F.struct("hash", "spot")).alias("a"))
    wanted = rows.join(by_doc.hint("shuffle_hash"), "rid").select("rid", "doc_id", "text", F.col("a.hash").alias("hashes"), F.col("a.spot").alias("spots"))
    stretches = wanted.mapInArrow(_stretch_rows, _STRETCH_SQL).repartition(n, "hash").sortWithinPartitions("hash")
    marks = stretches.mapInArrow(_repeat_rows, "rid bigint, first bigint, last bigint")
    by_doc = marks.groupBy("rid").agg(F.collect_list(F.struct("first", "last")).alias("marks"))
    joined = rows.join(by_doc.hint("shuffle_hash"), "rid", "left").select("doc_id", "text", "marks")
    return joined.mapInArrow(_cut_rows, "doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")

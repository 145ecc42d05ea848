"""Near-duplicates by SimHash fingerprints, found with Golay-code fuzzy keys.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits. The binary Golay code [23, 12, 7] is perfect: a
23-bit word lies within 3 bits of exactly one codeword, its own. The fuzzy keys of a word are the codewords within
4 bits: its own one, and 5 more if it is 3 bits off. Words at most one bit apart share keys: the own codeword of
either is among the keys of the other.

Pigeonhole over at most 3 errors in 3 segments: either some segment has none, and of the other two one has at most
one error; or each has just one. So fingerprints that link meet under a key of one of two forms:

* six forms (i, j): segment i itself with a codeword of segment j (own one on the probe side, keys on the other);
* one form of three codewords: own, own, keys on the probe side; keys, keys, own on the other.

Candidates are verified by the bits that differ, and links become components. Exact copies and equal fingerprints
are one node from the start, so no group of copies is expanded. Links stay linear in the number of distinct
fingerprints: one has at most 43,744 others within 3 bits, and at most 128 are all within 3 bits of each other.

Defined cases: a null or wordless text has fingerprint zero; a null id never wins a component that has an id;
repeated rows share one; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, join_groups, row_type, rows_with_text, texts_of
from .components import components

MAX_BITS = 3
SEGMENTS = ((42, 22), (21, 21), (0, 21))
#: Generator polynomial of the binary Golay code [23, 12, 7], x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (fixed value).
GENERATOR = 0b101011100011


def fingerprint(text: str | None, width: int = 3) -> int:
    """Majority vote over the bits of XXH64 (seed 42) of every ``width``-word shingle, repeats included; unsigned."""
    data = b" ".join((text or "").encode().lower().split())
    if not data:
        return 0
    raw = np.frombuffer(data, dtype=np.uint8)
    gaps = np.flatnonzero(raw == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(data)]
    k = min(width, len(starts))
    hashes = np.array([xxhash.xxh64_intdigest(data[a:b], 42) for a, b in zip(starts, ends[k - 1 :])], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(row, fingerprint bigint) of every row: ``keep`` (all columns, if None) as a struct, and the bits as a signed number."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                found = np.array([fingerprint(x.as_py()) for x in texts_of(part)], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(found, pa.int64())], names=["row", "fingerprint"])

    rows = rows_with_text(docs, keep)
    return rows.mapInArrow(each, f"{row_type(rows)}, fingerprint bigint")


class Golay:
    """Tables of the code: the own codeword of each 23-bit word, and the patterns that lead to the others nearby."""

    _tables: Golay | None = None

    def __init__(self) -> None:
        words = np.zeros(1, dtype=np.int64)
        for i in range(12):
            words = np.concatenate([words, words ^ (GENERATOR << i)])
        self.words = words
        patterns = [sum(1 << b for b in bits) for w in range(4) for bits in itertools.combinations(range(23), w)]
        self.own = np.zeros(1 << 23, dtype=np.int16)
        index = np.arange(len(words), dtype=np.int16)
        for e in patterns:
            self.own[words ^ e] = index
        #: For each pattern of 3 bits (a row), the 5 patterns of 4 bits that differ from it by a codeword.
        light = words[np.bitwise_count(words) == 7]
        threes = np.array([p for p in patterns if p.bit_count() == 3], dtype=np.int64)
        self.fours = np.stack([light[(light & e) == e] ^ e for e in threes])
        self.row = np.full(1 << 23, -1, dtype=np.int16)
        self.row[threes] = np.arange(len(threes))

    @classmethod
    def tables(cls) -> Golay:
        if cls._tables is None:
            cls._tables = cls()
        return cls._tables

    def keys(self, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(own codeword index, (n, 6) fuzzy key indices with -1 where there are none)."""
        own = self.own[segment].astype(np.int64)
        row = self.row[segment ^ self.words[own]]
        out = np.full((len(segment), 6), -1, dtype=np.int64)
        out[:, 0] = own
        far = row >= 0
        out[far, 1:] = self.own[segment[far, None] ^ self.fours[row[far]]]
        return own, out


def fuzzy_keys(prints: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Probe keys and index keys of each fingerprint (uint64)."""
    code = Golay.tables()
    parts = [((prints >> np.uint64(at)) & np.uint64((1 << size) - 1)).astype(np.int64) for at, size in SEGMENTS]
    found = [code.keys(p) for p in parts]
    probe, index = [], []
    for tag, (i, j) in enumerate(itertools.permutations(range(3), 2)):
        head = (np.int64(tag) << 36) | (parts[i] << 12)
        probe.append((head | found[j][0])[:, None])
        index.append(np.where(found[j][1] >= 0, head[:, None] | found[j][1], -1))
    head = np.int64(6) << 36
    (own0, all0), (own1, all1), (own2, all2) = found
    probe.append(np.where(all2 >= 0, (head | (own0 << 24) | (own1 << 12))[:, None] | all2, -1))
    pairs = (all0[:, :, None] << 24) | (all1[:, None, :] << 12) | own2[:, None, None] | head
    index.append(np.where((all0[:, :, None] >= 0) & (all1[:, None, :] >= 0), pairs, -1).reshape(len(prints), 36))
    return [np.concatenate(side, axis=1) for side in (probe, index)]


def _ragged(keys: np.ndarray) -> pa.Array:
    real = keys >= 0
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], real.sum(axis=1).cumsum()]), pa.int32()), pa.array(keys[real], pa.int64()))


def links(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(u, v), u < v: the pairs of distinct fingerprints at most ``bits`` (up to 3) apart."""
    if not 0 <= bits <= MAX_BITS:
        raise ValueError("the keys find up to 3 differing bits")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 8192):
                col = b.column("fingerprint")[at : at + 8192]
                probe, index = fuzzy_keys(col.to_numpy(zero_copy_only=False).view(np.uint64))
                yield pa.RecordBatch.from_arrays([col, _ragged(probe), _ragged(index)], names=["f", "probe", "index"])

    spread = prints.select("fingerprint").repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fingerprint")  # a row becomes about 60
    keyed = spread.mapInArrow(each, "f bigint, probe array<bigint>, index array<bigint>")
    probe = keyed.select(F.col("f").alias("u"), F.explode("probe").alias("k"))
    index = keyed.select(F.col("f").alias("v"), F.explode("index").alias("k"))
    near = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= bits)
    # Sizes are estimated before the keys are exploded, so a broadcast would not be bounded: both sides are shuffled.
    return probe.alias("p").join(index.alias("i").hint("merge"), (F.col("p.k") == F.col("i.k")) & near).select("u", "v").distinct()


def _rooted(marked: DataFrame, bits: int) -> DataFrame:
    """fingerprint, first_id, n_rows, root: the smallest fingerprint reachable over links, one row for each fingerprint."""
    nodes = durable(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_rows")))
    roots = durable(components(links(nodes, bits))).withColumnRenamed("node", "fingerprint")
    return nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))


def near_duplicates(docs: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint bigint, component_id: the smallest id reachable over links of up to ``bits`` bits."""
    marked = durable(fingerprints(docs, ["doc_id"]).select("row.doc_id", "fingerprint"))
    rooted = _rooted(marked, bits)
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = durable(rooted.join(least, "root").select("fingerprint", "component_id", "n_rows"))
    return join_groups(marked, classes, "fingerprint", "n_rows").select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, one of each component: that of the smallest id.

    Components are told apart by their root: the smallest id is null in each without ids, and unlike texts may share one.
    """
    rows = durable(fingerprints(docs))
    marked = rows.select("row.doc_id", "fingerprint")
    least = F.min(F.struct(F.col("first_id").isNull(), "first_id", "fingerprint"))
    keepers = _rooted(marked, bits).groupBy("root").agg(least.alias("k")).select(F.col("k.fingerprint").alias("fingerprint"), F.col("k.first_id").alias("keep_id"))
    once = F.row_number().over(Window.partitionBy("print", "keep_id").orderBy("print"))
    # The id is a join key too, so the copies of one text are dealt to many tasks.
    kept = keepers.withColumnRenamed("fingerprint", "print").hint("merge")
    mine = rows.join(kept, (F.col("fingerprint") == F.col("print")) & F.col("row.doc_id").eqNullSafe(F.col("keep_id")))
    return mine.withColumn("n", once).filter("n = 1").select("row.*")

"""Features of texts for the small models: hashed byte trigrams and binned layout terms, counted in numpy, and cues."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts_of
from .pieces import chunks

GRAMS = 1024
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE = re.compile(r"[^.!?;\n]+")
#: Lengths of the word beginnings that can be cues.
STEMS = (3, 4, 5, 6, 7, 8)
#: Upper edges of the bins of each layout ratio.
BINS = {
    "symbols_per_word": (0.001, 0.02, 0.05, 0.1, 0.2, 0.4, 0.8),
    "repeats_per_word": (0.001, 0.01, 0.03, 0.1, 0.3, 0.6),
    "bars_per_word": (0.001, 0.02, 0.1, 0.3),
    "word_length": (2.0, 3.0, 4.0, 5.0, 6.0, 8.0, 12.0),
    "capital_words": (0.02, 0.1, 0.25, 0.5, 0.8),
    "digits": (0.001, 0.01, 0.05, 0.2),
    "marks_per_word": (0.02, 0.05, 0.1, 0.2, 0.4),
    "words": (1.0, 5.0, 10.0, 30.0, 100.0, 1000.0),
}
LAYOUT = sum(len(e) + 1 for e in BINS.values())
WIDTH = GRAMS + LAYOUT
_SPACE, _SYMBOL, _UPPER, _DIGIT, _MARK = (np.zeros(256, dtype=bool) for _ in range(5))
_SPACE[[32, *range(9, 14)]] = True
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[list(b".,;:!?")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[48:58] = 48


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(documents, WIDTH) counts as float32, and the number of words of each document."""
    n = len(texts)
    body = np.frombuffer(b"".join([t + b"  " for t in texts]), dtype=np.uint8)
    doc = np.repeat(np.arange(n), [len(t) + 2 for t in texts])
    low = _LOWER[body].astype(np.uint32)
    gram = low[:-2] | (low[1:-1] << 8) | (low[2:] << 16)
    slot = ((gram * np.uint32(0x9E3779B1)) >> np.uint32(22)).astype(np.int64)
    own = doc[:-2] == doc[2:]
    counts = np.bincount(doc[:-2][own] * GRAMS + slot[own], minlength=n * GRAMS).reshape(n, GRAMS)
    blank = _SPACE[body]
    first = ~blank & np.concatenate([[True], blank[:-1]])
    start = np.flatnonzero(first)
    words = np.bincount(doc[start], minlength=n).astype(np.float64)
    per = lambda mask: np.bincount(doc[mask], minlength=n)
    some = np.maximum(words, 1)
    if len(start):
        place = np.arange(len(body)) - np.repeat([0, *start], np.diff([0, *start, len(body)]))
        mixed = np.where(blank, np.uint64(0), (body.astype(np.uint64) + np.uint64(1)) * ((place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)))
        sums = np.add.reduceat(mixed, start)
        same = np.concatenate([[False], (sums[1:] == sums[:-1]) & (doc[start[1:]] == doc[start[:-1]])])
        repeats = np.bincount(doc[start[same]], minlength=n)
    else:
        repeats = np.zeros(n)
    letters = np.bincount(doc[~blank], minlength=n)
    ratios = {
        "symbols_per_word": per(_SYMBOL[body]) / some, "repeats_per_word": repeats / some, "bars_per_word": per(body == 124) / some, "word_length": letters / some,
        "capital_words": np.bincount(doc[start[_UPPER[body[start]]]], minlength=n) / some, "digits": per(_DIGIT[body]) / np.maximum(letters, 1), "marks_per_word": per(_MARK[body]) / some, "words": words,
    }
    layout = np.zeros((n, LAYOUT), dtype=np.float32)
    at = 0
    for name, edges in BINS.items():
        layout[np.arange(n), at + np.searchsorted(edges, ratios[name], side="left")] = 1
        at += len(edges) + 1
    return np.concatenate([np.log1p(counts).astype(np.float32), layout], axis=1), words.astype(np.int64)


def weigh(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Inverse document frequency and unit length, for trigrams and layout terms apart, so that neither drowns.

    Columns beyond WIDTH (cues) stay as they are.
    """
    x = x * np.concatenate([idf, np.ones(x.shape[1] - WIDTH, dtype=np.float32)])
    for part in (x[:, :GRAMS], x[:, GRAMS:WIDTH]):
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
    return x


def inverse_frequency(x: np.ndarray) -> np.ndarray:
    return np.log((1 + len(x)) / (1 + (x[:, :WIDTH] > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)


def each_block(batches: Iterator[pa.RecordBatch], most: int = 1_000_000, cues: Sequence[dict[str, float]] = ()) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, terms, words) in blocks of bounded bytes. Each of ``cues`` adds three
    columns: how much of it a text has, its strongest one, and how dense it is among the words."""
    finders = [CueFinder(c) for c in cues]
    for b in batches:
        said = texts_of(b)
        raw = said.cast(pa.binary())
        sizes = pa.compute.binary_length(raw).to_pylist()
        for lo, hi in chunks(sizes, most, 512):
            part = b.slice(lo, hi - lo)
            x, words = terms(raw.slice(lo, hi - lo).to_pylist())
            if finders:
                texts = said.slice(lo, hi - lo).to_pylist()
                sums, tops = _found(finders, texts)
                dense = np.log1p(100 * sums / (20 + words[:, None]))
                x = np.concatenate([x, np.log1p(sums) / 4, tops / 4, dense / 4], axis=1).astype(np.float32)
            yield part, x, words


def _found(finders: list[CueFinder], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    got = np.array([[f(t) for f in finders] for t in texts], dtype=np.float32).reshape(len(texts), len(finders), 2)
    return got[:, :, 0], got[:, :, 1]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, allowed: Column, values: Sequence[int]) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled ids for each of ``values``, the first by a hash of the id.

    One row for each id: an id with several labels has the largest, one with several texts the least. So no more than
    ``len(values) * most`` rows come out, however often an id repeats. Labels outside ``values`` are not looked at.
    """
    own = labels.filter(F.col(label).isin(*values) & allowed).groupBy("doc_id").agg(F.max(label).alias("label"))
    picked = [own.filter(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for v in values]
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(reduce(DataFrame.union, picked)), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))


def sample_terms(sample: DataFrame, cues: Sequence[dict[str, float]] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Terms and labels of a bounded sample, on the driver: one short vector a row, never the texts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x, _ in each_block(batches, cues=cues):
            vectors = pa.array([v.tobytes() for v in x.astype(np.float16)], pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("label"), vectors], names=["doc_id", "label", "vector"])

    got = sample.select("doc_id", F.col("label").cast("int").alias("label"), "text").mapInArrow(each, "doc_id bigint, label int, vector binary").collect()
    got.sort(key=lambda r: (r.doc_id, bytes(r.vector)))
    x = np.frombuffer(b"".join(bytes(r.vector) for r in got), dtype=np.float16).reshape(-1, WIDTH + 3 * len(cues)).astype(np.float32)
    return x, np.array([r.label for r in got], dtype=np.int64)


def beginnings(text: str) -> set[str]:
    """The distinct words of a text (ending in a space) and their beginnings."""
    words = set(WORD.findall(text))
    return {w + " " for w in words if len(w) > 2} | {w[:n] for w in words for n in STEMS if n < len(w)}


def _clauses(rows: DataFrame) -> DataFrame:
    """(doc_id, label, clause): the distinct clauses of all rows, each with the first row that has it.

    So copies and stock phrases speak once, however many rows hold them.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                found = [list(dict.fromkeys(CLAUSE.findall(t.lower()))) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(found, pa.list_(pa.string()))], names=["doc_id", "label", "clauses"])

    found = rows.select("doc_id", F.col("label").cast("int").alias("label"), "text").mapInArrow(each, "doc_id bigint, label int, clauses array<string>")
    one = found.select("doc_id", "label", F.explode("clauses").alias("clause"))
    first = one.groupBy(F.xxhash64("clause").alias("h")).agg(F.min(F.struct("doc_id", "label", "clause")).alias("f"))
    return first.select("f.*")


def learn_cues(sample: DataFrame, least: int = 5, odds: float = 2.0, chance: float = 0.01) -> dict[str, float]:
    """Words and word beginnings that tell label 1 from 0 in ``sample`` (doc_id, text, label), with their log-odds.

    A text of label 1 counts with the clauses that no earlier text has, one of label 0 with all. A cue is in ``least``
    texts of label 1 or more, has log-odds of ``odds`` or more, and beats chance at level ``chance`` over all cues
    tried (a Chernoff bound on how often its texts have label 1). Of a chain of beginnings the one furthest from
    chance stays.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[tuple[int, str]] = Counter()
        for b in batches:
            for label, clauses in zip(b.column("label").to_pylist(), b.column("clauses").to_pylist()):
                n.update((label, c) for c in set().union(*(beginnings(x.lower()) for x in clauses)))
        found = list(n)
        for at in range(0, len(found), 50_000):
            part = found[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([c for _, c in part], pa.string()), pa.array([y for y, _ in part], pa.int32()), pa.array([n[x] for x in part], pa.int64())], names=["cue", "label", "n"])

    size = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    pos, neg = size.get(1, 0), size.get(0, 0)
    if not pos or not neg:
        return {}
    own = _clauses(sample).filter("label = 1").groupBy("doc_id", "label").agg(F.collect_list("clause").alias("clauses")).select("label", "clauses")
    all_ = sample.filter("label = 0").select(F.lit(0).alias("label"), F.array("text").alias("clauses"))
    tally = own.union(all_).mapInArrow(each, "cue string, label int, n bigint").groupBy("cue")
    both = tally.agg(F.sum(F.col("n") * F.col("label")).alias("a"), F.sum(F.col("n") * (1 - F.col("label"))).alias("b")).filter(F.col("a") >= least).persist()
    tried = both.count()
    share = F.col("a") / (F.col("a") + F.col("b"))
    base = pos / (pos + neg)
    rest = F.when(share < 1, (1 - share) * F.ln((1 - share) / (1 - base))).otherwise(F.lit(0.0))
    surprise = (F.col("a") + F.col("b")) * (share * F.ln(share / base) + rest)
    value = F.ln((F.col("a") + 0.5) / (pos + 1.0)) - F.ln((F.col("b") + 0.5) / (neg + 1.0))
    found = both.select("cue", value.alias("value"), surprise.alias("surprise")).filter((F.col("surprise") > math.log(max(tried, 1) / chance)) & (F.col("value") >= odds) & (share > base))
    rows = {r.cue: (r.surprise, r.value) for r in found.collect()}
    both.unpersist()
    longer: dict[str, float] = {}
    for cue, (far, _) in rows.items():
        for n in range(min(STEMS), len(cue)):
            longer[cue[:n]] = max(longer.get(cue[:n], 0.0), far)
    kept: dict[str, float] = {}
    for cue in sorted(rows, key=lambda c: (len(c), c)):
        if rows[cue][0] >= longer.get(cue, 0.0) and not any(cue[:n] in kept for n in range(min(STEMS), len(cue))):
            kept[cue] = rows[cue][1]
    return kept


class CueFinder:
    """The sum and the largest of the weights of the words that begin with a cue (a cue ending in a space: are it)."""

    def __init__(self, cues: dict[str, float]) -> None:
        self.search = ahocorasick.Automaton()
        for cue, weight in cues.items():
            name = cue.rstrip()
            self.search.add_word(name, (len(name), name != cue, weight))
        self.any = bool(cues)
        if self.any:
            self.search.make_automaton()

    def __call__(self, text: str) -> tuple[float, float]:
        total = most = 0.0
        if self.any:
            low = text.lower()
            for end, (size, whole, weight) in self.search.iter(low):
                if (end + 1 == size or not low[end - size].isalpha()) and not (whole and end + 1 < len(low) and low[end + 1].isalpha()):
                    total, most = total + weight, max(most, weight)
        return total, most

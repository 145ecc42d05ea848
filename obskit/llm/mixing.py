"""Mixing sources to target weights with soft membership.

A softmax classifier fitted on a labelled table gives each document a posterior over domains, from hashed trigrams,
layout, and for each domain the words and word beginnings that mark it. A document of n tokens adds rate x n x posterior to the expected tokens of the domains. Rates minimise the squared distance between
expected and target tokens over rates of 0 or more, and of all such rates they are those nearest to 1.

The solver is projected gradient with the projection applied to the accumulated step (dual averaging): the gradient
of a document is posterior . residual, so after any number of steps its rate is max(0, 1 + posterior . slope), and a
fit is ``slope``, one number a domain. Each step is one aggregate over all documents (the residual, and the Gram
matrix of the rates above 0, which scales the step), each line search another. Reachable targets are met to
``tolerance`` of all tokens; the totals reached and what is left are part of the result, and a fit that stays short
warns. A rate becomes whole copies: its floor, and one more by a keyed hash for the fraction.

Defined cases: a null text has no tokens; repeated rows have the same rate and copies; without labelled rows every
posterior is uniform; without tokens all rates stay 1; domains outside the targets' numbers are not looked at; a
domain nobody belongs to stays short of its target, and the warning says so.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, row_type, rows_with_text
from .features import each_block, inverse_frequency, labelled_sample, learn_cues, sample_terms, weigh

#: Domains of the labelled table by number, and the token shares asked for.
DOMAINS = ("clean", "junk", "toxic")
TARGETS = {"clean": 0.93, "junk": 0.06, "toxic": 0.01}


@dataclass
class DomainModel:
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    cues: tuple[dict[str, float], ...]

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        z = weigh(x, self.idf) @ self.weights + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): 2 toxic, 1 junk, 0 clean; null without either label."""
    unknown = F.col("toxic").isNull() & F.col("quality").isNull()
    return labels.select("doc_id", F.when(unknown, None).when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0).alias("domain"))


def fit_domains(docs: DataFrame, labelled: DataFrame, n_domains: int, sample: int = 1500, steps: int = 300, ridge: float = 1e-3) -> DomainModel:
    """Softmax regression by accelerated gradient descent on at most ``sample`` rows of each domain."""
    rows = labelled_sample(docs, labelled, "domain", sample, F.lit(True), range(n_domains)).persist()
    cues = tuple(learn_cues(rows.withColumn("label", (F.col("label") == d).cast("int"))) for d in range(n_domains))
    x, y = sample_terms(rows, cues)
    rows.unpersist()
    idf = inverse_frequency(x)
    model = DomainModel(idf, np.zeros((x.shape[1], n_domains), dtype=np.float32), np.zeros(n_domains, dtype=np.float32), cues)
    if not len(y):
        return model
    found = {r["domain"]: r["n"] for r in labelled.filter(F.col("domain").isin(*range(n_domains))).groupBy("domain").agg(F.count("*").alias("n")).collect()}
    w = np.array([found.get(v, 1) / max(1, (y == v).sum()) for v in y.tolist()])
    w /= w.sum()
    one = np.eye(n_domains)[y]
    z = np.concatenate([weigh(x, idf), np.ones((len(x), 1), dtype=np.float32)], axis=1).astype(np.float64)
    rate = 1 / (0.5 * np.linalg.norm(z.T @ (z * w[:, None]), 2) + ridge)
    b = old = np.zeros((z.shape[1], n_domains))
    for t in range(1, steps + 1):
        at = b + (t - 1) / (t + 2) * (b - old)
        p = np.exp((s := z @ at) - s.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        old, b = b, at - rate * (z.T @ ((p - one) * w[:, None]) + ridge / 10 * at)
    model.weights, model.bias = b[:-1].astype(np.float32), b[-1].astype(np.float32)
    return model


def soft_members(docs: DataFrame, model: DomainModel, keep: list[str] | None = None) -> DataFrame:
    """(row, n_tokens, posterior array<double>) of every row: ``keep`` (all columns, if None) as a struct, its words,
    and its domains."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for rows, x, words in each_block(batches, cues=m.cues):
            p = m.posteriors(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel().astype(np.float64)))
            yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(words, pa.int64()), lists], names=["row", "n_tokens", "posterior"])

    rows = rows_with_text(docs, keep)
    return rows.mapInArrow(each, f"{row_type(rows)}, n_tokens bigint, posterior array<double>")


@dataclass(frozen=True)
class Rates:
    """``rate`` of a row as max(0, 1 + posterior . slope), and the tokens it leads to."""

    slope: np.ndarray
    expected: np.ndarray
    target: np.ndarray

    @property
    def residual(self) -> float:
        """Distance between expected and target tokens, as a share of all tokens."""
        return float(np.linalg.norm(self.expected - self.target) / max(self.target.sum(), 1e-300))

    @property
    def rate(self) -> Column:
        return rate_of(self.slope)


def rate_of(slope: np.ndarray) -> Column:
    step = F.lit(1.0)
    for i, s in enumerate(slope):
        step = step + F.lit(float(s)) * F.col("posterior")[i]
    return F.greatest(F.lit(0.0), step)


def fit_rates(members: DataFrame, targets: list[float], tolerance: float = 1e-6, most: int = 60, slack: float = 1e-9) -> Rates:
    """The rates of ``members`` (n_tokens, posterior) whose expected tokens of each domain are nearest to ``targets``.

    ``targets`` are shares; together they stand for the tokens that ``members`` has at rate 1. The slope is where the
    concave function target . slope - sum(n rate^2 / 2) - slack |slope|^2 / 2 peaks; its gradient is the residual,
    its curvature the Gram matrix. A step is shortened until it
    halves the gradient or the function grows by a share of what the gradient promises.
    """
    k = len(targets)
    p = [F.col("posterior")[i] for i in range(k)]
    share = np.array(targets, dtype=np.float64) / sum(targets)

    def totals(slope: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
        rate = rate_of(slope)
        mass = rate * F.col("n_tokens")
        free = F.when(rate > 0, F.col("n_tokens")).otherwise(0)
        sums = members.agg(*[F.sum(mass * p[i]) for i in range(k)], *[F.sum(free * p[i] * p[j]) for i in range(k) for j in range(k)], F.sum(mass * rate), F.sum("n_tokens")).first()
        value = [float(x or 0) for x in sums]
        return np.array(value[:k]), np.array(value[k:-2]).reshape(k, k), value[-2], value[-1]

    slope = np.zeros(k)
    have, gram, cost, tokens = totals(slope)
    goal = share * tokens
    if not tokens:
        return Rates(slope, have, goal)

    def height(at: np.ndarray, cost: float) -> float:
        return goal @ at - cost / 2 + tokens / 2 - slack * tokens * (at @ at) / 2

    for _ in range(most):
        miss = goal - have
        if np.linalg.norm(miss) < tolerance * tokens:
            break
        pull = miss - slack * tokens * slope
        step = np.linalg.solve(gram + (slack + 1e-12) * tokens * np.eye(k), pull)
        scale, promised, top = 1.0, float(pull @ step), height(slope, cost)
        while scale > 1e-6:
            there = totals(slope + scale * step)
            nearer = np.linalg.norm(goal - there[0] - slack * tokens * (slope + scale * step)) < 0.5 * np.linalg.norm(pull)
            if nearer or height(slope + scale * step, there[2]) >= top + 1e-4 * scale * promised:
                break
            scale /= 4
        else:
            break
        slope = slope + scale * step
        have, gram, cost, _ = there
    out = Rates(slope, have, goal)
    if out.residual > 10 * tolerance:
        warnings.warn(f"mixing stays {out.residual:.2e} of all tokens from its targets: expected {have.tolist()}, wanted {goal.tolist()}", stacklevel=2)
    return out


def copies_of(rate: Column, key: Column, seed: int) -> Column:
    """The rate's floor, and one more with the chance of its fraction, by a keyed hash."""
    unit = (F.shiftrightunsigned(F.xxhash64(F.coalesce(key, F.lit(0)), F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return (F.floor(rate) + F.when(unit < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float] = TARGETS, seed: int = 11, sample: int = 1500, keep: list[str] | None = None) -> DataFrame:
    """row, n_tokens, posterior, rate, copies, residual for every row of ``docs``; ``row`` has ``keep`` (all columns,
    if None), ``residual`` is how far the expected totals stay from the targets, as a share of all tokens."""
    model = fit_domains(docs, labelled, len(targets), sample)
    members = durable(soft_members(docs, model, keep if keep is None or "doc_id" in keep else ["doc_id", *keep]))
    fitted = fit_rates(members, list(targets.values()))
    rated = members.withColumn("rate", fitted.rate)
    return rated.withColumns({"copies": copies_of(F.col("rate"), F.col("row.doc_id"), seed), "residual": F.lit(fitted.residual)})

"""Toxicity scoring with a weighted finite-state pattern grammar.

Five transducers read the words of a clause one after another; each passes a word's classes on to the next, with
marks of its own: the target machine marks words near the person spoken to, negation marks a scope of a few words,
reported speech the rest of the clause. The insult machine then emits marked insults, and the threat machine emits a
threat once a verb of harm and its target have met, in either order where the target is an object pronoun; it keeps
the marks its verb had. A word may be of several classes at once. The five are composed into one machine, built
as its states are met, and that machine runs once over each clause with an insult or a threat in it. A clause's
score is the sum of what it emits, each under the factors of its marks; a document's score is a logistic function of
its worst clause, of all its clauses, and of how dense they are among its words.

Learnt from labels: the insult arcs (``features.learn_cues``: words and word beginnings that clauses of toxic texts
have more often than chance explains, and their weights), the factor of each mark and the weight of a threat (by
likelihood, drawn towards the stated starting values where rows say little), and the logistic function. Arcs come
from two thirds of at most ``sample`` rows of each label, the rest from the other third. The closed classes (targets,
negations, verbs of reporting, verbs of harm) are lists.

Defined cases: a null text counts as empty and gets the score of a text without matches; repeated rows score alike;
without labelled rows of both kinds there are no insult arcs and threats alone count; labels other than 0 and 1 and
other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Callable, Hashable, Iterator
from dataclasses import dataclass, field, replace

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_type, rows_with_text, texts_of
from .features import CLAUSE, STEMS, WORD, labelled_sample, learn_cues

THREATS = "kill hurt destroy beat punch stab shoot burn crush töten schlagen vernichten umbringen verprügeln tuer frapper détruire brûler écraser matar golpear destruir quemar aplastar".split()
TARGETS = "you your yours yourself u du dich dir dein deine euch euer ihr tu te toi ton ta tes vous votre vos tú ti vosotros usted ustedes vuestro".split()
OBJECTS = "dich dir euch te toi ti os".split()
NEGATIONS = "not no never isn't aren't wasn't don't doesn't nicht kein keine nie niemals ne pas jamais aucun nunca jamás ni tampoco sin".split()
REPORTS = "said says wrote writes quoted claimed called reported sagte sagt schrieb zitierte nannte dit écrit écrivit cité appelé dijo dice escribió citó llamó".split()

#: Classes of words, and the marks that transducers add to them.
INSULT, THREAT, TARGET, OBJECT, NEGATION, REPORT, NEAR, NEGATED, REPORTED = (1 << i for i in range(9))
MARKS = (NEAR, NEGATED, REPORTED)
CLASSES = ((THREATS, THREAT), (TARGETS, TARGET), (OBJECTS, OBJECT), (NEGATIONS, NEGATION), (REPORTS, REPORT))


@dataclass(frozen=True)
class Transducer:
    """``arcs(state, symbol)``: the next state, the symbol passed on, and the symbols emitted."""

    start: Hashable
    arcs: Callable[[Hashable, int], tuple[Hashable, int, tuple[int, ...]]]


def scope(trigger: int, length: int | None, mark: int) -> Transducer:
    """Mark the ``length`` words (None: all) after a word of class ``trigger``."""

    def arcs(state: int, symbol: int) -> tuple[int, int, tuple[int, ...]]:
        after = (length or 1) if symbol & trigger else max(state - (length is not None), 0)
        return after, symbol | mark if state else symbol, ()

    return Transducer(0, arcs)


def insults() -> Transducer:
    return Transducer(0, lambda state, symbol: (0, symbol, (INSULT | symbol & sum(MARKS),) if symbol & INSULT else ()))


def threats(reach: int = 4) -> Transducer:
    """States: words left for a verb's target, the verb's marks, words left for an object's verb."""

    def arcs(state: tuple[int, int, int], symbol: int) -> tuple[tuple[int, int, int], int, tuple[int, ...]]:
        verb, marks, objected = state
        own = symbol & (NEGATED | REPORTED)
        if symbol & THREAT and objected:
            return (0, 0, 0), symbol, (THREAT | own,)
        if symbol & THREAT:
            return (reach, own, 0), symbol, ()
        if symbol & TARGET and verb:
            return (0, 0, 0), symbol, (THREAT | marks,)
        verb = max(verb - 1, 0)
        return (verb, marks if verb else 0, reach if symbol & OBJECT else max(objected - 1, 0)), symbol, ()

    return Transducer((0, 0, 0), arcs)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """``second`` reads what ``first`` passes on; both emit. Arcs are kept once met."""
    known: dict[tuple[Hashable, int], tuple[Hashable, int, tuple[int, ...]]] = {}

    def arcs(state: Hashable, symbol: int) -> tuple[Hashable, int, tuple[int, ...]]:
        got = known.get((state, symbol))
        if got is None:
            a, passed, out = first.arcs(state[0], symbol)
            b, passed, more = second.arcs(state[1], passed)
            got = known[(state, symbol)] = ((a, b), passed, out + more)
        return got

    return Transducer((first.start, second.start), arcs)


def machines() -> tuple[Transducer, ...]:
    return scope(TARGET | OBJECT, 6, NEAR), scope(NEGATION, 3, NEGATED), scope(REPORT, None, REPORTED), insults(), threats()


def grammar() -> Transducer:
    whole, *rest = machines()
    for m in rest:
        whole = compose(whole, m)
    return whole


#: What a clause can emit, in the order of its totals: insults and threats under each set of marks.
EMITTED = tuple(INSULT | a | b | c for a in (0, NEAR) for b in (0, NEGATED) for c in (0, REPORTED)) + tuple(THREAT | b | c for b in (0, NEGATED) for c in (0, REPORTED))
PLACE = {e: i for i, e in enumerate(EMITTED)}


@dataclass
class ToxicityModel:
    """``arcs``: word beginnings (ending in a space: whole words) and their weights; the factor of each mark."""

    arcs: dict[str, float]
    near: float = 1.25
    negated: float = 0.25
    reported: float = 0.5
    threat: float = 3.0
    bias: float = -3.0
    worst: float = 0.8
    total: float = 0.4
    dense: float = 0.0
    _ready: tuple | None = field(default=None, repr=False)

    def _build(self) -> tuple:
        if self._ready is None:
            search = ahocorasick.Automaton()
            for cue in {a.rstrip() for a in self.arcs} | set(THREATS):
                search.add_word(cue, len(cue))
            search.make_automaton()
            classes: dict[str, int] = {}
            for words, c in CLASSES:
                for w in words:
                    classes[w] = classes.get(w, 0) | c
            self._ready = (search, classes, grammar(), self.factors())
        return self._ready

    def __getstate__(self):
        return self.__dict__ | {"_ready": None}

    def factors(self) -> np.ndarray:
        """What one unit of each of ``EMITTED`` counts."""
        by_mark = {NEAR: self.near, NEGATED: self.negated, REPORTED: self.reported}
        return np.array([math.prod(f for m, f in by_mark.items() if e & m) * (self.threat if e & THREAT else 1.0) for e in EMITTED])

    def weight(self, word: str) -> float:
        arcs = self.arcs
        return max([arcs.get(word + " ", 0.0), *(arcs.get(word[:n], 0.0) for n in STEMS if n <= len(word))])

    def emitted(self, text: str) -> Iterator[tuple[str, dict[int, float]]]:
        """The clauses that emit something, and the weight of each kind: those of words for insults, 1 a threat."""
        search, classes, machine, _ = self._build()
        low = text.lower()
        hits = [end + 1 - size for end, size in search.iter(low) if end + 1 == size or not low[end - size].isalpha()]
        if not hits:
            return
        hits.sort()
        for m in CLAUSE.finditer(low):
            at = bisect_left(hits, m.start())
            if at == len(hits) or hits[at] >= m.end():
                continue
            state, found = machine.start, {}
            for w in WORD.findall(m.group()):
                own = self.weight(w)
                state, _, out = machine.arcs(state, classes.get(w, 0) | (INSULT if own else 0))
                for e in out:
                    found[e] = found.get(e, 0.0) + (own if e & INSULT else 1.0)
            if found:
                yield m.group(), found

    def clauses(self, text: str) -> list[tuple[str, float]]:
        """The clauses that match, with their scores above 0."""
        factors = self._build()[3]
        return [(c, float(sum(x * factors[PLACE[e]] for e, x in found.items()))) for c, found in self.emitted(text)]

    def totals(self, text: str) -> np.ndarray:
        out = np.zeros(len(EMITTED))
        for _, found in self.emitted(text):
            for e, x in found.items():
                out[PLACE[e]] += x
        return out

    def features(self, text: str, clauses: list[tuple[str, float]] | None = None) -> tuple[float, float, float]:
        """The worst clause, all clauses, and all clauses for each 100 words (20 at least)."""
        scores = [s for _, s in (self.clauses(text) if clauses is None else clauses)]
        if not scores:
            return 0.0, 0.0, 0.0
        total = sum(scores)
        return max(scores), math.log1p(total), math.log1p(100 * total / (20 + len(text.split())))

    def score(self, text: str, clauses: list[tuple[str, float]] | None = None) -> float:
        worst, total, dense = self.features(text, clauses)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.bias + self.worst * worst + self.total * total + self.dense * dense))))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Coefficients, and the weighted log-likelihood there."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta)), x.T @ (w * (p - y)) + ridge * beta)
        beta -= step
        if abs(step).max() < 1e-8:
            break
    z = np.clip(x @ beta, -30, 30)
    return beta, float(w @ (y * z - np.log1p(np.exp(z))))


def fit_factors(model: ToxicityModel, totals: np.ndarray, y: np.ndarray) -> ToxicityModel:
    """The factors of marks and the threat weight that explain the labels best, one after another, twice.

    A value that is e times off its starting value costs as much as a likelihood two units lower.
    """
    prior = replace(model)
    ones = np.ones(len(y))

    def gain(m: ToxicityModel) -> float:
        x = np.stack([ones, np.log1p(totals @ m.factors())], axis=1)
        pull = sum(math.log(getattr(m, n) / getattr(prior, n)) ** 2 for n in ("near", "negated", "reported", "threat"))
        return _logistic(x, y, ones)[1] - 2 * pull

    best, height = model, gain(model)
    for name in ("near", "negated", "reported", "threat") * 2:
        for times in (0.25, 0.5, 0.71, 1.41, 2.0, 4.0):
            tried = replace(best, **{name: getattr(prior, name) * times})
            if (g := gain(tried)) > height + 1e-9:
                best, height = tried, g
    return best


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, sample: int = 3000) -> ToxicityModel:
    """Learn from at most ``sample`` labelled rows of each label; a third of them fits factors and calibrates."""
    rows = labelled_sample(docs, labels, "toxic", sample, allowed, (0, 1))
    rows = rows.repartition(8, F.col("doc_id")).persist()
    part = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3))
    model = ToxicityModel(learn_cues(rows.filter(part > 0)))
    ours = rows.filter(part == 0).select(F.col("label").cast("int").alias("label"), "text")

    def measured(measure: Callable[[str], list[float]], width: int) -> tuple[np.ndarray, np.ndarray]:
        """``width`` numbers for each calibration row, and its label."""

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = [[float(v) for v in measure(t)] for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(found, pa.list_(pa.float64()))], names=["label", "x"])

        got = ours.mapInArrow(each, "label int, x array<double>").collect()
        return np.array([r.x for r in got], dtype=np.float64).reshape(-1, width), np.array([r.label for r in got], dtype=np.float64)

    totals, y = measured(model.totals, len(EMITTED))
    if model.arcs and 0 < y.sum() < len(y):
        model = fit_factors(model, totals, y)
        found, y = measured(model.features, 3)
        w = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
        use = [0, 1, 2]
        while use:  # a match never lowers a score: what would do so is left out
            beta, _ = _logistic(np.concatenate([np.ones((len(y), 1)), found[:, use]], axis=1), y, w)
            low = int(beta[1:].argmin())
            if beta[1:][low] >= 0:
                break
            use.pop(low)
        if use:
            model.bias, model.worst, model.total, model.dense = float(beta[0]), 0.0, 0.0, 0.0
            for i, v in zip(use, beta[1:].tolist()):
                setattr(model, ("worst", "total", "dense")[i], v)
    rows.unpersist()
    return model


def score(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None) -> DataFrame:
    """(row, score, matches) of every row: ``keep`` (all columns, if None) as a struct, the score, and the matched
    clauses with their scores, worst first."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("clause", pa.string()), ("weight", pa.float64())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                scores, found = [], []
                for t in texts_of(part).to_pylist():
                    clauses = sorted(m.clauses(t), key=lambda c: -c[1])
                    scores.append(m.score(t, clauses))
                    found.append([{"clause": c, "weight": s} for c, s in clauses])
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(scores, pa.float64()), pa.array(found, kind)], names=["row", "score", "matches"])

    rows = rows_with_text(docs, keep)
    return rows.mapInArrow(each, f"{row_type(rows)}, score double, matches array<struct<clause: string, weight: double>>")

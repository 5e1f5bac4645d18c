"""Toxicity by a weighted finite-state grammar over clauses.

Each word becomes a class: insult, threat, target, negation, report or other. One small transducer each follows
target, insult, negation and reported speech; their composition is one machine whose state at an insult or threat
says by what factor it counts. A threat counts if its clause holds a target or an insult, before or after it. A
clause scores the sum of its factored weights; a document is judged by its matched clauses. Insult stems and their weights are learnt from labelled texts, the rest of the grammar is fixed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.labelled import labelled_sample, remainder
from tallyloom.llm.shared import Carried, commonest, written
from tallyloom.llm.tokens import Memo

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
#: Words of the grammar in English, German, French and Spanish.
THREATS = "kill hurt destroy murder beat shoot stab töte verletze schlage vernichte tuer tuerai frapper détruire matar mataré golpear destruir".split()
TARGETS = "you your yourself he him she her they them du dich dir ihr euch er sie tu toi te vous il elle ils tú ti usted ustedes él ella ellos".split()
NEGATIONS = "not never no isn't aren't nicht kein keine nie pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says wrote quoted reported called sagte schrieb zitierte nannte dit écrit appelé dijo escribió llamó".split()
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;\n]+")


@dataclass
class Transducer:
    """States, a move for every (state, class), the factor of a match in each state, and the factor that a threat
    gains in it if it came before (0 where it goes on waiting). It starts in state 0."""

    size: int
    moves: dict[tuple[int, int], int]
    factors: list[float]
    releases: list[float]

    def compose(self, other: Transducer) -> Transducer:
        """The machine that follows both at once; factors multiply, and either one releases a threat."""
        at = lambda a, b: a * other.size + b
        moves = {
            (at(a, b), c): at(self.moves.get((a, c), a), other.moves.get((b, c), b))
            for a, b, c in product(range(self.size), range(other.size), range(END + 1))
        }
        factors = [x * y for x in self.factors for y in other.factors]
        return Transducer(self.size * other.size, moves, factors, [max(x, y) for x in self.releases for y in other.releases])


def grammar(targeted: float = 1.25, negated: float = 0.7, reported: float = 0.7) -> Transducer:
    """Target once named holds to the end of the clause, so does reported speech; negation holds for three words."""
    target = Transducer(2, {(0, TARGET): 1, (1, END): 0}, [1.0, targeted], [0.0, targeted])
    insult = Transducer(2, {(0, INSULT): 1, (1, END): 0}, [1.0, 1.0], [0.0, 1.0])
    negation = {(s, NEGATION): 3 for s in range(4)} | {(s, END): 0 for s in range(4)}
    negation |= {(s, c): s - 1 for s in (1, 2, 3) for c in (OTHER, INSULT, THREAT, TARGET, REPORT)}
    report = Transducer(2, {(0, REPORT): 1, (1, END): 0}, [1.0, reported], [0.0, 0.0])
    return target.compose(insult).compose(Transducer(4, negation, [1.0, negated, negated, negated], [0.0] * 4)).compose(report)


@dataclass
class Model:
    stems: dict[str, float]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(5))
    centre: np.ndarray = field(default_factory=lambda: np.zeros(4))
    spread: np.ndarray = field(default_factory=lambda: np.ones(4))


class Scorer:
    """Clause scores of texts under a model."""

    def __init__(self, stems: dict[str, float], cached: int = 300_000):
        fixed = {w: (c, 0.0) for words, c in ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)) for w in words}
        self._fixed = fixed | {w: (THREAT, 1.0) for w in THREATS}
        self._stems, self._longest = stems, max(map(len, stems), default=0)
        self._machine = grammar()
        self._classes = Memo(self._class, cached)

    def _class(self, word: str) -> tuple[int, float]:
        if not word[0].isalpha():
            return END, 0.0
        if (weight := self._stems.get(word + "$")) is not None:
            return INSULT, weight
        if found := self._fixed.get(word):
            return found
        for n in range(min(len(word), self._longest), 2, -1):
            if (weight := self._stems.get(word[:n])) is not None:
                return INSULT, weight
        return OTHER, 0.0

    def clauses(self, text: str) -> tuple[int, list[float]]:
        """Number of words and the scores of the clauses that have a match."""
        classes = list(map(self._classes.__getitem__, TOKEN.findall(text.lower())))
        if not any(w for _, w in classes):
            return len(classes), []
        scores, state, total, pending = [], 0, 0.0, 0.0
        moves, factors, releases = self._machine.moves, self._machine.factors, self._machine.releases
        for kind, weight in classes:
            if kind == THREAT and not releases[state]:
                pending += weight * factors[state]
            elif weight:
                total += weight * factors[state]
            state = moves[state, kind]
            if pending and releases[state]:
                total, pending = total + pending * releases[state], 0.0
            if kind == END:
                if total:
                    scores.append(total)
                total, pending = 0.0, 0.0
        return len(classes), scores + [total] * bool(total)

    def features(self, text: str) -> list[float]:
        n, scores = self.clauses(text)
        whole = sum(scores)
        return [np.log1p(whole), max(scores, default=0.0), np.log1p(100 * whole / max(n, 20)), float(bool(scores))]


def learn_stems(sample: DataFrame, entries: int, least_documents: int = 4, least_z: float = 5.0) -> list[dict[str, float]]:
    """Stems with weights from half 0, half 1 and all of a labelled sample (text, label, half).

    A stem is a beginning of three letters or more, or a whole word (marked $), that far more toxic than other
    documents hold. Its weight is the log ratio of the shares. At most entries are kept, by significance.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], Counter] = {}
        for batch in batches:
            for text, label, half in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = {w for w in TOKEN.findall((text or "").lower()) if w[0].isalpha()}
                stems = {w[:n] for w in words for n in range(3, min(len(w), 9) + 1)} | {w + "$" for w in words if len(w) > 2}
                seen.setdefault((label, half), Counter()).update(stems)
        rows = [(s, k[0], k[1], n) for k, c in seen.items() for s, n in c.items()]
        columns = list(zip(*rows)) or [()] * 4
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["stem", "label", "half", "n"])

    size = {(r.label, r.half): r["count"] for r in sample.groupBy("label", "half").count().collect()}
    of = lambda label, half: F.sum(F.when((F.col("label") == label) & (F.col("half") == half), F.col("n")).otherwise(0))
    counts = written(
        sample.select("text", "label", "half")
        .mapInArrow(counted, "stem string, label int, half int, n long")
        .groupBy("stem")
        .agg(*(of(label, half).alias(f"n{label}{half}") for label in (0, 1) for half in (0, 1)))
        .where(F.col("n10") + F.col("n11") >= least_documents)
    )
    found = []
    for halves in ((0,), (1,), (0, 1)):
        toxic, fine = (max(1, sum(size.get((label, h), 0) for h in halves)) for label in (1, 0))
        t, f = (sum(F.col(f"n{label}{h}") for h in halves) for label in (1, 0))
        p, q = (t + 0.5) / (toxic + 1), (f + 0.5) / (fine + 1)
        pooled = (t + f + 1) / (toxic + fine + 2)
        z = (p - q) / F.sqrt(pooled * (1 - pooled) * (1 / toxic + 1 / fine))
        rows = counts.select("stem", F.log(p / q).alias("weight"), z.alias("z"), t.alias("t"))
        rows = rows.where((F.col("t") >= least_documents) & (F.col("weight") >= 1) & (F.col("z") >= least_z))
        found.append({r.stem: r.weight for r in commonest(rows, "z", entries).select("stem", "weight").collect()})
    return found


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str, learn, sample_rows: int = 12_000, entries: int = 3_000) -> Model:
    """A model from at most about sample_rows labelled texts. Each half is scored with the other half's stems, and
    a logistic regression of those clause features gives the probability."""
    sample = labelled_sample(docs, labels, label, learn, sample_rows).withColumn("half", (F.crc32(F.col("doc_id").cast("string").cast("binary")) / 7 % 2).cast("int"))
    half0, half1, whole = learn_stems(sample, entries)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [Scorer(half1), Scorer(half0)]
        for batch in batches:
            text, half = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rows = [scorers[h].features(x or "") for x, h in zip(text, half)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "label"])

    rows = sample.select("text", "label", "half").mapInArrow(measured, "x array<double>, label int").collect()
    model = Model(whole)
    if not rows:
        return model
    x, y = np.array([r.x for r in rows]), np.array([r.label for r in rows], dtype=float)
    model.centre, model.spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.column_stack([np.ones(len(x)), (x - model.centre) / model.spread])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1])
        model.weights = model.weights + np.linalg.solve(hessian, x.T @ (y - p) - model.weights)
    return model


def score_toxicity(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every text. Null counts as empty; rows are scored one by one; other columns are not carried."""
    shared = Carried(docs.sparkSession, model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scorer = Scorer(m.stems)
        for batch in batches:
            x = np.array([scorer.features(v.as_py() or "") for v in batch.column(1)]).reshape(-1, 4)
            total = m.weights[0] + ((x - m.centre) / m.spread * m.weights[1:]).sum(axis=1)
            scores = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(scored, "doc_id long, score double")


def op6_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns: learnt where crc32 of doc_id modulo 5 is not 0."""
    model = fit_toxicity(docs, labels, "toxic", remainder("doc_id", 5) != 0)
    return score_toxicity(docs, model).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )

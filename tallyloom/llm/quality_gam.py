"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees, boosted in turn over the features, add up to one lookup table per feature; then trees over the
strongest pairs add up to one table per pair. A score is the sum of a few table cells per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.labelled import labelled_sample, remainder
from tallyloom.llm.shared import Carried

FEATURES = (
    "log_words", "mean_word", "symbol_share", "bar_share", "bang_share", "capital_share", "digit_share", "distinct_share",
    "echo_share", "stop_share", "comma_share", "lines_per_word", "repeated_lines", "other_share",
)
_SYMBOLS, _CAPITALS, _DIGITS = b"#*$%&<>@^~=+\\", bytes(range(65, 91)), bytes(range(48, 58))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])


def features(text: str) -> list[float]:
    """The features of one whole text; an empty text has zeros."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    data, n, lines = text.encode(), len(words), text.split("\n")
    size = len(data)
    without = lambda dropped: size - len(data.translate(None, dropped))
    letters = without(_LETTERS)
    return [
        np.log1p(n),
        size / n,
        without(_SYMBOLS) / size,
        data.count(b"|") / n,
        data.count(b"!") / n,
        without(_CAPITALS) / max(1, letters),
        without(_DIGITS) / size,
        len(set(words)) / n**0.9,
        sum(map(eq, words, words[1:])) / n,
        data.count(b".") / n,
        data.count(b",") / n,
        len(lines) / n,
        1 - len(set(lines)) / len(lines),
        1 - (letters + without(b" \n.,")) / size,
    ]


def feature_matrix(values: list) -> np.ndarray:
    return np.array([features(x or "") for x in values], dtype=float).reshape(len(values), len(FEATURES))


@dataclass
class Model:
    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]
    coarse: int

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: bin additions only."""
        b = self.bins(x)
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[b[:, j]]
        for i, j, table in self.pairs:
            total += table[b[:, i] * self.coarse // len(self.tables[i]), b[:, j] * self.coarse // len(self.tables[j])]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 5.0)


def _shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Value per bin of the best tree with two splits along the bins."""
    def split(a: int, b: int) -> tuple[float, int]:
        gc, hc = np.cumsum(g[a:b]), np.cumsum(h[a:b])
        gain = gc[:-1] ** 2 / (hc[:-1] + 5) + (gc[-1] - gc[:-1]) ** 2 / (hc[-1] - hc[:-1] + 5) - gc[-1] ** 2 / (hc[-1] + 5)
        best = int(gain.argmax()) if len(gain) else -1
        return (float(gain[best]), a + best + 1) if best >= 0 else (-1.0, a)

    cuts = [0, len(g)]
    for _ in range(2):
        gain, at = max(split(a, b) for a, b in zip(cuts, cuts[1:]))
        if gain <= 0:
            break
        cuts = sorted({*cuts, at})
    out = np.empty(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best tree that splits both features once."""
    best, out, k = -1.0, np.zeros_like(g), len(g)
    for r in range(1, k):
        for c in range(1, k):
            parts = [(slice(0, r), slice(0, c)), (slice(0, r), slice(c, k)), (slice(r, k), slice(0, c)), (slice(r, k), slice(c, k))]
            sums = [(g[p].sum(), h[p].sum()) for p in parts]
            gain = sum(a * a / (b + 5) for a, b in sums)
            if gain > best:
                best = gain
                for p, (a, b) in zip(parts, sums):
                    out[p] = _leaf(a, b)
    return best, out.copy()


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 250, rate: float = 0.1, bins: int = 32, coarse: int = 8, most_pairs: int = 5) -> Model:
    """Main effects first, then the pairs with the highest gain on what is left."""
    if not len(y):
        return Model([np.zeros(0)] * len(FEATURES), 0.0, [np.zeros(1)] * len(FEATURES), [], coarse)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Model(edges, float(np.log(share / (1 - share))), [np.zeros(len(e) + 1) for e in edges], [], coarse)
    b, total = model.bins(x), np.full(len(y), model.intercept)
    prob = lambda: 1 / (1 + np.exp(-total))
    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            p = prob()
            step = rate * _shallow_tree(np.bincount(b[:, j], y - p, len(table)), np.bincount(b[:, j], p * (1 - p), len(table)))
            table += step
            total += step[b[:, j]]
    low = [b[:, j] * coarse // len(model.tables[j]) for j in range(x.shape[1])]

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        cell, p = low[i] * coarse + low[j], prob()
        return (np.bincount(cell, w, coarse * coarse).reshape(coarse, coarse) for w in (y - p, p * (1 - p)))

    ranked = sorted(((_quadrants(*sums(i, j))[0], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)
    model.pairs = [(i, j, np.zeros((coarse, coarse))) for _, i, j in ranked[:most_pairs]]
    for _ in range(20):
        for i, j, table in model.pairs:
            step = rate * _quadrants(*sums(i, j))[1]
            table += step
            total += step[low[i], low[j]]
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, label: str, learn, sample_rows: int = 8_000) -> Model:
    """A model from at most about sample_rows labelled texts, whose features are brought to the driver."""
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array(feature_matrix(batch.column(0).to_pylist()).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([rows, batch.column(1)], names=["x", "label"])

    rows = labelled_sample(docs, labels, label, learn, sample_rows).select("text", "label").mapInArrow(measured, "x array<double>, label int").collect()
    return fit(np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES)), np.array([r.label for r in rows], dtype=float))


def score_quality(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every text. Null counts as empty; rows are scored one by one; other columns are not carried."""
    shared = Carried(docs.sparkSession, model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(feature_matrix(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(scored, "doc_id long, score double")


def op8_quality_gam(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns: learnt where crc32 of doc_id modulo 4 is not 2."""
    model = fit_quality(docs, labels, "quality", remainder("doc_id", 4) != 2)
    return score_quality(docs, model).select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )

"""Quality classifier: an additive model of lookup tables with pairwise interactions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.rows import add_columns, texts_of

FEATURES = (
    "log_words",
    "word_length",
    "upper_share",
    "symbol_share",
    "bar_share",
    "digit_share",
    "stop_share",
    "distinct_share",
    "echo_share",
    "line_words",
    "repeated_lines",
)

# The labelled rows the model is fitted on, at most; scoring has no bound.
TRAINING_ROWS = 20_000

_UPPER = slice(ord("A"), ord("Z") + 1)
_DIGIT = slice(ord("0"), ord("9") + 1)
_SYMBOLS = np.frombuffer(b"!#$%&*@^~<>{}[]\\=+_/", np.uint8)
_STOPS = np.frombuffer(b".,;:?", np.uint8)


def features(text: str) -> list[float]:
    """Measures of the whole text; an empty one has zeros."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    letters = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, n = len(raw), len(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return [
        float(np.log1p(n)),
        (size - int(letters[[9, 10, 13, 32]].sum())) / n,
        int(letters[_UPPER].sum()) / size,
        int(letters[_SYMBOLS].sum()) / size,
        int(letters[ord("|")]) / size,
        int(letters[_DIGIT].sum()) / size,
        int(letters[_STOPS].sum()) / n,
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        n / len(lines),
        1 - len(set(lines)) / len(lines),
    ]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _leaf(gradient: np.ndarray, weight: np.ndarray, shrink: float) -> np.ndarray:
    return gradient / (weight + shrink)


def _best_cut(gradient: np.ndarray, weight: np.ndarray, shrink: float) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram in two; no gain if it has one bin."""
    if len(gradient) < 2:
        return 0.0, 0
    left_g, left_w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    g, w = gradient.sum(), weight.sum()
    gain = left_g**2 / (left_w + shrink) + (g - left_g) ** 2 / (w - left_w + shrink) - g**2 / (w + shrink)
    cut = int(np.argmax(gain))
    return float(gain[cut]), cut + 1


def shallow_tree(gradient: np.ndarray, weight: np.ndarray, leaves: int, shrink: float) -> np.ndarray:
    """Value per bin of a tree of a few leaves, grown by the best cut first."""
    parts = [(0, len(gradient))]
    while len(parts) < leaves:
        cuts = [(*_best_cut(gradient[a:b], weight[a:b], shrink), k) for k, (a, b) in enumerate(parts)]
        gain, cut, k = max(cuts)
        if gain <= 1e-12:
            break
        a, b = parts.pop(k)
        parts += [(a, a + cut), (a + cut, b)]
    out = np.zeros(len(gradient))
    for a, b in parts:
        out[a:b] = _leaf(gradient[a:b].sum(), weight[a:b].sum(), shrink)
    return out


def shallow_tree_of_two(gradient: np.ndarray, weight: np.ndarray, shrink: float) -> tuple[np.ndarray, float]:
    """Value per cell of a tree that cuts one feature, then the other on each side; and its gain."""
    best, best_gain = np.zeros_like(gradient), 0.0
    base = gradient.sum() ** 2 / (weight.sum() + shrink)
    for turned in (False, True):
        g, w = (gradient.T, weight.T) if turned else (gradient, weight)
        for cut in range(1, len(g)):
            out, gain = np.zeros_like(g), -base
            for rows in (slice(0, cut), slice(cut, None)):
                side_g, side_w = g[rows].sum(0), w[rows].sum(0)
                _, at = _best_cut(side_g, side_w, shrink)
                for part in (slice(0, at), slice(at, None)):
                    value = _leaf(side_g[part].sum(), side_w[part].sum(), shrink)
                    out[rows, part] = value
                    gain += value * side_g[part].sum()
            if gain > best_gain:
                best, best_gain = (out.T if turned else out), gain
    return best, best_gain


@dataclass
class AdditiveModel:
    """logit = base + a table value per feature + a table value per pair of features."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            out += table[np.searchsorted(edges, rows[:, j], "right")]
        coarse = {j: np.searchsorted(self.pair_edges[j], rows[:, j], "right") for pair in self.pairs for j in pair}
        for (a, b), table in zip(self.pairs, self.pair_tables):
            out += table[coarse[a], coarse[b]]
        return out

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(rows))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) if len(column) else np.zeros(0)


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    bins: int = 32,
    pair_bins: int = 8,
    rounds: int = 150,
    pair_rounds: int = 30,
    most_pairs: int = 6,
    leaves: int = 3,
    rate: float = 0.15,
    shrink: float = 1.0,
) -> AdditiveModel:
    """Cyclic boosting: every round adds a small step of one shallow tree to each table in turn.

    Pairs come after the single features: those whose tree of two explains most of what
    is left are boosted the same way. Without rows, or with one class, the model is the
    smoothed share of label 1.
    """
    labels = labels.astype(float)
    share = (labels.sum() + 1) / (len(labels) + 2)
    base = float(np.log(share / (1 - share)))
    edges = [_edges(rows[:, j], bins) for j in range(rows.shape[1])]
    pair_edges = [_edges(rows[:, j], pair_bins) for j in range(rows.shape[1])]
    model = AdditiveModel(base, edges, [np.zeros(len(e) + 1) for e in edges], [], pair_edges, [])
    if len(labels) == 0 or labels.min() == labels.max():
        return model
    cells = [np.searchsorted(e, rows[:, j], "right") for j, e in enumerate(edges)]
    logit = np.full(len(labels), base)
    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            p = _sigmoid(logit)
            g = np.bincount(cells[j], labels - p, len(table))
            w = np.bincount(cells[j], p * (1 - p), len(table))
            step = rate * shallow_tree(g, w, leaves, shrink)
            table += step
            logit += step[cells[j]]

    coarse = [np.searchsorted(e, rows[:, j], "right") for j, e in enumerate(pair_edges)]

    def histograms(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        p, shape = _sigmoid(logit), (len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)
        at, size = coarse[a] * shape[1] + coarse[b], shape[0] * shape[1]
        return np.bincount(at, labels - p, size).reshape(shape), np.bincount(at, p * (1 - p), size).reshape(shape)

    gains = [(shallow_tree_of_two(*histograms(a, b), shrink)[1], a, b) for a, b in combinations(range(rows.shape[1]), 2)]
    for gain, a, b in sorted(gains, reverse=True)[:most_pairs]:
        if gain > 0:
            model.pairs.append((a, b))
            model.pair_tables.append(np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)))
    for _ in range(pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            step = rate * shallow_tree_of_two(*histograms(a, b), shrink)[0]
            table += step
            logit += step[coarse[a], coarse[b]]
    return model


def with_features(df: DataFrame, text: str = "text", drop: Sequence[str] = ()) -> DataFrame:
    """df with the measures of each whole text; all are 0 for null and empty ones. Rows that repeat measure alike."""
    def make():
        return lambda batch: [pa.array([features(t) for t in texts_of(batch, text)], pa.list_(pa.float64()))]

    return add_columns(df, make, "features array<double>", drop)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    most_rows: int = TRAINING_ROWS,
) -> AdditiveModel:
    """A model of the labelled documents.

    It takes the most_rows labels that come first by a hash of the id, so the sample is
    the same in every run; only their ids (bounded by most_rows) are broadcast and only
    their features are collected. Null ids, labels and labels without a document are passed over.
    An id counts once: with its larger label, and the document whose text has the least digest.
    """
    known = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.filter("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(most_rows)
    texts = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("version"))
    measured = with_features(texts.join(F.broadcast(sample), "id"), "text", ["text"])
    one = F.min_by(F.struct("features", "label"), F.col("version")).alias("row")
    rows = measured.groupBy("id").agg(one).select("id", "row.*").toPandas()
    rows = rows.sort_values("id", kind="stable")
    measured = np.array(rows["features"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(measured, rows["label"].to_numpy(int))


def with_quality(df: DataFrame, model: AdditiveModel, text: str = "text") -> DataFrame:
    """df with score, the probability that a document is good, and predicted (1 from 0.5).

    Only the whole text is looked at. Null and empty texts have all measures 0 and the
    score the tables give for that. Other columns pass through; columns named like a
    result give way to it. Rows of equal text have equal scores.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        fitted = sent.value

        def step(batch):
            rows = np.array([features(t) for t in texts_of(batch, text)], float).reshape(-1, len(FEATURES))
            scores = fitted.scores(rows)
            return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]

        return step

    return add_columns(df, make, "score double, predicted int")

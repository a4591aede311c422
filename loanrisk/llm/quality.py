"""Quality classifier: a generalised additive model with pairwise interactions.

A text becomes a row of statistics (sizes, shares of kinds of bytes, repetition of words and lines). The
model is a sum of lookup tables: one per statistic, cut into bins, and one per chosen pair of
statistics. Tables are learnt by cyclic boosting: round after round, a shallow tree per statistic is
fitted to the present residuals and added to its table at a small rate; pairs with the strongest
remaining interaction get tables of their own the same way. Scoring adds up table entries for whole
batches of rows.

Statistics are computed once for every whole text and stored. Weights and bins are fitted on a
documented bound of labelled rows (``training_rows``, the smallest id hashes); nothing else is
bounded.

Defined results: a null text counts as empty, and empty texts get a score as any other; without usable
labels every score is 0.5; an id with contradicting labels is not learnt from; repeated rows score
alike; an empty table gives an empty table. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanrisk.llm.common import arrow_pass, checkpointed, map_texts

STATISTICS = (
    "log_bytes", "log_words", "word_length", "upper", "digits", "wide", "space", "line_breaks", "stops",
    "loud_marks", "symbols", "bars", "brackets", "distinct_words", "commonest_word", "repeated_next",
    "distinct_pairs", "distinct_lines", "words_per_line", "commonest_ending", "byte_entropy",
)
TRAINING_ROWS = 20_000


def _class(characters: bytes) -> np.ndarray:
    return np.isin(np.arange(256), np.frombuffer(characters, dtype=np.uint8))


KINDS = np.array([
    _class(bytes(range(ord("A"), ord("Z") + 1))),
    _class(b"0123456789"),
    np.arange(256) >= 128,
    _class(b" \t\r\v\f"),
    _class(b"\n"),
    _class(b".,;:"),
    _class(b"!?"),
    _class(b"#$%&*@^~=+<>\\/_`"),
    _class(b"|"),
    _class(b"()[]{}\"'-"),
], dtype=float).T


def statistics(text: bytes) -> list[float]:
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    size = max(len(text), 1)
    shares = counts[counts > 0] / size
    words = text.split()
    n = max(len(words), 1)
    lines = [line for line in text.split(b"\n") if line]
    held: dict[bytes, int] = {}
    for word in words:
        held[word] = held.get(word, 0) + 1
    endings: dict[bytes, int] = {}
    for word in words:
        ending = word[-2:]
        endings[ending] = endings.get(ending, 0) + 1
    following = words[1:]
    pairs = max(len(following), 1)
    return [
        np.log1p(len(text)), np.log1p(len(words)), sum(map(len, words)) / n,
        *(counts @ KINDS / size),
        len(held) / n, max(held.values(), default=0) / n,
        sum(map(bytes.__eq__, words, following)) / pairs, len(set(zip(words, following))) / pairs,
        len(set(lines)) / max(len(lines), 1), n / max(len(lines), 1),
        max(endings.values(), default=0) / n,
        float(-(shares * np.log2(shares)).sum()),
    ]


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the array of statistics of each whole text."""

    def describe(_: pa.RecordBatch, texts: list[bytes]) -> list[pa.Array]:
        values = np.array([statistics(text) for text in texts])
        return [pa.ListArray.from_arrays(
            pa.array(np.arange(0, values.size + 1, len(STATISTICS), dtype=np.int32)), pa.array(values.ravel())
        )]

    return map_texts(
        docs, [docs["doc_id"]], docs["text"], describe,
        [T.StructField("statistics", T.ArrayType(T.DoubleType()))],
    )


@dataclass
class AdditiveModel:
    """Bins of each statistic, a table for each, and tables for pairs; scores are log odds."""

    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, values: np.ndarray) -> np.ndarray:
        return np.stack([
            np.searchsorted(edges, values[:, k], side="right") for k, edges in enumerate(self.edges)
        ], axis=1) if self.edges else np.zeros((len(values), 0), dtype=np.int64)

    def log_odds(self, values: np.ndarray) -> np.ndarray:
        bins = self.bins(values)
        total = np.full(len(values), self.intercept)
        for k, table in enumerate(self.tables):
            total += table[bins[:, k]]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[bins[:, a], bins[:, b]]
        return total

    def scores(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(values), -30, 30)))


def _gain(gradient: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    return gradient * gradient / (weight + ridge)


def _best_cut(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, int]:
    """Gain of the best cut of a run of bins in two, and where it is."""
    if len(gradient) < 2:
        return 0.0, 0
    g, w = np.cumsum(gradient), np.cumsum(weight)
    gain = _gain(g[:-1], w[:-1]) + _gain(g[-1] - g[:-1], w[-1] - w[:-1]) - _gain(g[-1], w[-1])
    best = int(np.argmax(gain))
    return float(gain[best]), best + 1


def shallow_tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = 4) -> np.ndarray:
    """A step function over bins with the given number of leaves, grown at the best cut first."""
    runs = [(0, len(gradient), *_best_cut(gradient, weight))]
    while len(runs) < leaves:
        k = max(range(len(runs)), key=lambda i: runs[i][2])
        low, high, gain, cut = runs[k]
        if gain <= 1e-12:
            break
        middle = low + cut
        runs[k] = (low, middle, *_best_cut(gradient[low:middle], weight[low:middle]))
        runs.append((middle, high, *_best_cut(gradient[middle:high], weight[middle:high])))
    values = np.zeros(len(gradient))
    for low, high, _, _ in runs:
        values[low:high] = gradient[low:high].sum() / (weight[low:high].sum() + 1.0)
    return values


def pair_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree of depth two over a grid: a cut of one side, then one of the other on each part."""
    best_gain, best = 0.0, np.zeros_like(gradient)
    whole = _gain(gradient.sum(), weight.sum())
    for axis in (0, 1):
        g, w = (gradient, weight) if axis == 0 else (gradient.T, weight.T)
        above_g, above_w = np.cumsum(g, axis=0)[:-1], np.cumsum(w, axis=0)[:-1]
        gain, cuts = np.zeros(len(above_g)), []
        for part_g, part_w in ((above_g, above_w), (g.sum(axis=0) - above_g, w.sum(axis=0) - above_w)):
            left_g, left_w = np.cumsum(part_g, axis=1), np.cumsum(part_w, axis=1)
            of_cut = _gain(left_g, left_w) + _gain(left_g[:, -1:] - left_g, left_w[:, -1:] - left_w)
            cut = of_cut.argmax(axis=1)
            cuts.append(cut)
            gain += of_cut[np.arange(len(cut)), cut]
        if not len(gain) or gain.max() - whole <= best_gain:
            continue
        row = int(gain.argmax())
        best_gain = float(gain[row] - whole)
        values = np.zeros_like(g)
        for rows, cut in ((slice(0, row + 1), cuts[0][row]), (slice(row + 1, None), cuts[1][row])):
            for columns in (slice(0, cut + 1), slice(cut + 1, None)):
                values[rows, columns] = g[rows, columns].sum() / (w[rows, columns].sum() + 1.0)
        best = values if axis == 0 else values.T
    return best_gain, best


def train(
    values: np.ndarray, labels: np.ndarray, bins: int = 32, rounds: int = 150, rate: float = 0.1,
    pairs: int = 6, pair_rounds: int = 60,
) -> AdditiveModel:
    """Cyclic boosting of one table per statistic, then of tables for the strongest pairs."""
    if not len(labels):
        return AdditiveModel([], 0.0, [])
    prior = (labels.sum() + 0.5) / (len(labels) + 1)
    edges = [np.unique(np.quantile(column, np.arange(1, bins) / bins)) for column in values.T]
    model = AdditiveModel(edges, float(np.log(prior / (1 - prior))), [np.zeros(len(e) + 1) for e in edges])
    if len(set(labels.tolist())) < 2:
        return model
    binned = model.bins(values)
    odds = model.log_odds(values)

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-odds))
        return labels - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for k, table in enumerate(model.tables):
            gradient, weight = residuals()
            step = rate * shallow_tree(
                np.bincount(binned[:, k], gradient, len(table)), np.bincount(binned[:, k], weight, len(table))
            )
            table += step
            odds += step[binned[:, k]]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = len(model.tables[a]), len(model.tables[b])
        cell = binned[:, a] * shape[1] + binned[:, b]
        gradient, weight = residuals()
        size = shape[0] * shape[1]
        return (
            np.bincount(cell, gradient, size).reshape(shape), np.bincount(cell, weight, size).reshape(shape), cell
        )

    candidates = [(a, b) for a in range(len(edges)) for b in range(a) if len(edges[a]) and len(edges[b])]
    strength = {pair: pair_tree(*grid(*pair)[:2])[0] for pair in candidates}
    model.pairs = sorted(candidates, key=lambda pair: (-strength[pair], pair))[:pairs]
    model.pair_tables = [np.zeros((len(edges[a]) + 1, len(edges[b]) + 1)) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            gradient, weight, cell = grid(a, b)
            step = rate * pair_tree(gradient, weight)[1]
            table += step
            odds += step.ravel()[cell]
    return model


def fit(described: DataFrame, labels: DataFrame, training: Column, training_rows: int = TRAINING_ROWS) -> AdditiveModel:
    """Learn from at most training_rows labelled rows where ``training`` (on doc_id) holds.

    described: doc_id and statistics. labels: doc_id and quality, 0 or 1.
    """
    agreed = (
        labels.filter(training & F.col("quality").isin(0, 1)).groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .filter("low = high").select("doc_id", F.col("low").alias("label"))
    )
    rows = (
        described.filter(training).join(agreed, "doc_id")
        .orderBy(F.xxhash64(F.lit("training"), "doc_id"), "doc_id", "statistics").limit(training_rows)
        .select("statistics", "label").toArrow()
    )
    values = np.array(rows.column("statistics").to_pylist(), dtype=float).reshape(-1, len(STATISTICS))
    return train(values, np.array(rows.column("label").to_pylist(), dtype=float))


def score(described: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id and score of rows of statistics."""
    shared = described.sparkSession.sparkContext.broadcast(model)  # a few thousand table entries

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield [batch.column(0), pa.array(shared.value.scores(values))]

    schema = T.StructType([described.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return arrow_pass(described.select("doc_id", "statistics"), add_up, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, training: Column, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """doc_id and score (0 to 1, higher: good quality likelier) of every document."""
    described = checkpointed(text_statistics(docs))
    return score(described, fit(described, labels, training, training_rows))

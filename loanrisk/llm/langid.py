"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the hashed 1- to 3-grams of a text's lower-case letters, all else counting as one space.
The term frequency is the share of a gram in the text, the inverse document frequency comes from all
training rows. Weights are learnt by follow-the-regularised-leader with elastic net, so most stay at
zero; a temperature fitted on training rows that the weights have not seen calibrates the
probabilities.

Document frequencies cover every training row. The weights are fitted on a bounded sample of them:
at most ``rows_per_language`` rows of each language, those of the smallest id hash. Only hashed
features of these reach the driver (bounded by rows, languages and DIMENSIONS). Scoring is a sum of
table rows over a text's grams.

Defined results: a null text, one without a letter, or any text if there was nothing to learn from, is
``und`` with score 0; rows with a null id or language are not learnt from; an id's repeated rows are
scored alike; whole texts count, however long; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanrisk.llm.common import arrow_pass, map_texts, positional

DIMENSIONS, ORDERS = 1 << 16, (1, 2, 3)
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")
FREQUENCY = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("held", T.LongType())])
#: Characters handled at a time.
SLICE_CHARS = 1 << 19


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    table = np.zeros(0x110000, dtype=bool)
    for code in range(0x110000):
        table[code] = not 0xD800 <= code < 0xE000 and chr(code).isalpha()
    return table


def _runs(texts: list[str]) -> Iterator[list[str]]:
    held: list[str] = []
    size = 0
    for text in texts:
        if held and size + len(text) > SLICE_CHARS:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashed grams by order, as positions in one concatenated text, and where each text starts.

    A gram that runs past its text is DIMENSIONS, a bucket of its own without weight.
    """
    lowered = [f" {text.lower()} " for text in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = np.where(_letters()[codes], codes, 32).astype(np.uint32)
    ends = np.cumsum([len(text) for text in lowered])
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    keep[starts] = True
    kept_before = np.concatenate(([0], np.cumsum(keep)))
    starts, ends, codes = kept_before[starts], kept_before[ends], codes[keep]
    out = []
    mixed = np.zeros(len(codes), dtype=np.uint32)
    for order in range(1, max(ORDERS) + 1):
        shift = order - 1
        mixed = mixed[: len(codes) - shift] * np.uint32(0x01000193) ^ codes[shift:]
        mixed *= np.uint32(0x9E3779B1)
        if order in ORDERS:
            bucket = np.full(len(codes), DIMENSIONS, dtype=np.int32)
            bucket[: len(mixed)] = (mixed ^ np.uint32(order * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(16)
            for back in range(1, order):
                past = ends - back
                bucket[past[past >= starts]] = DIMENSIONS
            out.append(bucket)
    return out, starts


def document_frequencies(texts: list[str], seen: np.ndarray, counts: np.ndarray) -> None:
    """Add the texts' distinct buckets to counts; seen is scratch space of the same length."""
    for run in _runs(texts):
        by_order, starts = grams(run)
        bounds = [*starts.tolist(), len(by_order[0])]
        for begin, end in zip(bounds, bounds[1:]):
            for buckets in by_order:
                seen[buckets[begin:end]] = 1
            counts += seen
            seen[:] = 0


def sparse_shares(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the share of each."""
    by_order, _ = grams([text])
    buckets = np.concatenate(by_order)
    buckets, counts = np.unique(buckets[buckets < DIMENSIONS], return_counts=True)
    return buckets.astype(np.int32), (counts / max(counts.sum(), 1)).astype(np.float32)


def ftrl(
    examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int,
    alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5, passes: int = 3, seed: int = 7,
) -> np.ndarray:
    """Weights (DIMENSIONS x classes) by follow-the-regularised-leader-proximal, example by example."""
    z = np.zeros((DIMENSIONS, classes))
    n = np.zeros((DIMENSIONS, classes))

    def weights(of_z: np.ndarray, of_n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(of_z) * np.maximum(np.abs(of_z) - l1, 0)
        return -shrunk / ((beta + np.sqrt(of_n)) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(passes):
        for k in order.permutation(len(examples)):
            buckets, values = examples[k]
            z_k, n_k = z[buckets], n[buckets]
            w = weights(z_k, n_k)
            gradient = softmax((values @ w)[None, :])[0]
            gradient[labels[k]] -= 1
            g = values[:, None] * gradient
            squares = g * g
            z[buckets] = z_k + g - (np.sqrt(n_k + squares) - np.sqrt(n_k)) / alpha * w
            n[buckets] = n_k + squares
    return weights(z, n)


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss; searched on a grid, then refined."""
    if not len(logits):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))
        return -np.mean(np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)))

    low, high = -4.0, 4.0
    for _ in range(4):
        grid = np.linspace(low, high, 17)
        best = int(np.argmin([loss(x) for x in grid]))
        low, high = grid[max(best - 1, 0)], grid[min(best + 1, 16)]
    return float(np.exp((low + high) / 2))


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # (DIMENSIONS + 1) x languages: idf times weight, nothing for the last bucket
    temperature: float

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probabilities (texts x languages)."""
        out = [np.zeros((0, len(self.languages)))]
        for run in _runs(texts):
            by_order, starts = grams(run)
            total = np.zeros((len(run), len(self.languages)))
            known = np.zeros(len(run))
            for buckets in by_order:
                known += np.add.reduceat((buckets < DIMENSIONS).astype(np.int32), starts)
                for k in range(len(self.languages)):
                    total[:, k] += np.add.reduceat(self.table[:, k][buckets], starts, dtype=np.float64)
            out.append(softmax(total / np.maximum(known, 1)[:, None] / self.temperature))
        return np.concatenate(out)


def fit(
    docs: DataFrame, training: Column, calibration: Column, rows_per_language: int = 1000, scale: float = 100.0
) -> LanguageModel:
    """Learn from the text and lang of the rows where ``training`` holds; of these, the rows where
    ``calibration`` holds set the temperature instead of the weights. Both look at doc_id only."""
    learnable = docs.filter(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    learnable = learnable.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    rows = learnable.groupBy("lang").count().orderBy("lang").collect()  # one per language
    languages = [row["lang"] for row in rows]
    if not languages:
        return LanguageModel([], np.zeros((DIMENSIONS + 1, 0), dtype=np.float32), 1.0)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        seen, counts, rows = np.zeros(DIMENSIONS + 1, np.int64), np.zeros(DIMENSIONS + 1, np.int64), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                texts = batch.column(0).slice(start, 512).to_pylist()
                document_frequencies(texts, seen, counts)
                rows += len(texts)
        counts[DIMENSIONS] = rows
        used = np.flatnonzero(counts)
        yield [pa.array(used), pa.array(counts[used])]

    held = (
        arrow_pass(learnable.select("text"), frequencies, FREQUENCY)
        .groupBy("bucket").agg(F.sum("held").alias("held")).toArrow()  # DIMENSIONS + 1 rows at most
    )
    counts = np.zeros(DIMENSIONS + 1)
    counts[held.column("bucket").to_numpy()] = held.column("held").to_numpy()
    idf = np.log((1 + counts[DIMENSIONS]) / (1 + counts[:DIMENSIONS])) + 1

    chosen = _sample(learnable, rows, calibration, rows_per_language)
    index = {language: k for k, language in enumerate(languages)}
    parts = {False: ([], []), True: ([], [])}
    for row in chosen:
        examples, labels = parts[row["calibration"]]
        buckets = np.frombuffer(row["buckets"], dtype="<i4")
        examples.append((buckets, np.frombuffer(row["shares"], dtype="<f4") * idf[buckets] * scale))
        labels.append(index[row["lang"]])
    weights = ftrl(parts[False][0], np.array(parts[False][1], dtype=np.int64), len(languages))
    unseen, labels = parts[True]
    logits = np.array([values @ weights[buckets] for buckets, values in unseen]).reshape(-1, len(languages))
    table = np.zeros((DIMENSIONS + 1, len(languages)), dtype=np.float32)
    table[:DIMENSIONS] = weights * idf[:, None] * scale
    return LanguageModel(languages, table, temperature(logits, np.array(labels, dtype=np.int64)))


def _sample(learnable: DataFrame, counts: list, calibration: Column, rows_per_language: int) -> list:
    """Features of at most rows_per_language rows of each language, in the order of their id's hash."""
    pairs = (F.lit(value) for row in counts for value in (row["lang"], float(row["count"])))
    share = F.lit(2.0 * rows_per_language * (1 << 30)) / F.element_at(F.create_map(*pairs), F.col("lang"))
    hashed = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)).alias("order")
    likely = (  # about twice as many, so that most texts need not be looked at
        learnable.select("*", hashed, calibration.alias("calibration"))
        .filter(F.col("order") <= share)
    )

    def featurise(_: pa.RecordBatch, texts: list[bytes]) -> list[pa.Array]:
        found = [sparse_shares(text.decode("utf-8", "replace")) for text in texts]
        return [pa.array([a.astype("<i4").tobytes() for a, _ in found], pa.binary()),
                pa.array([b.astype("<f4").tobytes() for _, b in found], pa.binary())]

    features = map_texts(
        likely, ["doc_id", "lang", "order", F.coalesce("calibration", F.lit(False)).alias("calibration")],
        likely["text"], featurise,
        [T.StructField("buckets", T.BinaryType()), T.StructField("shares", T.BinaryType())],
    )
    first = Window.partitionBy("lang").orderBy("order", "doc_id", "buckets", "shares")
    return (
        features.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= rows_per_language)
        .orderBy("lang", "place").collect()
    )


def predict(docs: DataFrame, model: LanguageModel, keep: list[Column] | None = None) -> DataFrame:
    """The kept columns (doc_id), lang_pred and score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS x languages, fixed

    def scored(_: pa.RecordBatch, texts: list[bytes]) -> list[pa.Array]:
        model = shared.value
        decoded = [text.decode("utf-8", "replace") for text in texts]
        readable = [k for k, text in enumerate(decoded) if model.languages and LETTER.search(text)]
        language, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        p = model.scores([decoded[k] for k in readable])
        for k, row in zip(readable, p):
            best = int(row.argmax())
            language[k], score[k] = model.languages[best], min(row[best], 1.0)
        return [pa.array(language, pa.string()), pa.array(score, pa.float64())]

    return map_texts(
        docs, keep or [docs["doc_id"]], docs["text"], scored,
        [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())],
    )


def drop_unidentified(docs: DataFrame, model: LanguageModel, least_score: float = 0.5) -> DataFrame:
    """The rows whose language is determined with a probability of least_score, with all columns."""
    plain, names = positional(docs)
    scored = predict(
        plain.withColumn("text", F.col(names["text"])), model, [F.col(name) for name in plain.columns]
    )
    passed = scored.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score))
    return passed.select(*plain.columns).toDF(*docs.columns)

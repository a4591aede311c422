"""Log probabilities of a unigram vocabulary, learnt from all pre-tokens of a table.

The pre-tokens of whole texts are counted in the Arrow passes and summed by a groupBy. Expectation
maximisation then runs over the distinct ones: a round weighs every segmentation of a pre-token by
its probability (forward and backward sums over the lattice of pieces, many pre-tokens side by side)
and adds up how often each piece is expected. The sums are aggregations; one number a piece, of a
vocabulary's bounded size, reaches the driver and is broadcast to the next round.

The first probabilities are proportional to a piece's occurrences times its length. Expected counts
are added up as whole multiples of 2**-20, so that results do not depend on the order of rows. Pieces
that occur nowhere get no score. A letter without a piece is passed at a score below every piece.
Pre-tokens of any length are weighed whole; those over LONG_WORD letters one by one, with the same sums.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanrisk.llm.common import arrow_pass, checkpointed, slices

WORD_MARK = "▁"
UNKNOWN_PENALTY = 10.0
ROUNDS, LONG_WORD = 2, 256
#: Distinct pre-tokens that a task counts before it hands them on, and letters weighed side by side.
HELD_WORDS, LETTERS_AT_ONCE = 200_000, 300_000
UNIT = 1 << 20
LEAST_EXPECTED = 0.01
LETTER_BITS = 21
NO_LETTER = (1 << LETTER_BITS) - 1


def word_counts(docs: DataFrame) -> DataFrame:
    """The distinct pre-tokens of all texts with their counts: word (UTF-8), n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for _, texts in slices(batch, 0):
                for text in texts:
                    held.update(text.split())
                if len(held) > HELD_WORDS:
                    yield [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())]
                    held = Counter()
        yield [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())]

    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
    counted = arrow_pass(docs.select(docs["text"].cast("string")), run, schema)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Lattice:
    """Pieces as a trie with sorted keys, walked from every letter of many pre-tokens at once."""

    def __init__(self, pieces: Iterable[str]):
        children: dict[int, int] = {}
        number = [-1]
        self.size = 0
        for piece in pieces:
            node = 0
            for letter in piece:
                key = node << LETTER_BITS | ord(letter)
                if key not in children:
                    children[key] = len(number)
                    number.append(-1)
                node = children[key]
            number[node] = self.size
            self.size += 1
        keys = sorted(children)
        self.keys = np.array([*keys, np.iinfo(np.int64).max], dtype=np.int64)
        self.target = np.array([*(children[key] for key in keys), 0], dtype=np.int64)
        self.number = np.array(number, dtype=np.int64)

    def edges(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place, length and number of every piece in the letters; pre-tokens end with NO_LETTER."""
        start = np.flatnonzero(letters != NO_LETTER)
        node = np.zeros(len(start), dtype=np.int64)
        found, length = [], 0
        while len(start):
            key = node << LETTER_BITS | letters[start + length]
            at = np.searchsorted(self.keys, key)
            hit = self.keys[at] == key
            if length == 0:
                single = np.zeros(len(letters), dtype=bool)
                single[start[hit]] = self.number[self.target[at[hit]]] >= 0
                unknown = start[~single[start]]
                found.append((unknown, np.ones_like(unknown), np.full_like(unknown, self.size)))
            start, node, length = start[hit], self.target[at[hit]], length + 1
            piece = self.number[node]
            ends = piece >= 0
            found.append((start[ends], np.full(int(ends.sum()), length), piece[ends]))
        if not found:
            return (np.zeros(0, dtype=np.int64),) * 3
        return tuple(np.concatenate(column) for column in zip(*found))

    def occurrences(self, letters: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How often each piece occurs; the pre-token that ends at place k occurs counts[k] times."""
        start, _, piece = self.edges(letters)
        return self._total(piece, counts[self._word_end(letters)[start]])

    def expected(self, letters: np.ndarray, counts: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """How often each piece is expected, in units of 2**-20."""
        start, length, piece = self.edges(letters)
        score = np.append(scores, scores.min(initial=0.0) - UNKNOWN_PENALTY)[piece]
        end = start + length
        last = self._word_end(letters)
        closing = np.flatnonzero(letters == NO_LETTER)
        opening = np.concatenate([[0], closing[:-1] + 1])
        first = np.repeat(opening, closing + 1 - opening)
        ahead, behind = np.full(len(letters), -np.inf), np.full(len(letters), -np.inf)
        ahead[opening] = behind[closing] = 0.0
        if len(closing) == 1:
            self._along(ahead, start, end, score)
            self._along(behind, end, start, score, backwards=True)
            share = np.exp(ahead[start] + score + behind[end] - ahead[last[start]])
            return self._total(piece, np.rint(share * UNIT) * counts[last[start]])
        # Edges of the same end (or start) within their words and the same length never share a place.
        for group in self._groups((end - first[end]) << 32 | length):
            to = end[group]
            ahead[to] = np.logaddexp(ahead[to], ahead[start[group]] + score[group])
        for group in self._groups((last[start] - start) << 32 | length):
            to = start[group]
            behind[to] = np.logaddexp(behind[to], behind[end[group]] + score[group])
        share = np.exp(ahead[start] + score + behind[end] - ahead[last[start]])
        return self._total(piece, np.rint(share * UNIT) * counts[last[start]])

    @staticmethod
    def _along(total: np.ndarray, source: np.ndarray, target: np.ndarray, score: np.ndarray, backwards: bool = False) -> None:
        """Log sums at every place of one word, one place after the other."""
        order = np.argsort(target, kind="stable")
        reached, first = np.unique(target[order], return_index=True)
        cuts = [*first.tolist(), len(order)]
        places = range(len(reached))
        for k in reversed(places) if backwards else places:
            group = order[cuts[k] : cuts[k + 1]]
            total[reached[k]] = np.logaddexp.reduce(total[source[group]] + score[group])

    def _total(self, piece: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return np.bincount(piece, weights, self.size + 1)[: self.size].astype(np.int64)

    @staticmethod
    def _word_end(letters: np.ndarray) -> np.ndarray:
        closing = np.flatnonzero(letters == NO_LETTER)
        return np.repeat(closing, np.diff(closing, prepend=-1))

    @staticmethod
    def _groups(key: np.ndarray) -> list[np.ndarray]:
        order = np.argsort(key, kind="stable")
        return np.split(order, np.flatnonzero(np.diff(key[order])) + 1) if len(order) else []


def laid_out(words: list[str], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of marked pre-tokens, each closed by NO_LETTER, and at the closing places the counts."""
    joined = "\n".join(words) + "\n"  # pre-tokens hold no line ends
    letters = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
    letters[letters == ord("\n")] = NO_LETTER
    at = np.zeros(len(letters))
    at[letters == NO_LETTER] = counts
    return letters, at


def _summed(counts: DataFrame, pieces: list[str], scores: np.ndarray | None) -> np.ndarray:
    """One number a piece over all pre-tokens: occurrences without scores, else expected units."""
    shared = counts.sparkSession.sparkContext.broadcast((pieces, scores))  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        pieces, scores = shared.value
        lattice = Lattice(pieces)
        total = np.zeros(len(pieces), dtype=np.int64)
        words: list[str] = []
        numbers: list[int] = []
        held = 0

        def weigh(words: list[str], numbers: list[int]) -> None:
            letters, at = laid_out(words, numbers)
            total[:] += lattice.occurrences(letters, at) if scores is None else lattice.expected(letters, at, scores)

        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = WORD_MARK + word.decode("utf-8", "replace")
                if len(text) > LONG_WORD:
                    weigh([text], [n])
                    continue
                words.append(text)
                numbers.append(n)
                held += len(text) + 1
                if held > LETTERS_AT_ONCE:
                    weigh(words, numbers)
                    words, numbers, held = [], [], 0
        if words:
            weigh(words, numbers)
        some = np.flatnonzero(total)
        yield [pa.array(some, pa.int32()), pa.array(total[some], pa.int64())]

    schema = T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("units", T.LongType())])
    rows = arrow_pass(counts, run, schema).groupBy("piece").agg(F.sum("units").alias("units")).toArrow()
    out = np.zeros(len(pieces), dtype=np.int64)
    out[rows.column("piece").to_numpy()] = rows.column("units").to_numpy()
    return out


def learn(docs: DataFrame, pieces: Iterable[str], rounds: int = ROUNDS) -> dict[str, float]:
    """The log probability of each piece that occurs in the pre-tokens of the table."""
    counts = checkpointed(word_counts(docs))
    pieces = sorted(pieces)
    units = _summed(counts, pieces, None)
    pieces = [piece for piece, occurs in zip(pieces, units) if occurs]
    weights = units[units > 0] * np.array([len(piece) for piece in pieces], dtype=float)
    for number in range(rounds + 1):
        weights = np.maximum(weights, LEAST_EXPECTED)
        scores = np.round(np.log(weights) - np.log(weights.sum()), 9) if pieces else np.zeros(0)
        if number < rounds and pieces:
            weights = _summed(counts, pieces, scores) / UNIT
    return dict(zip(pieces, scores.tolist()))

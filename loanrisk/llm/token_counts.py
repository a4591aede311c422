"""Token counts of a unigram vocabulary by dynamic programming over a trie of pre-tokens.

The best segmentation of a prefix depends on that prefix alone, so it is computed once per trie node:
the best score and token count of the path from the root. Pre-tokens that share a prefix share its
nodes; a terminal keeps the count of its pre-token. A node looks back at most as far as pieces end so, so the work is linear in the nodes.

Every Python worker builds tries over the distinct pre-tokens it meets anew, bounded in size, and keeps a
bounded number of terminals; nothing is shuffled. Sorted pre-tokens form a trie level by level: a node
begins where a pre-token's prefix differs from its neighbour's. Pieces that end at a node are found by
walking back from all nodes at once through a trie of reversed pieces, then one level's scores follow from
those of the levels above. Counts do not depend on what a trie holds already.

Pre-tokens are the words between ASCII white space, each after the word mark that the vocabulary puts
for a space: the first space before a word counts with the word, all other white space has no tokens.
Scores are log probabilities that ``unigram.learn`` takes from the corpus, or the file's own, which
are log probabilities only if it holds a unigram model; of equal scores the segmentation with fewer
tokens counts. A character that no piece covers counts as its UTF-8 bytes, at a score below every piece.

Defined results: null and empty texts and white space have no tokens; very long words are counted
whole, outside the shared trie; an empty table gives an empty table. Columns besides the kept ones
and text are not read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from loanrisk.llm.common import map_texts
from loanrisk.llm.unigram import LETTER_BITS, UNKNOWN_PENALTY, WORD_MARK

#: Nodes of one trie at most, terminals a worker keeps, and the longest word that is put into a trie.
TRIE_NODES, TRIE_WORDS, TRIE_WORD_LENGTH = 600_000, 500_000, 64


class ReversedPieces:
    """Pieces as a trie of their letters from the last to the first."""

    def __init__(self, scores: dict[str, float]):
        children: dict[int, int] = {}
        score = [-math.inf]
        for piece, value in scores.items():
            state = 0
            for letter in reversed(piece):
                key = state << LETTER_BITS | ord(letter)
                if key not in children:
                    children[key] = len(score)
                    score.append(-math.inf)
                state = children[key]
            score[state] = value
        keys = sorted(children)
        self.keys = np.array([*keys, np.iinfo(np.int64).max], dtype=np.int64)
        self.target = np.array([*(children[key] for key in keys), 0], dtype=np.int64)
        self.score = np.array(score)

    def endings(self, parent: np.ndarray, letter: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """For each length from 1: nodes where pieces of that length end, nodes where these begin, scores.

        A node has its parent and the letter that leads to it; node 0 is the root. Nodes ascend.
        """
        node = np.arange(1, len(parent))
        above = node
        state = np.zeros(len(node), dtype=np.int64)
        while len(node):
            key = state << LETTER_BITS | letter[above]
            found = np.searchsorted(self.keys, key)
            hit = np.flatnonzero(self.keys[found] == key)
            node, above, state = node[hit], parent[above[hit]], self.target[found[hit]]
            score = self.score[state]
            ends = np.flatnonzero(score > -math.inf)
            yield node[ends], above[ends], score[ends]
            further = np.flatnonzero(above)
            node, above, state = node[further], above[further], state[further]


class UnigramTrie:
    """Pre-tokens with the best score and token count of every prefix."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        # Ends of pieces; those that are no piece themselves can never be the best.
        self.endings = {piece[k:]: -math.inf for piece in scores for k in range(1, len(piece))} | scores
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.pieces = ReversedPieces(scores)
        self.terminals: dict[bytes, int] = {}

    def _step(self, word: str, end: int, path: list[tuple[float, int]]) -> tuple[float, int]:
        """Best (score, minus tokens) of word[:end], from those of all shorter prefixes."""
        endings = self.endings
        best, tokens = -math.inf, 0
        for start in range(end - 1, -1, -1):
            score = endings.get(word[start:end])
            if score is None:  # no piece ends with this, nor with anything longer
                break
            before, less = path[start]
            score += before
            if score > best or score == best and less > tokens:
                best, tokens = score, less - 1
        letter = word[end - 1]
        if letter not in self.scores:
            before, less = path[end - 1]
            candidate = (before + self.unknown, less - len(letter.encode("utf-8", "replace")))
            return max((best, tokens), candidate)
        return best, tokens

    def count_alone(self, word: str) -> int:
        """Tokens of one long pre-token, letter by letter along its only path."""
        path = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            path.append(self._step(word, end, path))
        return -path[-1][1]

    def count(self, word: str) -> int:
        """Tokens of one pre-token through a trie of its own."""
        return self.count_together([word])[0]

    def count_together(self, words: list[str]) -> list[int]:
        """Tokens of many sorted pre-tokens through one trie; none is empty."""
        parent, letter, levels, terminal = prefix_tree(words)
        best, less = np.zeros(len(parent)), np.zeros(len(parent), dtype=np.int64)
        # A letter without a piece counts as its bytes; any other is a piece, overwritten just below.
        score = np.full(len(parent), self.unknown)
        tokens = 1 + (letter >= 0x80) + (letter >= 0x800) + (letter >= 0x10000)
        edges = []
        for length, (node, above, value) in enumerate(self.pieces.endings(parent, letter), 1):
            if length == 1:
                score[node], tokens[node] = value, 1
            elif len(node):
                edges.append((node, above, value, np.searchsorted(node, levels).tolist()))
        for level in range(len(levels) - 1):
            of_level = slice(levels[level], levels[level + 1])
            best[of_level] = best[parent[of_level]] + score[of_level]
            less[of_level] = less[parent[of_level]] - tokens[of_level]
            for nodes, above, value, cuts in edges:
                here = slice(cuts[level], cuts[level + 1])
                if here.start == here.stop:
                    continue
                node, start = nodes[here], above[here]
                candidate, fewer = best[start] + value[here], less[start] - 1
                held = best[node]
                better = (candidate > held) | (candidate == held) & (fewer > less[node])
                node = node[better]
                best[node], less[node] = candidate[better], fewer[better]
        return (-less[terminal]).tolist()

    def counts(self, words: set[bytes]) -> dict[bytes, int]:
        """Counts of distinct pre-tokens, given without the word mark."""
        missing = words.difference(self.terminals)
        if len(self.terminals) > TRIE_WORDS:
            self.terminals = {}
            missing = words
        short = sorted(word for word in missing if len(word) <= TRIE_WORD_LENGTH)
        long = {
            word: self.count_alone(WORD_MARK + word.decode("utf-8", "replace"))
            for word in missing if len(word) > TRIE_WORD_LENGTH
        }
        part = np.cumsum([len(word) + 1 for word in short]) // TRIE_NODES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(short)]
        for begin, stop in zip(cuts, cuts[1:]):
            some = short[begin:stop]
            if some:
                texts = b"\n".join(some).decode("utf-8", "replace").split("\n")
                self.terminals.update(zip(some, self.count_together([WORD_MARK + text for text in texts])))
        return {**self.terminals, **long} if long else self.terminals


def prefix_tree(words: list[str]) -> tuple[np.ndarray, np.ndarray, list[int], np.ndarray]:
    """The trie of words, none empty: each node's parent and letter, the first node of every level (and
    the number of nodes), each word's terminal node.

    Words next to each other share nodes as far as their prefixes agree; sorted, all words do.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
    begins = np.cumsum(lengths) - lengths
    terminal = np.zeros(len(words), dtype=np.int64)
    alive = np.arange(len(words))
    differs = np.zeros(len(words), dtype=bool)
    parents, own, levels, depth = [np.zeros(1, dtype=np.int64)], [np.zeros(1, dtype=np.int64)], [1], 0
    while len(alive):
        here = letters[begins[alive] + depth]
        # A word in between that has ended is no prefix of the one before: the next one begins a node.
        differs[1:] |= (here[1:] != here[:-1]) | (np.diff(alive) > 1)
        differs[0] = True
        first = alive[differs]
        parents.append(terminal[first])
        own.append(here[differs])
        terminal[alive] = levels[-1] - 1 + np.cumsum(differs)
        levels.append(levels[-1] + len(first))
        depth += 1
        longer = np.flatnonzero(lengths[alive] > depth)
        alive, differs = alive[longer], differs[longer]
    return np.concatenate(parents), np.concatenate(own), levels, terminal


def vocabulary_scores(path: str) -> dict[str, float]:
    """Pieces and scores of a sentencepiece file, without control, unknown and byte pieces."""
    model = SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(k): model.get_score(k)
        for k in range(model.get_piece_size())
        if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))
    }


@lru_cache(maxsize=2)
def trie(path: str) -> UnigramTrie:
    """One trie per Python worker and file."""
    return UnigramTrie(vocabulary_scores(path))


#: The trie of the learnt scores that this Python worker counted with last.
_learnt: dict[str, UnigramTrie] = {}


def token_counts(docs: DataFrame, path: str, scores: dict[str, float] | None = None) -> DataFrame:
    """One row per document: doc_id, n_pretokens and n_tokens of its whole text.

    With the given scores of pieces, else with those of the vocabulary file.
    """
    name = uuid.uuid4().hex
    shared = None if scores is None else docs.sparkSession.sparkContext.broadcast(scores)  # one a piece

    def own_trie() -> UnigramTrie:
        if shared is None:
            return trie(path)
        if name not in _learnt:
            _learnt.clear()
            _learnt[name] = UnigramTrie(shared.value)
        return _learnt[name]

    def count(_: pa.RecordBatch, texts: list[bytes]) -> list[pa.Array]:
        split = [text.split() for text in texts]
        counts = own_trie().counts(set().union(*split))
        return [
            pa.array([len(words) for words in split], pa.int64()),
            pa.array([sum([counts[word] for word in words]) for words in split], pa.int64()),
        ]

    return map_texts(
        docs, [docs["doc_id"]], docs["text"], count,
        [T.StructField("n_pretokens", T.LongType(), False), T.StructField("n_tokens", T.LongType(), False)],
    )

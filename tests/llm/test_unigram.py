"""Learnt unigram scores against sums over all segmentations in plain Python."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest

from loanrisk.llm import queries, token_counts, unigram

PIECES = ["▁", "a", "b", "c", "▁a", "ab", "▁ab", "bc", "abc", "cab"]


def segmentations(word, known):
    if not word:
        yield []
    for end in range(1, len(word) + 1):
        if word[:end] in known or end == 1:
            yield from ([word[:end], *rest] for rest in segmentations(word[end:], known))


def plain_learn(texts, rounds):
    words = Counter("▁" + word for text in texts for word in (text or "").split())
    weights = {p: sum(n * sum(w.startswith(p, k) for k in range(len(w))) for w, n in words.items()) for p in PIECES}
    weights = {p: n * len(p) for p, n in weights.items() if n}
    for number in range(rounds + 1):
        weights = {p: max(n, unigram.LEAST_EXPECTED) for p, n in weights.items()}
        scores = {p: math.log(n / sum(weights.values())) for p, n in weights.items()}
        if number == rounds:
            return scores
        floor = min(scores.values()) - unigram.UNKNOWN_PENALTY
        expected = defaultdict(float)
        for word, n in words.items():
            ways = [(way, math.exp(sum(scores.get(p, floor) for p in way))) for way in segmentations(word, scores)]
            for way, chance in ways:
                for p in way:
                    expected[p] += n * chance / sum(c for _, c in ways)
        weights = {p: expected[p] for p in scores}


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_learnt_scores(spark, rounds, monkeypatch):
    monkeypatch.setattr(unigram, "LETTERS_AT_ONCE", 40)
    monkeypatch.setattr(unigram, "HELD_WORDS", 2)
    texts = ["abc  ab a\nabcab", None, "", "cab bcab éab aéc ab abcabcab", "bb ccc ab abc" * 3]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    expected = plain_learn(texts, rounds)
    got = unigram.learn(docs, PIECES, rounds)
    assert got.keys() == expected.keys()
    assert all(abs(got[p] - expected[p]) < 1e-4 for p in got)
    assert unigram.learn(docs.filter("false"), PIECES, rounds) == {}


def test_long_words_are_learnt_from_whole(spark):
    word = "ab" * 1000 + "c"
    assert unigram.learn(spark.createDataFrame([(word,)], "text string"), ["▁", "a", "b", "c"], 1) == pytest.approx(
        {p: math.log(n / 2002) for p, n in (("▁", 1), ("a", 1000), ("b", 1000), ("c", 1))}, abs=1e-6
    )


def test_one_long_word_is_weighed_as_among_others():
    import numpy as np

    lattice = unigram.Lattice(PIECES)
    scores = np.array([-1.0 - 0.3 * (k % 5) for k in range(len(PIECES))])
    words = ["▁" + "abcxab"[k % 4 :] * (1 + k % 90) for k in range(7)] + ["▁" + "abcab" * 300]
    together = lattice.expected(*unigram.laid_out(words, [3] * len(words)), scores)
    alone = sum(lattice.expected(*unigram.laid_out([word], [3]), scores) for word in words)
    assert abs(together - alone).max() <= 1e-9 * together.max()


def test_frequent_words_that_are_pieces_are_one_token(spark, tmp_path):
    texts = ["the information of the government is international"] * 40 + ["the of the is of"] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op4_token_counts(spark, str(tmp_path)).collect()
    assert {(r["n_pretokens"], r["n_tokens"]) for r in rows} == {(7, 7), (5, 5)}


def test_query_counts_near_the_vocabularys_own_encoding(spark, scale_dir, documents):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    own = SentencePieceProcessor(model_file=public_tokenizers.path(queries.UNIGRAM_FILE))
    by_library = sum(len(own.encode(" ".join((r["text"] or "").split()))) for r in documents.collect())
    counted = sum(r["n_tokens"] for r in queries.op4_token_counts(spark, scale_dir).collect())
    assert counted < 1.02 * by_library


def test_trie_of_many_words_agrees_with_each_alone(monkeypatch):
    scores = {piece: -1.0 - 0.25 * (k % 7) for k, piece in enumerate([*PIECES, "é", "本", "日本", "𝄞a", "▁𝄞"])}
    letters = "abcé日本𝄞x"
    words = {
        "".join(letters[number // 8**k % 8] for k in range(1 + number % 5)).encode() for number in range(3000)
    } | {b"abc" * 30, b"\xff\xfeab", "日本".encode() * 25}
    trie = token_counts.UnigramTrie(scores)
    monkeypatch.setattr(token_counts, "TRIE_NODES", 999)
    counts = trie.counts(words)
    for word in words:
        assert counts[word] == trie.count_alone("▁" + word.decode("utf-8", "replace"))
    assert token_counts.UnigramTrie(scores).counts(set()) == {}
    parent, letter, levels, terminal = token_counts.prefix_tree(["a", "ab", "abd", "ac", "b"])
    assert (len(parent), levels, terminal.tolist()) == (6, [1, 3, 5, 6], [1, 3, 5, 4, 2])

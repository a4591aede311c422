"""Lexical search and importance resampling against plain computations, on odd texts, ties and empty tables."""

from __future__ import annotations

import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loanrisk.llm import lexical_search, resampling
from tests.llm.conftest import DOCUMENTS

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ITEMS = [(1, "The quick FOX, the fox"), (2, "word word x"), (2, "word word x"), (3, None), (4, "nowhere-found"),
         (5, "éa 漢字かな交じり文です"), (None, "two words")]


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(docs, items, top=10):
    terms = [(doc_id, Counter(words(text))) for doc_id, text in docs]
    lengths = [sum(counts.values()) for _, counts in terms]
    n_docs, total = sum(map(bool, lengths)), sum(lengths)
    frequency = Counter(term for _, counts in terms for term in counts)
    out = []
    for item_id, text in items:
        scored = []
        for (doc_id, counts), n in zip(terms, lengths):
            score = 0
            for term in words(text):
                if counts[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[term] + 1)))
                    m = 25 + 75 * n * n_docs // total
                    score += w * (1_000_000_000 * counts[term] // (1000 * counts[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scored)[:top], 1):
            out.append(repr((item_id, rank, None if null else doc_id, -score)))
    return sorted(out)


@pytest.mark.parametrize("items_at_once", [1000, 2])
def test_search_of_odd_documents(spark, odd_documents, items_at_once, monkeypatch):
    monkeypatch.setattr(lexical_search, "DOCUMENTS", 5)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = lexical_search.search(odd_documents, items, items_at_once=items_at_once)
    rows = [(row["doc_id"], row["text"]) for row in odd_documents.collect()]
    assert sorted(repr(tuple(row)) for row in found.collect()) == brute_search(rows, ITEMS)


def test_search_keeps_the_smaller_ids_of_ties(spark):
    docs = spark.createDataFrame([(k, "tie here" if k % 2 else "other", None, None, None) for k in range(99, -1, -1)], DOCUMENTS)
    found = lexical_search.search(docs.repartition(7), spark.createDataFrame([(1, "tie")], "item_id long, text string"))
    assert [row["doc_id"] for row in found.orderBy("rank").collect()] == list(range(1, 20, 2))


def test_search_of_nothing(spark, no_documents, documents):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.search(no_documents, items).isEmpty()
    assert lexical_search.search(documents, items.limit(0)).isEmpty()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3), st.integers(1, 500)), unique_by=lambda w: w[:2]))
def test_weight_tiles_are_exact(weights):
    tiles = lexical_search.weight_tiles(weights, most_weight=100, most_terms=3)
    total = Counter()
    for tile in tiles:
        sums = Counter()
        for term, of_items in tile.items():
            for item, value in of_items:
                sums[item] += value
                total[term, item] += value
        assert len(tile) <= 3 and all(value <= 100 for value in sums.values())
    assert total == Counter({(term, item): value for term, item, value in weights})


def features(text):
    found = words(text)
    return found + [a + " " + b for a, b in zip(found, found[1:])]


def brute_resample(docs, target, percent=25, least=20):
    def counted(texts):
        counts = Counter(crc32(f.encode()) % 10000 for text in texts for f in features(text))
        return counts, sum(counts.values())

    (s, s_all), (t, t_all) = counted(text for _, text in docs), counted(target)
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)
    ]
    rows = []
    for doc_id, text in docs:
        found = features(text)
        weight = sum(gain[crc32(f.encode()) % 10000] for f in found) // len(found) if found else 0
        h = int(sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, len(words(text))])
    eligible = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(eligible[: percent * len(eligible) // 100], 1):
        row[4] = rank
    return sorted(repr(tuple(row[:5])) for row in rows)


def resampled(docs, target, **parameters):
    return sorted(repr(tuple(row)) for row in resampling.resample(docs, target, **parameters).collect())


def test_resampling_of_odd_documents(spark, odd_documents):
    """Lines repeated in a text and between texts, words across line ends, nulls, repeated rows and ids."""
    rows = [(row["doc_id"], row["text"]) for row in odd_documents.collect()]
    lines = ["the same line here", "", " \n ", "another one, of words", "X"]
    rows += [(100 + k, "\n".join(lines[j % 5] for j in range(k, k + 12)) + f"\nown {k % 3}") for k in range(30)]
    docs = spark.createDataFrame([(doc_id, text, None, None, None) for doc_id, text in rows], DOCUMENTS)
    texts = [text for _, text in ITEMS]
    target = spark.createDataFrame([(text,) for text in texts], "text string")
    assert resampled(docs.repartition(3), target) == brute_resample(rows, texts)
    assert resampled(docs, target, percent=60, least_words=0) == brute_resample(rows, texts, 60, 0)


def test_resampling_of_nothing(spark, no_documents, documents):
    target = spark.createDataFrame([("some words",)], "text string")
    assert resampled(no_documents, target) == []
    rows = [(row["doc_id"], row["text"]) for row in documents.collect()]
    assert resampled(documents, target.limit(0)) == brute_resample(rows, [])


def test_buckets_of_a_line():
    assert resampling.line_buckets(b"a b") == [crc32(b"a") % 10000, crc32(b"b") % 10000, crc32(b"a b") % 10000]
    assert np.frombuffer(resampling._packed([1, 9999], 10000), dtype="<u2").tolist() == [1, 9999]

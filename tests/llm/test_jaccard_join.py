"""The Jaccard join against all pairs: on odd texts, crowds, given documents, and the tree by itself."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loanrisk.llm import jaccard_join as jj
from tests.llm.conftest import DOCUMENTS


def shingles(text):
    words = (text or "").encode().lower().split()
    width = min(4, len(words))
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if words else set()


def brute_force(rows, percent=85):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows."""
    sets = [shingles(text) for _, text in rows]
    label = list(range(len(rows)))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                label[find(i)] = find(j)
    named = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            named[find(k)] = min(doc_id, named.get(find(k), doc_id))
    return sorted(
        (repr((doc_id, len(sets[k]), named.get(find(k)) if sets[k] else doc_id)) for k, (doc_id, _) in enumerate(rows))
    )


def found(docs, **parameters):
    return sorted(repr(tuple(row)) for row in jj.jaccard_components(docs, **parameters).collect())


def stored(spark, tmp_path, rows):
    path = str(tmp_path / "documents.parquet")
    full = [(doc_id, text, None, None, None) for doc_id, text in rows]
    spark.createDataFrame(full, DOCUMENTS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_odd_documents(odd_documents):
    rows = [(row["doc_id"], row["text"]) for row in odd_documents.collect()]
    assert found(odd_documents) == brute_force(rows)


def test_no_documents(no_documents):
    assert found(no_documents) == []


def test_given_documents(documents):
    rows = [(row["doc_id"], row["text"]) for row in documents.collect()]
    assert found(documents) == brute_force(rows)


@pytest.mark.parametrize("limits", [{}, {"block": 16, "nearest": 1}])
def test_crowds(spark, tmp_path, limits):
    """Near copies on either side of the threshold, chains, a passage in all texts, repeated rows; the small
    limits cut groups into blocks and need several rounds."""
    random = np.random.default_rng(5)
    words = [f"w{k}" for k in range(3000)]
    passage = " ".join(random.choice(words, 30))
    rows = []
    for _ in range(6):
        text = list(random.choice(words, 80))
        for copy in range(12):
            rows.append((len(rows), " ".join(text) + (" " + passage if copy % 2 else "")))
            for at in random.integers(0, len(text), copy % 3):
                text[at] = str(random.choice(words))  # drifts away from the first
    rows += [(len(rows) + k, passage + f" end{k}") for k in range(40)] + rows[:10] + [(None, rows[3][1])]
    assert found(stored(spark, tmp_path, rows), **limits) == brute_force(rows)


def test_one_long_text(spark, tmp_path):
    """Over one slice of 4 MB in a single text, with a near copy and an exact one."""
    text = " ".join(f"word{k}" for k in range(500_000))
    rows = [(5, text), (3, text + " more"), (9, text.upper()), (1, "other words here now")]
    got = {row["doc_id"]: tuple(row) for row in jj.jaccard_components(stored(spark, tmp_path, rows)).collect()}
    assert len(text) > 5 << 20
    assert got == {5: (5, 499997, 3), 3: (3, 499998, 3), 9: (9, 499997, 3), 1: (1, 1, 1)}


def test_prefixes_are_long_enough():
    for n in range(1, 400):
        rest = n - jj.prefix_length(n)  # what a partner may have besides the shared ones that are wanted
        assert jj.wanted_in_common(n) + rest == -(-85 * n // 100)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.sampled_from([50, 85, 100]))
def test_tree_misses_nothing(seed, count, percent):
    random = np.random.default_rng(seed)
    base = random.integers(0, 2**63, 150, dtype=np.uint64)
    sets = [np.unique(random.choice(base, random.integers(1, 150))) for _ in range(count)]
    group = np.sort(random.integers(0, 3, count))
    component = random.integers(0, 5, count)
    size = np.array([len(s) for s in sets])
    order = np.lexsort((size, group))
    sets, group, component, size = [sets[k] for k in order], group[order], component[order], size[order]
    bits = np.array([jj.bitmap(s) for s in sets])
    excess = size - np.bitwise_count(bits).sum(axis=1).astype(int)
    left, right, overlap = jj.tree_pairs(group, size, excess, bits, component, percent)
    pairs = dict(zip(zip(left.tolist(), right.tolist()), overlap.tolist()))
    assert len(pairs) == len(left)
    for i in range(count):
        for j in range(i + 1, count):
            if group[i] == group[j] and component[i] != component[j] and jj.linked(sets[i], sets[j], percent):
                assert pairs[i, j] >= len(np.intersect1d(sets[i], sets[j]))
            elif component[i] == component[j] or group[i] != group[j]:
                assert (i, j) not in pairs

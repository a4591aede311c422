"""Components of links: against a plain search, and what Spark does for them."""

from __future__ import annotations

import numpy as np
import pytest

from loanrisk.llm import jaccard_join as jj
from loanrisk.llm import simhash
from loanrisk.llm.common import stored
from tests.llm.conftest import DOCUMENTS


def plain(edges):
    """(node, least node of its component) of all nodes that have a lesser one."""
    around = {}
    for a, b in edges:
        if a != b:
            around.setdefault(a, set()).add(b)
            around.setdefault(b, set()).add(a)
    root = {}
    for start in sorted(around):
        todo = [start] if start not in root else []
        while todo:
            node = todo.pop()
            if node not in root:
                root[node] = start
                todo += around[node]
    return sorted((node, least) for node, least in root.items() if node != least)


def chain(count, seed=1):
    names = np.random.default_rng(seed).permutation(count) * 7 - 400
    return list(zip(names[1:].tolist(), names[:-1].tolist()))


def graphs():
    random = np.random.default_rng(3)
    sparse = random.integers(-(2**63), 2**63 - 1, 400)
    yield "none", []
    yield "loops", [(1, 1), (2, 2)]
    yield "repeated", [(5, 3), (3, 5), (5, 3), (-9, 5), (4, 4)]
    yield "chain", chain(600)
    yield "ordered chain", [(k, k + 1) for k in range(600)]
    yield "least in the middle", [(k, -1) for k in range(600)]
    yield "greatest in the middle", [(k, 10_000) for k in range(600)]
    yield "sparse", [(int(a), int(b)) for a, b in random.choice(sparse, (300, 2))]
    yield "dense", [(int(a), int(b)) for a, b in random.integers(0, 60, (500, 2))]


@pytest.mark.parametrize("limits", [{}, {"BROADCAST_ROWS": 0, "EDGES_AT_ONCE": 8}], ids=["given", "small"])
@pytest.mark.parametrize("name, edges", list(graphs()), ids=lambda value: value if isinstance(value, str) else "")
def test_components(spark, monkeypatch, name, edges, limits):
    for limit, value in limits.items():
        monkeypatch.setattr(simhash, limit, value)
    found = simhash.components(spark.createDataFrame(edges, simhash.EDGE).repartition(5))
    assert sorted(map(tuple, found.collect())) == plain(edges)


def test_rounds_are_few_stages(spark):
    """A round is one shuffle: 211 tasks each time made most of a crowded table's time."""
    edges = stored(spark.createDataFrame(chain(600), simhash.EDGE).repartition(5))
    context, group = spark.sparkContext, "components of a chain"
    context.setJobGroup(group, group)
    try:
        simhash.components(edges)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(group)]
    assert 0 < len({stage for job in jobs for stage in job.stageIds}) <= 30


def test_nothing_verified_leaves_the_components(spark, tmp_path, monkeypatch):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(k, f"{text} end{k}", None, None, None) for k in range(8)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(path)
    calls, asked = [], []
    components, nothing = jj.components, spark.createDataFrame([], jj.EDGE)
    monkeypatch.setattr(jj, "components", lambda edges: calls.append(edges) or components(edges))
    monkeypatch.setattr(jj, "_verified", lambda pairs, *_: asked.append(pairs) or nothing)
    jj.jaccard_components(spark.read.parquet(path)).collect()
    assert len(asked) > 1 and len(calls) == 1

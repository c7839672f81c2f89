"""Component search against union-find: long chains, stars, forests, odd numbers."""

import random

import pytest
from pyspark.sql import functions as F

from rillet.llm import components
from rillet.llm.components import contracted, scrambled, unscrambled

RNG = random.Random(3)
GRAPHS = {
    "chain in id order": [(n, n + 1) for n in range(10_000)],
    "star around a middle id": [(700, n) for n in range(3_000) if n != 700],
    "random forest": [(RNG.randrange(n), n) for n in range(1, 5_000) if RNG.random() < 0.9],
    "caterpillar": [(n, n + 1) for n in range(60)] + [(n, 100 * n + k + 1_000) for n in range(61) for k in range(n)],
    "negative, repeated, both ways": [(-5, 3), (3, -5), (-5, 3), (3, 3), (2**63 - 1, -(2**63)), (8, 8)],
}


def _union_find(edges):
    parent = {}

    def root(node):
        while parent.setdefault(node, node) != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {node: root(node) for node in list(parent)}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name, monkeypatch):
    tables = []
    written = components.written
    monkeypatch.setattr(components, "written", lambda rows: tables.append(rows) or written(rows))
    (whole,) = contracted(spark.createDataFrame(GRAPHS[name], "a long, b long"))
    assert {r.node: r.parent for r in whole.collect()} == _union_find(GRAPHS[name])
    # One table of edges, two for each round, one less for the way back, and the result.
    assert len(tables) <= 1 + 2 * 12 + 11 + 1


def test_no_edges(spark):
    assert contracted(spark.createDataFrame([(4, 4)], "a long, b long")) == []
    assert contracted(spark.createDataFrame([], "a long, b long")) == []


def test_scrambling_is_one_to_one(spark):
    numbers = [0, 1, -1, 2**63 - 1, -(2**63), 2**32, 2**32 - 1, -(2**31), 987654321012345678]
    rows = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", scrambled(F.col("n")).alias("s"))
    rows = rows.withColumn("back", unscrambled(F.col("s"))).collect()
    assert [r.n for r in rows] == [r.back for r in rows] and len({r.s for r in rows}) == len(numbers)

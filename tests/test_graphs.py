"""Components, forests and merge sizes against plain union-find, with every chunk size."""

import random

import pytest
from pyspark.sql import functions as F

from ticketmill.operators import graphs
from ticketmill.session import settle


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def graph(seed, n=120, m=260):
    rng = random.Random(seed)
    return [(rng.randrange(n), rng.randrange(n), float(rng.randrange(12))) for _ in range(m)]


@pytest.mark.parametrize("chunk", [0, 7, 1000])
def test_components(spark, chunk):
    edges = [(a, b) for a, b, _ in graph(3, 200, 150)] + [(i, i + 1) for i in range(300, 340)] + [(500, 500)]
    sets = Sets()
    for a, b in edges:
        sets.join(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in graphs.connected_components(df, chunk).collect()}
    assert got == {x: sets.find(x) for e in edges for x in e}
    assert graphs.connected_components(df.limit(0), chunk).count() == 0


@pytest.mark.parametrize("chunk", [5, 1000])
def test_spanning_forest(spark, chunk):
    edges = graph(4)
    sets, want = Sets(), set()
    for w, a, b in sorted((w, min(a, b), max(a, b)) for a, b, w in edges if a != b):
        if sets.join(a, b):
            want.add((a, b, w))
    df = spark.createDataFrame(edges, "a long, b long, w double")
    assert {tuple(r) for r in graphs.spanning_forest(df, chunk).collect()} == want
    assert graphs.spanning_forest(df.limit(0), chunk).count() == 0


@pytest.mark.parametrize("chunk", [3, 20, 1000])
def test_merge_sizes(spark, chunk):
    rng = random.Random(chunk)
    forest, sets = [], Sets()
    for w, a, b in sorted((w, min(a, b), max(a, b)) for a, b, w in graph(5) if a != b):
        if sets.join(a, b):
            forest.append((a, b, w))
    weight = {x: rng.randint(1, 4) for a, b, _ in forest for x in (a, b)}
    sets, size, want = Sets(), dict(weight), {}
    for place, (a, b, w) in enumerate(sorted(forest, key=lambda e: (e[2], e[0], e[1]))):
        i, j = sets.find(a), sets.find(b)
        want[a, b] = (w, place, size[i], size[j])
        sets.join(a, b)
        size[min(i, j)] = size[i] + size[j]
    got = graphs.merge_sizes(spark.createDataFrame(forest, "x long, y long, w double"),
                             spark.createDataFrame(list(weight.items()), "node long, weight long"), chunk)
    assert {(r["x"], r["y"]): (r["w"], r["place"], r["size_x"], r["size_y"]) for r in got.collect()} == want


def test_a_hundred_thousand_edges_need_no_rounds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(graphs, "settle", lambda df, label="stage": written.append(label) or settle(df, label))
    edges = spark.range(100_000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"), F.lit(1.0).alias("w"))
    assert graphs.connected_components(edges.select("a", "b")).select("component").distinct().count() == 1
    assert graphs.spanning_forest(edges).count() == 100_000
    assert written == ["edges", "components", "graph", "forest"]

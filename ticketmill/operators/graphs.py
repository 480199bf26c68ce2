"""Connected components, spanning forests and merge sizes of weighted graphs, as joins and least-edge aggregates.

Every step contracts the graph, so the edge table shrinks; once it holds at most ``CHUNK``
edges, one task ends the job. The result is the same whichever side ends it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.operators.ranking import running_total
from ticketmill.session import settle

CHUNK = 400_000


def _roots(a: np.ndarray, b: np.ndarray, keep=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union-find over edges in order: nodes, their smallest connected node, and which edges joined two groups."""
    nodes, codes = np.unique(np.r_[a, b], return_inverse=True)
    up = list(range(len(nodes)))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    joined = np.zeros(len(a), bool)
    for k, (x, y) in enumerate(zip(codes[:len(a)].tolist(), codes[len(a):].tolist())):
        x, y = find(x), find(y)
        if x != y:
            up[max(x, y)] = min(x, y)
            joined[k] = True
    return nodes, nodes[[find(x) for x in range(len(nodes))]] if len(nodes) else nodes, joined


def connected_components(edges: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``edges`` (a, b: long) to (node, component): the smallest node reachable; every node of an edge has a row.

    Each round points nodes at their smallest neighbour, follows the pointers to roots and
    keeps the edges between different roots.
    """
    live = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    done: DataFrame | None = None
    while True:
        if live.count() <= chunk:
            found = _components_in_one_task(live)
            if done is None:
                return found
            last = found.select(F.col("node").alias("up"), F.col("component").alias("next"))
            return done.join(last, "up", "left").select("node", F.coalesce("next", "up").alias("component"))
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = settle(both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("up")), "parents")
        while True:  # pointers only fall, so this ends after log(depth) rounds
            higher = parent.select(F.col("node").alias("up"), F.col("up").alias("upper"))
            parent = settle(parent.join(higher, "up").select(
                "node", F.col("upper").alias("up"), (F.col("upper") < F.col("up")).alias("moved")), "parents")
            if not parent.agg(F.max("moved")).first()[0]:
                break
        onward = parent.select(F.col("node").alias("up"), F.col("up").alias("next"))
        done = settle(parent.select("node", "up") if done is None else
                      done.join(onward, "up", "left").select("node", F.coalesce("next", "up").alias("up")), "components")
        live = settle(_relabel(live, parent.select("node", F.col("up").alias("component"))).select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")


def _components_in_one_task(edges: DataFrame) -> DataFrame:
    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        if held:
            e = pd.concat(held)
            nodes, roots, _ = _roots(e["a"].to_numpy(), e["b"].to_numpy())
            yield pd.DataFrame({"node": nodes, "component": roots})

    return settle(edges.select("a", "b").coalesce(1).mapInPandas(close, "node long, component long"), "components")


def _relabel(edges: DataFrame, components: DataFrame) -> DataFrame:
    """Edges between components, ends renamed; nodes without a row keep their name; inner edges go."""
    ca = components.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    cb = components.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    out = edges.join(ca, "a", "left").join(cb, "b", "left").withColumns(
        {"a": F.coalesce("ca", "a"), "b": F.coalesce("cb", "b")}).drop("ca", "cb")
    return out.filter(F.col("a") != F.col("b"))


def spanning_forest(edges: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The minimum spanning forest of ``edges`` (a, b: long, w: double): x, y, w, the chosen edges.

    Rounds of least outgoing edges (Boruvka); edges of equal weight are ordered by their ends,
    so the forest is unique.
    """
    order = F.struct("w", "x", "y")
    live = settle(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "w").filter("a < b").groupBy("a", "b").agg(
        F.min("w").alias("w")).select("a", "b", "w", F.col("a").alias("x"), F.col("b").alias("y")), "graph")
    chosen = None

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        if held:
            e = pd.concat(held).sort_values(["w", "x", "y"])
            yield e.loc[_roots(e["a"].to_numpy(), e["b"].to_numpy())[2], ["x", "y", "w"]]

    while True:
        if live.count() <= chunk:
            last = settle(live.coalesce(1).mapInPandas(finish, "x long, y long, w double"), "forest")
            return last if chosen is None else chosen.union(last)
        ends = live.select(F.col("a").alias("node"), order.alias("e"), "a", "b").union(
            live.select(F.col("b").alias("node"), order.alias("e"), "a", "b"))
        least = settle(ends.groupBy("node").agg(F.min(F.struct("e", "a", "b")).alias("m")).select("m.e.*", "m.a", "m.b").distinct(), "least")
        picked = least.select("x", "y", "w")
        chosen = picked if chosen is None else chosen.union(picked)
        merged = connected_components(least.select("a", "b"), chunk)
        between = _relabel(live, merged).withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")})
        live = settle(between.groupBy("a", "b").agg(F.min(order).alias("e")).select("a", "b", "e.w", "e.x", "e.y"), "graph")


def merge_sizes(forest: DataFrame, weights: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """x, y, w, place, size_x, size_y, reach_x, reach_y: what the two ends of each edge belong to when the edges join up in order of weight.

    ``forest`` holds x, y, w; ``weights`` (node: 0 or above, weight: long) the size of every node. If ``weights`` has a double
    ``reach``, reach_x and reach_y are the least of each end's nodes, else infinite. The edges
    are numbered in order and halved again and again: the lighter half keeps its nodes, the heavier
    half sees the lighter one's groups as nodes of their size, named -1 less the place of their last edge.
    So no two ranges share a node. Once a range holds at most ``chunk`` edges, one task joins it up.
    """
    one = settle(forest.select("x", "y", "w").withColumn("all", F.lit("")), "forest")
    numbered = running_total(one, "all", [F.col("w"), F.col("x"), F.col("y")]).drop("all")
    edges = settle(numbered.select("*", F.col("x").alias("a"), F.col("y").alias("b")), "numbered")
    nodes = weights.select("node", F.col("weight").cast("long").alias("size"),
                           F.col("reach") if "reach" in weights.columns else F.lit(float("inf")).alias("reach"))
    n, parts = edges.count(), 1

    def lot(of: int):
        return F.floor(F.col("place") * of / n).cast("long")

    while parts * chunk < n:
        parts *= 2
        light, heavy = edges.filter(lot(parts) % 2 == 0), edges.filter(lot(parts) % 2 == 1)
        groups = connected_components(light.select("a", "b"), chunk)
        last = light.join(groups, light.a == groups.node).groupBy("component").agg((-1 - F.max("place")).alias("name"))
        named = settle(groups.join(last, "component").select("node", "name"), "named")
        sums = named.join(nodes, "node").groupBy("name").agg(F.sum("size").alias("size"), F.min("reach").alias("reach"))
        # A group that is whole already was named before, with the same size.
        nodes = nodes.union(sums).dropDuplicates(["node"])
        inner = _relabel(heavy, named.withColumnRenamed("name", "component"))
        edges = settle(light.unionByName(inner), "ranges")
        nodes = settle(nodes.join(_used(edges).select("node"), "node", "left_semi"), "range-nodes")

    def join_up(e: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        e = e.sort_values("place")
        at = {node: k for k, node in enumerate(v["node"].tolist())}
        up, size, reach = list(range(len(at))), v["size"].tolist(), v["reach"].tolist()

        def find(k: int) -> int:
            while up[k] != k:
                up[k] = up[up[k]]
                k = up[k]
            return k

        left, right = [], []  # size and reach
        for a, b in zip(e["a"].tolist(), e["b"].tolist()):
            i, j = find(at[a]), find(at[b])
            left.append((size[i], reach[i]))
            right.append((size[j], reach[j]))
            up[j] = i
            size[i] += size[j]
            reach[i] = min(reach[i], reach[j])
        ends = {f"{what}_{end}": [s[n] for s in side] for n, what in enumerate(("size", "reach")) for end, side in (("x", left), ("y", right))}
        return e[["x", "y", "w", "place"]].assign(**ends)

    members = _used(edges.withColumn("lot", lot(parts)), "lot").join(nodes, "node")
    return settle(edges.withColumn("lot", lot(parts)).groupBy("lot").cogroup(members.groupBy("lot")).applyInPandas(
        join_up, "x long, y long, w double, place long, size_x long, size_y long, reach_x double, reach_y double"), "merge-sizes")


def _used(edges: DataFrame, *more: str) -> DataFrame:
    return edges.select(F.col("a").alias("node"), *more).union(edges.select(F.col("b").alias("node"), *more)).distinct()

"""Hierarchical density clustering with noise over a neighbour graph.

The steps of the published hierarchy (Campello et al., 2013), each as a Spark job over tables:

1. Different vectors become nodes; each is joined to its ``GRAPH_K`` nearest (``neighbor_graph``).
2. An edge weighs the largest of its length and the core distances of its ends, where a core
   distance reaches ``min_samples`` other points, copies included.
3. Least-edge rounds give the minimum spanning forest. Its edges that no pair outside the graph can undercut stay; what
   they leave apart is joined by the lightest edges of all pairs, so the tree is that of all distances.
4. Edges in order of weight join the points up; ``merge_sizes`` finds what size each side then has.
   An edge between two sides of ``min_cluster_size`` points or more is a split. Every other point
   lands, at the weight at which its side first belongs to so many points.
5. Only the splits, at most one for every ``min_cluster_size`` points, come to the driver as a
   tree of candidate clusters; their masses are sums over the points, and the choice by excess of
   mass is joined back.

No step samples, caps or summarises points, and no table of points or edges reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.operators.agreement import agreement, contingency
from ticketmill.operators.boxes import Boxes, Lightest, Rows, frame_of, matrix, reach_out
from ticketmill.operators.centroids import noise_summary
from ticketmill.operators.graphs import CHUNK, connected_components, merge_sizes, spanning_forest
from ticketmill.operators.neighbors import Graph, Tiles, neighbor_graph, paired, spread, tiled
from ticketmill.operators.tickets import top_per_group
from ticketmill.session import join_checked, settle

# --- Fixed values ------------------------------------------------------------
MIN_SAMPLES = 5
MIN_CLUSTER_SIZE = 20
MIN_CLUSTER_SHARE = 0.03
# -----------------------------------------------------------------------------
GRAPH_K = 15


def default_min_cluster_size(n: int) -> int:
    return max(MIN_CLUSTER_SIZE, int(n * MIN_CLUSTER_SHARE))


def core_distances(graph: Graph, min_samples: int) -> DataFrame:
    """node, weight, rid, v, core: the distance within which ``min_samples`` other points lie, reach: that of the last neighbour.

    A node with fewer neighbours than that in the graph takes its farthest one. The reach of one that neighbours all others is infinite.
    """
    others = graph.nodes.count() - 1
    weights = graph.nodes.select(F.col("node").alias("nid"), F.col("weight").alias("theirs"))
    so_far = F.sum("theirs").over(Window.partitionBy("node").orderBy("distance", "nid"))
    reached = graph.near.join(weights, "nid").withColumn("seen", so_far).groupBy("node").agg(
        F.min(F.struct(F.col("seen"), F.col("distance"))).alias("first"),
        F.sort_array(F.collect_list(F.struct("seen", "distance"))).alias("steps"))
    need = F.lit(min_samples) - F.col("weight") + 1
    enough = F.filter("steps", lambda s: s["seen"] >= need)
    core = F.when(need <= 0, 0.0).otherwise(F.coalesce(
        F.get(enough, 0)["distance"], F.array_max("steps")["distance"], F.lit(0.0)))
    far = F.coalesce(F.array_max("steps")["distance"], F.lit(0.0))
    reach = F.when(F.size(F.coalesce("steps", F.array())) >= others, float("inf")).otherwise(far)
    return settle(graph.nodes.join(reached, "node", "left").select(
        "node", "weight", "rid", "v", core.alias("core"), reach.alias("reach")), "core")


def _lightest_out(tiles: Tiles, trees: DataFrame) -> DataFrame:
    """tree, w, x, y: the lightest edge of every tree to a node of another one, if it weighs less than the tree's ``bound``.

    ``trees`` holds node, core, reach, tree, bound. Exact: rows meet as in the neighbour search, tile by tile, and stay apart only where
    a bound on their distance, or the reach of one, allows no lighter edge.
    """
    most = trees.agg(F.max("bound")).first()[0]
    rows = tiles.rows.join(trees.withColumnRenamed("node", "rid"), "rid").filter(F.col("reach") < most)
    need = F.when(F.col("reach") < F.col("bound"), F.col("bound")).otherwise(float("-inf")).alias("need")
    fields = ("rid", "v", "cell", "tile", "core", "reach", "tree", "bound")

    def search(held: pa.Table) -> pa.Table:
        x, tile, names = matrix(held["v"]), held["tile"].to_numpy(), held["tree"].to_numpy()
        names, tree = np.unique(names, return_inverse=True)
        bound = np.empty(len(names))
        bound[tree] = held["bound"].to_numpy()
        best, frame, sides = Lightest(bound), frame_of(x), []
        for t in np.unique(tile):
            at = np.flatnonzero(tile == t)
            sides.append((Boxes(x[at], frame), Rows(held["rid"].to_numpy()[at], held["core"].to_numpy()[at], held["reach"].to_numpy()[at], tree[at])))
        # One tile searches itself, two each other.
        for mine, theirs in ((sides[0], sides[-1]), (sides[-1], sides[0]))[:len(sides)]:
            if len(sides) > 1 or "pair" not in held.column_names:
                reach_out(*mine, *theirs, best)
        got = np.flatnonzero(best.y >= 0)
        return pa.table({"tree": names[got], "w": best.w[got], "x": best.x[got], "y": best.y[got]})

    found = "tree long, w double, x long, y long"
    own = settle(spread(rows.select(*fields), "tile", len(tiles.cells)).groupBy("tile").applyInArrow(search, found), "spans")
    if len(tiles.cells) > 1:
        known = settle(own.groupBy("tree").agg(F.min("w").alias("known")), "known")
        nearer = join_checked(rows, known, "tree", "left", 16).withColumn("bound", F.least("bound", F.coalesce("known", "bound")))
        met = paired(tiles, nearer.select(*fields, need)).groupBy("pair").applyInArrow(search, found)
        own = own.union(met)
    return settle(own.groupBy("tree").agg(F.min(F.struct("w", "x", "y")).alias("e")).select("tree", "e.*"), "lightest")


def _merges(forest: DataFrame, nodes: DataFrame, chunk: int) -> DataFrame:
    """The merges of the spanning tree that all pairs of ``nodes`` have, from the ``forest`` of their neighbour graph.

    A pair that the graph does not hold weighs no less than the ``reach`` of either node. So an edge of the forest no heavier than
    the least reach on one of its sides is sure. What the sure ones leave apart is joined in rounds, each tree by its lightest edge
    to any other node: one of the forest or one that the graph does not hold, searched for below the former's weight.
    """
    merges = merge_sizes(forest, nodes, chunk)
    sure = F.greatest("reach_x", "reach_y") >= F.col("w")
    kept = merges.filter(sure).select("x", "y", "w")
    spare = merges.filter(~sure).select("x", "y", "w", F.lit(0).alias("found"))
    joined = connected_components(kept.select(F.col("x").alias("a"), F.col("y").alias("b")), chunk)
    trees = settle(nodes.join(joined, "node", "left").select("node", "core", "reach", F.coalesce("component", "node").alias("tree")), "trees")
    if trees.select("tree").distinct().limit(2).count() < 2:
        return merges
    tiles = tiled(nodes.select(F.col("node").alias("rid"), "v"))
    while trees.select("tree").distinct().limit(2).count() == 2:
        ends = [trees.select(F.col("node").alias(n), F.col("tree").alias(e)) for n, e in (("x", "a"), ("y", "b"))]
        spare = settle(spare.join(ends[0], "x").join(ends[1], "y").filter("a <> b").select("x", "y", "w", "found", "a", "b"), "spare")
        edge = F.struct("w", "found", "x", "y")
        known = settle(spare.select(F.col("a").alias("tree"), edge.alias("e")).union(spare.select(F.col("b").alias("tree"), edge.alias("e"))).groupBy(
            "tree").agg(F.min("e").alias("e")), "known")
        asked = trees.join(known.select("tree", F.col("e.w").alias("bound")), "tree", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
        found = _lightest_out(tiles, settle(asked.select("node", "core", "reach", "tree", "bound"), "asked"))
        best = known.union(found.select("tree", F.struct("w", F.lit(1).alias("found"), "x", "y").alias("e"))).groupBy("tree").agg(F.min("e").alias("e"))
        picked = best.select("e.x", "e.y", "e.w", "e.found").distinct().join(ends[0], "x").join(ends[1], "y").groupBy(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min(edge).alias("e")).select("a", "b", "e.*")
        picked = settle(picked, "picked")
        links = spanning_forest(picked.select("a", "b", "w"), chunk).select(F.col("x").alias("a"), F.col("y").alias("b"))
        kept = settle(kept.union(picked.join(links, ["a", "b"]).select("x", "y", "w")), "kept")
        spare = spare.select("x", "y", "w", "found").union(found.select("x", "y", "w", F.lit(1).alias("found"))).distinct()
        joined = connected_components(links, chunk).select(F.col("node").alias("tree"), "component")
        trees = settle(trees.join(joined, "tree", "left").select("node", "core", "reach", F.coalesce("component", "tree").alias("tree")), "trees")
    return merge_sizes(kept, nodes, chunk)


@dataclass
class Hierarchy:
    """``merges`` (x, y, w, place, size_x, size_y) in order of weight, over ``nodes`` (node, weight, rid, core)."""

    graph: Graph
    nodes: DataFrame
    merges: DataFrame
    points: int
    floor: float


def hierarchy(graph: Graph, min_samples: int = MIN_SAMPLES, chunk: int = CHUNK) -> Hierarchy:
    """The whole merge tree of a neighbour graph; every ``min_cluster_size`` can be read from it."""
    nodes = core_distances(graph, min_samples)
    ends = graph.near.select(F.least("node", "nid").alias("a"), F.greatest("node", "nid").alias("b"), "distance")
    ca, cb = (nodes.select(F.col("node").alias(e), F.col("core").alias(f"c{e}")) for e in "ab")
    edges = ends.join(ca, "a").join(cb, "b").select("a", "b", F.greatest("distance", "ca", "cb").alias("w"))
    merges = _merges(spanning_forest(edges, chunk), nodes, chunk)
    points = nodes.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    least = merges.filter("w > 0").agg(F.min("w")).first()[0]
    return Hierarchy(graph, nodes, merges, points, (least or 1.0) * 1e-3)


def _landed(h: Hierarchy, least: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """The splits (w, place, ax, ay), and where every node lands: node, weight, rid, stretch, at (place), level.

    A stretch is what hangs together without the splits; within one, points land one side at a
    time on a single growing group.
    """
    x_big, y_big = F.col("size_x") >= least, F.col("size_y") >= least
    merges = h.merges
    together = connected_components(merges.filter(~(x_big & y_big)).select(F.col("x").alias("a"), F.col("y").alias("b")), chunk)
    small = connected_components(merges.filter(F.col("size_x") + F.col("size_y") < least).select(F.col("x").alias("a"), F.col("y").alias("b")), chunk)
    lands = merges.filter(F.col("size_x") + F.col("size_y") >= least)
    sides = lands.filter(~x_big).select(F.col("x").alias("node"), "place", "w").union(
        lands.filter(~y_big).select(F.col("y").alias("node"), "place", "w"))
    small = small.withColumnRenamed("component", "side")
    landing = sides.join(small, "node", "left").select(F.coalesce("side", "node").alias("side"), "place", "w")
    named = h.nodes.select("node", "weight", "rid", "core").join(small, "node", "left").withColumn("side", F.coalesce("side", "node"))
    big = F.col("weight") >= least
    placed = named.join(landing, "side", "left").join(together, "node", "left").select(
        "node", "weight", "rid", F.coalesce("component", "node").alias("stretch"),
        F.when(big, -1).otherwise(F.col("place")).alias("at"), F.when(big, F.col("core")).otherwise(F.col("w")).alias("level"))
    placed = settle(placed.filter("at IS NOT NULL"), "landed")
    own = placed.select("node", "stretch")
    splits = merges.filter(x_big & y_big).join(own.toDF("x", "ax"), "x").join(own.toDF("y", "ay"), "y").select("w", "place", "ax", "ay")
    return splits, placed


def labels_of(h: Hierarchy, least: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """id and cluster_id by excess of mass; -1 is noise, clusters are numbered by falling size, then smallest id."""
    least = least or default_min_cluster_size(h.points)
    spark = h.nodes.sparkSession
    splits, placed = _landed(h, least, chunk)
    tree = sorted(splits.collect(), key=lambda r: r["place"])  # at most points / least rows
    if not tree:
        return h.graph.members.select("id", F.lit(-1).cast("long").alias("cluster_id"))

    def density(level: float) -> float:
        return 1.0 / max(level, h.floor)

    # Candidates: every stretch, and every joining of two. ``bottom`` is where one falls apart, ``top`` where it is born.
    current: dict[int, int] = {}
    stretches: list[int] = []
    kids: list[tuple[int, ...]] = []
    bottom: list[tuple[int, float]] = []
    top: list[tuple[int, float]] = []
    parent: list[int] = []
    up: dict[int, int] = {}

    def root(s: int) -> int:
        while up.setdefault(s, s) != s:
            up[s] = up[up[s]]
            s = up[s]
        return s

    def candidate(below: tuple[int, ...], at: tuple[int, float]) -> int:
        kids.append(below)
        bottom.append(at)
        top.append((np.iinfo(np.int64).max, np.inf))
        parent.append(-1)
        return len(kids) - 1

    for r in tree:
        pair = []
        for s in (r["ax"], r["ay"]):
            if s not in up:
                up[s] = s
                stretches.append(s)
                current[s] = candidate((), (-2, 0.0))
            pair.append(root(s))
        two = tuple(current[s] for s in pair)
        new = candidate(two, (r["place"], r["w"]))
        for c in two:
            top[c], parent[c] = (r["place"], r["w"]), new
        up[pair[1]] = pair[0]
        current[pair[0]] = new

    leaf_of = {}
    for c, s in zip((c for c in range(len(kids)) if not kids[c]), stretches):
        leaf_of[s] = c
    rows = []
    for s, c in leaf_of.items():
        while c != -1:
            rows.append((s, c, bottom[c][0], top[c][0]))
            c = parent[c]
    spans = settle(spark.createDataFrame(pd.DataFrame(rows, columns=["stretch", "candidate", "low", "high"])), "spans")
    within = join_checked(placed, spans, "stretch", "inner", 40).filter("at > low AND at < high")
    within = settle(within.select("node", "weight", "rid", "level", "candidate"), "within")
    mass = within.groupBy("candidate").agg(
        F.sum("weight").alias("n"), F.sum(F.col("weight") / F.greatest("level", F.lit(h.floor))).alias("left"), F.min("rid").alias("first"))
    n, left, first = np.zeros(len(kids)), np.zeros(len(kids)), np.full(len(kids), np.iinfo(np.int64).max)
    for r in mass.collect():
        n[r["candidate"]], left[r["candidate"]], first[r["candidate"]] = r["n"], r["left"], r["first"]

    # Children stand before parents. A cluster at least as massive as its best descendants is chosen; a root never is.
    best, chosen = np.zeros(len(kids)), np.zeros(len(kids), bool)
    for c in range(len(kids)):
        below = sum(n[k] for k in kids[c])
        own = left[c] + below * density(bottom[c][1]) - (n[c] + below) * (0.0 if parent[c] < 0 else density(top[c][1]))
        n[c] += below
        for k in kids[c]:
            first[c] = min(first[c], first[k])
        rest = sum(best[k] for k in kids[c])
        chosen[c] = parent[c] >= 0 and not (kids[c] and rest > own)
        best[c] = own if chosen[c] else rest
    label, picked = np.full(len(kids), -1, np.int64), []
    for c in reversed(range(len(kids))):  # parents first
        if parent[c] >= 0 and label[parent[c]] >= 0:
            label[c] = label[parent[c]]
        elif chosen[c]:
            label[c] = c
            picked.append((-n[c], first[c], c))
    number = {c: k for k, (_, _, c) in enumerate(sorted(picked))}
    names = settle(spark.createDataFrame(pd.DataFrame({
        "candidate": np.arange(len(kids)), "cluster_id": [number.get(x, -1) for x in label.tolist()]})), "names")
    labelled = join_checked(within, names, "candidate", "inner", 16).select("node", "cluster_id")
    return h.graph.members.join(labelled, "node", "left").select(
        "id", F.coalesce("cluster_id", F.lit(-1)).cast("long").alias("cluster_id"))


def density_cluster(
    df: DataFrame, id_col: str, vec: str, min_cluster_size: int | None = None,
    min_samples: int = MIN_SAMPLES, k: int = GRAPH_K, method: str = "exact", chunk: int = CHUNK,
) -> DataFrame:
    """id and cluster_id of every row with a vector; -1 is noise, clusters are numbered by falling size."""
    graph = neighbor_graph(df, id_col, vec, max(k, min_samples), method=method)
    return labels_of(hierarchy(graph, min_samples, chunk), min_cluster_size, chunk).withColumnRenamed("id", id_col)


def stability_runs(
    df: DataFrame, id_col: str, vec: str, configs: list[tuple[int | None, int]], k: int = GRAPH_K,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One clustering per (min_cluster_size, min_samples), all over one neighbour graph and one merge tree per min_samples.

    Gives the runs (run, sizes, noise), their agreement pair by pair (first, second, points, adjusted_rand),
    and what becomes of each cluster (first, second, cluster_id, members, partner, kept: the largest
    share of its members that one cluster of the other run holds).
    """
    graph = neighbor_graph(df, id_col, vec, max(k, *(s for _, s in configs)))
    trees = {s: hierarchy(graph, s) for s in sorted({s for _, s in configs})}
    runs = [settle(labels_of(trees[s], size), "run") for size, s in configs]
    summary = pairs = fates = None
    for i, ((size, samples), run) in enumerate(zip(configs, runs)):
        row = noise_summary(run).withColumns({
            "run": F.lit(i).cast("long"), "min_cluster_size": F.lit(size).cast("long"), "min_samples": F.lit(samples).cast("long")})
        summary = row if summary is None else summary.unionByName(row)
        for j in range(len(runs)):
            if i == j:
                continue
            both = run.join(runs[j].withColumnRenamed("cluster_id", "other"), "id")
            table = settle(contingency(both, "cluster_id", "other"), "contingency")
            marks = {"first": F.lit(i).cast("long"), "second": F.lit(j).cast("long")}
            if i < j:
                one = agreement(table, "cluster_id", "other").withColumns(marks)
                pairs = one if pairs is None else pairs.unionByName(one)
            held = table.filter("cluster_id >= 0")
            size_of = held.groupBy("cluster_id").agg(F.sum("n").alias("members"))
            fate = top_per_group(held.filter("other >= 0"), "cluster_id", [F.col("n").desc(), F.col("other")], 1).select(
                "cluster_id", F.col("other").alias("partner"), "n")
            fate = size_of.join(fate, "cluster_id", "left").select(
                "cluster_id", "members", "partner", (F.coalesce("n", F.lit(0)) / F.col("members")).alias("kept")).withColumns(marks)
            fates = fate if fates is None else fates.unionByName(fate)
    return summary, pairs, fates

"""Connected components of an edge table, by contraction.

Each round points every node to its smallest neighbour, follows pointers to the roots,
and rebuilds the edges between roots, so the edge table shrinks geometrically in practice.
Only joins and grouped minima run; the driver sees one count a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of a sortable type to (node, component): the smallest node reachable.

    Direction, repeats and loops do not matter; nulls are ignored. Nodes without an edge to
    another node may be missing from the result, and are their own component.
    """
    clean = edges.select("a", "b").filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    # Larger end first: the smaller end is the candidate root.
    live = settle(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    done: DataFrame | None = None
    while True:
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        parent = settle(least.select(F.col("a").alias("node"), F.least("a", "m").alias("up")), "parents")
        while True:  # follow pointers; they only fall, so this ends after log(depth) rounds
            higher = parent.select(F.col("node").alias("up"), F.col("up").alias("upper"))
            step = settle(
                parent.join(higher, "up").select("node", "upper", (F.col("upper") < F.col("up")).alias("moved")), "parents"
            )
            moved = step.agg(F.max("moved")).first()[0]
            parent = step.select("node", F.col("upper").alias("up"))
            if not moved:
                break
        if done is None:
            done = parent
        else:
            onward = parent.select(F.col("node").alias("up"), F.col("up").alias("next"))
            done = done.join(onward, "up", "left").select("node", F.coalesce("next", "up").alias("up"))
        root_a = parent.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        root_b = parent.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        across = live.join(root_a, "a").join(root_b, "b").filter(F.col("ra") != F.col("rb"))
        live = settle(
            across.select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct(), "edges"
        )
        if live.isEmpty():
            return done.select("node", F.col("up").alias("component"))

"""Cluster quality: Euclidean silhouette (exact), its squared form (linear), noise ratio."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import vectors as V
from ticketmill.operators.centroids import every, matrix_if_small, nearest_rows, nearest_tiled, pairwise, stack
from ticketmill.session import BROADCAST_BYTES, settle

TILE_ROWS = 8192


def silhouette_points(
    points: DataFrame, id_col: str, vec: str, label: str = "cluster_id", tile_rows: int = TILE_ROWS
) -> DataFrame:
    """Exact Euclidean silhouette per non-noise point: id, cluster_id, silhouette.

    A mean of distances has no closed form, so the arithmetic is quadratic in the
    number of distinct vectors; at very large scale use ``squared_silhouette``. What
    moves is bounded all the same: copies of a vector collapse to one weighted row,
    hashed tiles meet in groups of about ``tile_rows`` by ``tile_rows``, and a meeting
    emits one sum per (vector, cluster), never a pair.
    """
    kept = points.filter(F.col(label) >= 0).select(
        F.col(id_col).alias("id"), F.col(label).cast("long").alias("c"),
        V.as_doubles(F.col(vec)).alias("v"),
    )
    kept = kept.withColumn("h", F.sha2(F.to_json("v"), 256))
    weighted = kept.groupBy("h", "c").agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("w"))
    tiles = max(1, -(-weighted.count() // tile_rows))
    spread = every(F.lit(tiles))
    own = F.pmod(F.xxhash64("h", "c"), F.lit(tiles))
    left = weighted.select("h", "c", "v", own.alias("lt"), spread.alias("rt"))
    right = weighted.select("c", "v", "w", own.alias("rt"), spread.alias("lt"))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"h": [], "c": [], "oc": [], "total": [], "n": []})
        names, code = np.unique(b["c"].to_numpy(), return_inverse=True)
        member = np.zeros((len(b), len(names)))
        member[np.arange(len(b)), code] = b["w"].to_numpy()
        x, y = stack(a["v"]), stack(b["v"])
        # Row blocks keep the distance matrix small whatever the tile size.
        sums = np.vstack([pairwise(x[i:i + 1024], y) @ member for i in range(0, len(x), 1024)])
        k = len(names)
        return pd.DataFrame({
            "h": np.repeat(a["h"].to_numpy(), k), "c": np.repeat(a["c"].to_numpy(), k),
            "oc": np.tile(names, len(a)), "total": sums.ravel(),
            "n": np.tile(member.sum(0), len(a)).astype(np.int64),
        })

    met = left.groupBy("lt", "rt").cogroup(right.groupBy("lt", "rt")).applyInPandas(
        meet, "h string, c long, oc long, total double, n long"
    )
    per = met.groupBy("h", "c", "oc").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    same = F.col("oc") == F.col("c")
    ab = per.groupBy("h", "c").agg(
        # A point's distance to itself is 0, so only the divisor leaves it out.
        F.max(F.when(same & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~same, F.col("total") / F.col("n"))).alias("b"),
    )
    scored = ab.select(
        "h", "c",
        F.when(F.col("b").isNull(), F.lit(None).cast("double"))
        .when(F.col("a").isNull(), F.lit(0.0))
        .otherwise(F.coalesce(
            F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)
        )).alias("silhouette"),
    )
    return kept.select("id", "c", "h").join(scored, ["h", "c"]).select(
        F.col("id").alias(id_col), F.col("c").alias("cluster_id"), "silhouette"
    )


def squared_silhouette(
    points: DataFrame, vec: str, label: str = "cluster_id", limit_bytes: int = BROADCAST_BYTES,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Mean silhouette under squared Euclidean distance; linear in the data.

    Mean squared distance to a cluster follows from its size, mean and mean square:
    E|x-y|^2 = |x - mean|^2 + (E|y|^2 - |mean|^2). The bracket is the cluster's spread;
    as one more coordinate of its centre it turns the search for the best other
    cluster into a nearest-centroid search. Not equal to the Euclidean score.
    """
    kept = points.filter(F.col(label) >= 0).select(
        F.col(label).cast("long").alias("c"), V.as_doubles(F.col(vec)).alias("v")
    )
    moments = settle(
        kept.groupBy("c").agg(
            F.count(F.lit(1)).alias("n"), V.mean_vector(F.col("v")).alias("m"),
            F.avg(V.squared_norm(F.col("v"))).alias("q"),
        ).select(
            F.col("c").alias("cluster_id"), "n",
            F.concat("m", F.array(F.sqrt(F.greatest(
                F.col("q") - V.squared_norm(F.col("m")), F.lit(0.0)
            )))).alias("centroid"),
        ),
        "moments",
    )
    lifted = kept.select("c", F.concat("v", F.array(F.lit(0.0))).alias("v"))
    small = matrix_if_small(moments, "cluster_id", "centroid", limit_bytes)
    if small is not None:
        keys, centres = small
        sizes = {r["cluster_id"]: r["n"] for r in moments.select("cluster_id", "n").collect()}
        shipped = points.sparkSession.sparkContext.broadcast(
            (keys, centres, np.array([sizes[k] for k in keys], dtype=float))
        )

        def two_distances(batches):
            keys, centres, n = shipped.value
            for b in batches:
                if b.empty or len(keys) < 2:
                    continue
                x, c = stack(b["v"]), b["c"].to_numpy()
                at = np.searchsorted(keys, c)
                other = nearest_rows(x, centres, c, keys)[1]
                yield pd.DataFrame({
                    "own": ((x - centres[at]) ** 2).sum(1), "n": n[at].astype(np.int64), "b": other ** 2,
                })

        scored = lifted.mapInPandas(two_distances, "own double, n long, b double")
    else:
        keyed = settle(lifted.withColumn("_id", F.monotonically_increasing_id()), "lifted")
        other = nearest_tiled(keyed, moments, "_id", "v", tile_rows, own="c")
        # AQE splits a cluster that holds a large share of the points.
        scored = keyed.join(moments, F.col("c") == F.col("cluster_id")).select(
            "_id", "n", V.squared_distance(F.col("v"), F.col("centroid")).alias("own")
        ).join(other.select("_id", (F.col("distance") * F.col("distance")).alias("b")), "_id").filter(
            F.col("b") < float("inf")
        )
    a = F.when(F.col("n") > 1, F.col("own") * F.col("n") / (F.col("n") - 1))
    s = F.when(a.isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - a, F.greatest(a, F.col("b"))), F.lit(0.0))
    )
    return scored.agg(F.avg(s).alias("squared_silhouette"))


def noise_ratio(points: DataFrame, label: str = "cluster_id") -> DataFrame:
    """Share of noise, 4 dp; 1.0 if fewer than two points are clustered."""
    return points.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) < 0).alias("noise")
    ).select(
        F.when(F.col("n") - F.col("noise") < 2, F.lit(1.0))
        .otherwise(F.round(F.try_divide("noise", "n"), 4)).alias("noise_ratio")
    )


def cluster_metrics(
    points: DataFrame, id_col: str, vec: str, label: str = "cluster_id", tile_rows: int = TILE_ROWS
) -> DataFrame:
    """silhouette_score (exact, 4 dp) and noise_ratio (4 dp).

    (0, 1) if fewer than two points are clustered; a null score if all clustered
    points share one label.
    """
    score = silhouette_points(points, id_col, vec, label, tile_rows).agg(
        F.count(F.lit(1)).alias("k"), F.avg("silhouette").alias("s")
    )
    joined = score.select("k", "s", F.lit(1).alias("_one")).join(
        F.broadcast(noise_ratio(points, label).withColumn("_one", F.lit(1))), "_one"
    )
    return joined.select(
        F.when(F.col("k") < 2, F.lit(0.0)).otherwise(F.round("s", 4)).alias("silhouette_score"),
        "noise_ratio",
    )

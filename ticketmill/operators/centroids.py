"""Centroids, distances to them, and nearest-centroid search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import vectors as V
from ticketmill.operators.tickets import non_noise
from ticketmill.session import BROADCAST_BYTES, settle

# Rows of points and of centroids that one shuffled group holds at most (on average).
TILE_ROWS = 8192
# Entries of the largest distance matrix a task holds at a time (32 MB).
MATRIX_CELLS = 4_000_000


def centroids(points: DataFrame, vec: str, label: str = "cluster_id") -> DataFrame:
    """Mean vector and size per cluster, noise left out."""
    return (
        points.filter(F.col(label) >= 0)
        .groupBy(F.col(label).cast("long").alias("cluster_id"))
        .agg(V.mean_vector(V.as_doubles(F.col(vec))).alias("centroid"), F.count(F.lit(1)).alias("volume"))
    )


def matrix_if_small(
    df: DataFrame, key: str, vec: str, limit_bytes: int = BROADCAST_BYTES
) -> tuple[np.ndarray, np.ndarray] | None:
    """Keys and vectors on the driver, or None if they exceed ``limit_bytes``.

    The size is worked out from a count and a width before anything is collected.
    """
    size = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vec)).alias("d")).first()
    if size["n"] * ((size["d"] or 0) + 1) * 8 > limit_bytes:
        return None
    rows = df.select(key, vec).orderBy(key).collect()
    keys = np.array([r[0] for r in rows], dtype=np.int64)
    return keys, np.array([r[1] for r in rows], dtype=np.float64).reshape(len(rows), size["d"] or 0)


def every(count: Column) -> Column:
    """One row per tile number below ``count``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long") - 1))


def stack(column: pd.Series) -> np.ndarray:
    """A column of equal-length arrays as a matrix."""
    return np.stack(column.to_numpy()).astype(np.float64)


def pairwise(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of two matrices."""
    sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    out = np.sqrt(np.maximum(sq, 0.0))
    # The expanded square loses digits near zero; redo those few entries directly.
    close = np.argwhere(sq < 1e-6 * (1.0 + (a * a).sum(1)[:, None]))
    if len(close):
        i, j = close[:, 0], close[:, 1]
        out[i, j] = np.sqrt(((a[i] - b[j]) ** 2).sum(1))
    return out


def nearest_rows(
    x: np.ndarray, centres: np.ndarray, own: np.ndarray | None = None, ids: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Index of and distance to each row's nearest centre, in blocks of bounded memory.

    With ``own`` and ``ids``, a centre whose id is the row's own is passed over.
    """
    step = max(1, MATRIX_CELLS // max(1, len(centres)))
    at, dist = np.empty(len(x), dtype=np.int64), np.empty(len(x))
    for i in range(0, len(x), step):
        d = pairwise(x[i:i + step], centres)
        if own is not None:
            d[own[i:i + step, None] == ids[None, :]] = np.inf
        a = d.argmin(1)
        at[i:i + len(a)], dist[i:i + len(a)] = a, d[np.arange(len(a)), a]
    return at, dist


def _nearest_small(points: DataFrame, id_col: str, vec: str, keys: np.ndarray, matrix: np.ndarray) -> DataFrame:
    shipped = points.sparkSession.sparkContext.broadcast((keys, matrix))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, centres = shipped.value
        for batch in batches:
            if batch.empty:
                continue
            at, dist = nearest_rows(stack(batch["v"]), centres)
            yield pd.DataFrame({id_col: batch[id_col], "cluster_id": ids[at], "distance": dist})

    return points.select(id_col, V.as_doubles(F.col(vec)).alias("v")).mapInPandas(
        find, f"{id_col} long, cluster_id long, distance double"
    )


def nearest_tiled(
    points: DataFrame, cents: DataFrame, id_col: str, vec: str, tile_rows: int = TILE_ROWS,
    own: str | None = None,
) -> DataFrame:
    """Exact search for a centroid set too large to ship.

    Centroids are cut into tiles; each point meets every tile once, in groups of
    bounded size, and each meeting yields one row: that tile's nearest centroid.
    With ``own``, a point's own cluster is passed over.
    """
    n_c = max(1, -(-cents.count() // tile_rows))
    n_p = max(1, -(-points.count() // tile_rows))
    p = points.select(
        id_col, V.as_doubles(F.col(vec)).alias("v"),
        (F.lit(None).cast("long") if own is None else F.col(own).cast("long")).alias("own"),
        F.pmod(F.xxhash64(id_col), F.lit(n_p)).alias("pt"),
        every(F.lit(n_c)).alias("ct"),
    )
    c = cents.select(
        "cluster_id", F.col("centroid").alias("v"),
        F.pmod(F.xxhash64("cluster_id"), F.lit(n_c)).alias("ct"),
        every(F.lit(n_p)).alias("pt"),
    )

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({id_col: [], "cluster_id": [], "distance": []})
        right = right.sort_values("cluster_id")
        ids = right["cluster_id"].to_numpy()
        skip = None if own is None else left["own"].to_numpy()
        at, dist = nearest_rows(stack(left["v"]), stack(right["v"]), skip, ids)
        return pd.DataFrame({id_col: left[id_col], "cluster_id": ids[at], "distance": dist})

    met = p.groupBy("pt", "ct").cogroup(c.groupBy("pt", "ct")).applyInPandas(
        meet, f"{id_col} long, cluster_id long, distance double"
    )
    best = met.groupBy(id_col).agg(F.min(F.struct("distance", "cluster_id")).alias("b"))
    return best.select(id_col, "b.cluster_id", "b.distance")


def nearest_centroid(
    points: DataFrame, cents: DataFrame, id_col: str, vec: str,
    limit_bytes: int = BROADCAST_BYTES, tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """id, cluster_id, distance of the nearest centroid; ties go to the lowest cluster.

    Point-by-centroid pairs are never materialised. If the measured centroid matrix
    is small it is shipped and every point is settled in a narrow pass; otherwise
    the tiled, shuffled search gives the same result. No centroids give no rows.
    """
    small = matrix_if_small(cents, "cluster_id", "centroid", limit_bytes)
    if small is None:
        return nearest_tiled(points, cents, id_col, vec, tile_rows)
    if len(small[0]) == 0:
        return points.select(
            F.col(id_col).cast("long"), F.lit(None).cast("long").alias("cluster_id"),
            F.lit(None).cast("double").alias("distance"),
        ).filter(F.lit(False))
    return _nearest_small(points, id_col, vec, *small)


def distance_to_centroid(
    points: DataFrame, id_col: str, vec: str, label: str = "cluster_id",
    limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Adds ``distance_to_centroid``: own centroid, or the nearest one for noise.

    0.0 everywhere if there are no clusters. Centroids are worked out once.
    """
    cents = settle(centroids(points, vec, label), "centroids")
    small = matrix_if_small(cents, "cluster_id", "centroid", limit_bytes)
    out = "distance_to_centroid"
    if small is not None:
        shipped = points.sparkSession.sparkContext.broadcast(small)

        @F.pandas_udf("double")
        def measure(v: pd.Series, label_values: pd.Series) -> pd.Series:
            keys, matrix = shipped.value
            if len(keys) == 0 or len(v) == 0:
                return pd.Series(np.zeros(len(v)))
            x, own = stack(v), label_values.to_numpy()
            dist = np.empty(len(x))
            noise = own < 0
            if noise.any():
                dist[noise] = nearest_rows(x[noise], matrix)[1]
            at = np.searchsorted(keys, own[~noise])
            dist[~noise] = np.sqrt(((x[~noise] - matrix[at]) ** 2).sum(1))
            return pd.Series(dist)

        return points.withColumn(out, measure(V.as_doubles(F.col(vec)), F.col(label).cast("long")))
    # Too many centroids to ship: an ordinary join (AQE splits a hot cluster) plus the
    # tiled search for noise.
    own = points.filter(F.col(label) >= 0).join(
        cents.select(F.col("cluster_id").alias("_cid"), "centroid"), F.col(label) == F.col("_cid")
    ).withColumn(out, V.distance(V.as_doubles(F.col(vec)), F.col("centroid"))).drop("_cid", "centroid")
    noise = points.filter(F.col(label) < 0)
    near = nearest_centroid(noise, cents, id_col, vec, limit_bytes).select(
        id_col, F.col("distance").alias(out)
    )
    return own.unionByName(noise.join(near, id_col))


def cluster_stats(clusters: DataFrame) -> DataFrame:
    """Volume and average, least and greatest distance per cluster, largest first."""
    d = F.col("distance_to_centroid")
    return (
        non_noise(clusters)
        .groupBy("cluster_id")
        .agg(
            F.count(F.lit(1)).alias("volume"), F.avg(d).alias("avg_distance"),
            F.min(d).alias("min_distance"), F.max(d).alias("max_distance"),
        )
        .orderBy(F.desc("volume"), "cluster_id")
    )


def noise_summary(clusters: DataFrame, label: str = "cluster_id") -> DataFrame:
    """total_tickets, n_clusters, noise_count, noise_pct (1 dp).

    Clusters are counted from one row per label, not with a wide distinct.
    """
    per = clusters.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    noise = F.coalesce(F.sum(F.when(F.col(label) < 0, F.col("n"))), F.lit(0))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_tickets"),
        F.count_if(F.col(label) >= 0).alias("n_clusters"),
        noise.cast("long").alias("noise_count"),
    ).withColumn(
        "noise_pct",
        F.round(F.coalesce(F.try_divide("noise_count", "total_tickets"), F.lit(0.0)) * 100, 1),
    )

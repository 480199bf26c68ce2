"""Dimension reduction by principal components of unit vectors.

The built-in PCA factors a d x d matrix in pure JVM code on the driver, minutes at
1536 dimensions. Here tasks add up covariance x Q for a thin basis Q, and the driver
only ever factors that thin product (subspace iteration, Halko et al., SIAM Review
2011). Up to ``EXACT_WIDTH`` dimensions Q is the identity and one pass is exact. Up to ``WHOLE_WIDTH``
tasks add up the covariance itself, so one pass over the rows serves all steps of the iteration.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import vectors as V
from ticketmill.operators.boxes import matrix
from ticketmill.operators.centroids import stack

# --- Fixed values ------------------------------------------------------------
CLUSTER_DIMENSIONS = 25
PLOT_DIMENSIONS = 2
SEED = 42
# -----------------------------------------------------------------------------
EXACT_WIDTH = 256
WHOLE_WIDTH = 2048  # 32 MB of covariance for each of ``FAN_IN`` tasks, and on the driver
MAX_PASSES = 60
TOLERANCE = 1e-4  # least relative gain in captured variance that another pass must bring
SPARE = 10  # extra basis columns, which speed up convergence
FAN_IN = 64  # rows that reach the driver per pass, whatever the number of tasks
STRIP_ROWS = 32  # rows of a whole covariance that are added up as one


def _to_unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(norm > 0, norm, 1.0)


def _unit_rows(column: pd.Series) -> np.ndarray:
    return _to_unit(stack(column))


def _times_covariance(vectors: DataFrame, basis: np.ndarray) -> np.ndarray:
    """Covariance x basis of the vectors in column ``v``, scaled to unit length; one pass.

    A task folds its rows into one flat vector; those are added in ``FAN_IN`` groups
    before the last, bounded step on the driver.
    """
    d, width = basis.shape
    shipped = vectors.sparkSession.sparkContext.broadcast(basis)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total, product = 0, np.zeros(d), np.zeros((d, width))
        for b in batches:
            if b.empty:
                continue
            x = _unit_rows(b["v"])
            n += len(x)
            total += x.sum(0)
            product += x.T @ (x @ shipped.value)
        if n:
            yield pd.DataFrame({"flat": [np.concatenate([[n], total, product.ravel()])]})

    parts = vectors.mapInPandas(partial, "flat array<double>")
    grouped = parts.groupBy(F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("g")).agg(
        V.sum_vector(F.col("flat")).alias("flat")
    )
    flat = np.sum([r["flat"] for r in grouped.select("flat").collect()], axis=0)
    n, total, product = flat[0], flat[1:d + 1], flat[d + 1:].reshape(d, width)
    mean = total / n
    return product / n - np.outer(mean, mean @ basis)


def _covariance(vectors: DataFrame, d: int) -> np.ndarray:
    """The whole d x d covariance of the vectors in column ``v``, scaled to unit length; one pass.

    A task folds its rows into one matrix, sent in strips that are added up strip by strip.
    """
    schema = pa.schema([("strip", pa.int64()), ("flat", pa.list_(pa.float64()))])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, product = 0, np.zeros(d), np.zeros((d, d))
        for b in batches:
            if b.num_rows:
                x = _to_unit(matrix(pa.chunked_array([b.column(0)])))
                n += len(x)
                total += x.sum(0)
                product += x.T @ x
        if n:
            yield pa.RecordBatch.from_pydict({"strip": [-1], "flat": [np.concatenate([[n], total])]}, schema)
            for at in range(0, d, STRIP_ROWS):
                yield pa.RecordBatch.from_pydict({"strip": [at], "flat": [product[at:at + STRIP_ROWS].ravel()]}, schema)

    parts = vectors.coalesce(FAN_IN).mapInArrow(partial, "strip long, flat array<double>")
    strips = {r["strip"]: np.array(r["flat"]) for r in parts.groupBy("strip").agg(V.sum_vector(F.col("flat")).alias("flat")).collect()}
    head = strips.pop(-1)
    mean = head[1:] / head[0]
    return np.concatenate([strips[at] for at in sorted(strips)]).reshape(d, d) / head[0] - np.outer(mean, mean)


def principal_axes(vectors: DataFrame, d: int, k: int) -> np.ndarray:
    """The ``k`` leading axes (d x k) of the unit vectors along column ``v``, signs fixed."""
    if d <= EXACT_WIDTH:
        basis = np.eye(d)
        image = _times_covariance(vectors, basis)
    else:
        basis = np.linalg.qr(np.random.default_rng(SEED).normal(size=(d, min(d, k + SPARE))))[0]
        whole = _covariance(vectors, d) if d <= WHOLE_WIDTH else None

        def times(basis: np.ndarray) -> np.ndarray:
            return _times_covariance(vectors, basis) if whole is None else whole @ basis

        image = times(basis)
        captured = 0.0
        for _ in range(MAX_PASSES):
            top = np.sort(np.linalg.eigvalsh((basis.T @ image + image.T @ basis) / 2))[::-1][:k].sum()
            if top <= captured * (1 + TOLERANCE):
                break
            captured = top
            basis = np.linalg.qr(image)[0]
            image = times(basis)
    small = basis.T @ image
    values, turned = np.linalg.eigh((small + small.T) / 2)
    axes = basis @ turned[:, np.argsort(values)[::-1][:k]]
    strongest = np.abs(axes).argmax(0)
    return axes * np.sign(axes[strongest, np.arange(axes.shape[1])])


def reduce(df: DataFrame, vec: str, k: int = CLUSTER_DIMENSIONS, out: str = "reduced") -> DataFrame:
    """Adds the first ``k`` principal components of the normalised vectors.

    On unit vectors Euclidean order is cosine order. ``k`` is cut to the vectors' width.
    Wide vectors are read until the captured variance stands still, so settle an expensive input first.
    """
    df = df.filter(F.col(vec).isNotNull())  # a failed embedding has no place
    head = df.select(F.size(vec).alias("d")).first()
    if head is None:
        return df.withColumn(out, F.lit(None).cast("array<double>"))
    v = V.as_doubles(F.col(vec))
    axes = principal_axes(df.select(v.alias("v")), head["d"], min(k, head["d"]))
    shipped = df.sparkSession.sparkContext.broadcast(axes)

    @F.pandas_udf("array<double>")
    def project(v: pd.Series) -> pd.Series:
        return pd.Series(list(_unit_rows(v) @ shipped.value)) if len(v) else v

    return df.withColumn(out, project(v))


def plot_coordinates(df: DataFrame, reduced: str = "reduced") -> DataFrame:
    """umap_x and umap_y: the first two components, which PCA nests in any larger set."""
    return df.withColumns({
        "umap_x": F.get(F.col(reduced), F.lit(0)),
        "umap_y": F.coalesce(F.get(F.col(reduced), F.lit(1)), F.lit(0.0)),
    })

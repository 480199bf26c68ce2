"""How far two labellings of the same rows agree, from their contingency table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """a, b, n: the rows with each pair of labels; rows without either are left out."""
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def agreement(table: DataFrame, a: str, b: str) -> DataFrame:
    """points, adjusted_rand of a contingency table (a, b, n): 1 for equal partitions, about 0 for unrelated ones.

    Null with fewer than two points; two labellings that both have one group, or only groups of one, agree.
    """
    def pairs(col):
        return F.sum(F.col(col).cast("double") * (F.col(col) - 1) / 2)

    sides = [table.groupBy(c).agg(F.sum("n").alias("m")).agg(F.coalesce(pairs("m"), F.lit(0.0)).alias(f"p{k}")) for k, c in enumerate((a, b))]
    whole = table.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("points"), F.coalesce(pairs("n"), F.lit(0.0)).alias("same"))
    out = whole
    for side in sides:
        out = out.join(F.broadcast(side))  # one row each
    every = F.col("points").cast("double") * (F.col("points") - 1) / 2
    expected = F.col("p0") * F.col("p1") / every
    most = (F.col("p0") + F.col("p1")) / 2
    return out.select("points", F.when(F.col("points") >= 2, F.when(most == expected, 1.0).otherwise(
        (F.col("same") - expected) / (most - expected))).alias("adjusted_rand"))

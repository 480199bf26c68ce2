"""Exploratory summaries: counts, distributions, exact quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.session import settle

QUARTILES = (0.25, 0.5, 0.75)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, nulls left out, most frequent first."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), col)
    )


def sample_rows(df: DataFrame, n: int = 10_000, key: str = "ticket_id") -> DataFrame:
    """The exploration cap: ``n`` rows, the same ones each time."""
    return df.orderBy(key).limit(n)


def volume_by_date(df: DataFrame, ts: str, out: str = "day") -> DataFrame:
    return df.groupBy(F.to_date(ts).alias(out)).agg(F.count(F.lit(1)).alias("volume"))


def top_tags(df: DataFrame, tags: str = "tags", n: int = 20) -> DataFrame:
    return (
        df.select(F.explode(tags).alias("tag"))
        .groupBy("tag")
        .agg(F.count(F.lit(1)).alias("tickets"))
        .orderBy(F.desc("tickets"), "tag")
        .limit(n)
    )


def null_rates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column: rows, nulls, rate. A single pass with partial sums."""
    cols = list(cols or df.columns)
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(cols)],
    )
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("nulls")) for i, c in enumerate(cols)
    ])
    return one.select(F.col("n").alias("total"), F.explode(entries).alias("e")).select(
        "e.column_name", "total", "e.nulls",
        F.coalesce(F.try_divide("e.nulls", "total"), F.lit(0.0)).alias("null_rate"),
    )


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float] = QUARTILES
) -> DataFrame:
    """Exact, linearly interpolated quantiles: column_name, prob, value.

    ``percentile`` would gather every distinct value in one task. Here equal values
    collapse to a count map-side (so a value holding a third of all rows is one
    row), the counts are range-partitioned, and only one total per partition visits
    the driver to turn partition-local running counts into global ranks.
    """
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols
    ])
    freq = (
        df.select(F.explode(entries).alias("e"))
        .select("e.column_name", "e.v")
        .filter("v is not null")
        .groupBy("column_name", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranged = settle(
        freq.repartitionByRange("column_name", "v").withColumn("pid", F.spark_partition_id()), "quantiles"
    )
    totals = ranged.groupBy("column_name", "pid").agg(F.sum("n").alias("n")).collect()

    offsets, sizes = [], {}
    for row in sorted(totals, key=lambda r: (r["column_name"], r["pid"])):
        before = sizes.get(row["column_name"], 0)
        offsets.append((row["column_name"], row["pid"], before))
        sizes[row["column_name"]] = before + row["n"]
    # Zero-based ranks on either side of each quantile, and the weight of the upper one.
    wanted = []
    for name, size in sizes.items():
        for p in probs:
            at = p * (size - 1)
            low = int(at)
            wanted.append((name, float(p), low, min(low + 1, size - 1), at - low))

    spark = df.sparkSession
    offs = spark.createDataFrame(offsets, "column_name string, pid int, before long")
    want = spark.createDataFrame(wanted, "column_name string, prob double, lo long, hi long, w double")
    running = Window.partitionBy("column_name", "pid").orderBy("v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = ranged.withColumn("upto", F.sum("n").over(running)).join(
        F.broadcast(offs), ["column_name", "pid"]
    ).withColumn("upto", F.col("upto") + F.col("before"))

    def covers(rank: Column) -> Column:
        return (rank < F.col("upto")) & (rank >= F.col("upto") - F.col("n"))

    hits = ranked.join(F.broadcast(want), "column_name").filter(covers(F.col("lo")) | covers(F.col("hi")))
    return hits.groupBy("column_name", "prob").agg(
        (
            F.max(F.when(covers(F.col("lo")), F.col("v") * (1 - F.col("w"))))
            + F.max(F.when(covers(F.col("hi")), F.col("v") * F.col("w")))
        ).alias("value")
    )


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max of numeric columns, one row per column."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [
            F.struct(
                F.lit(c).alias("column_name"), F.count(v).alias("count"), F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
            ).alias(f"s{i}")
        ]
    moments = df.agg(*aggs).select(
        F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")
    ).select("s.*")
    q = exact_quantiles(df, cols).groupBy("column_name").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"p{int(p * 100)}") for p in QUARTILES
    ])
    return moments.join(q, "column_name", "left")

"""Ticket-level filters, key joins, versions, sorts and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def get_ticket(raw: DataFrame, ticket_id: int) -> DataFrame:
    """Point lookup; the equality reaches the parquet scan."""
    return raw.filter(F.col("ticket_id") == ticket_id)


def time_range(df: DataFrame, start: Column | None = None, col: str = "updated_at", days: int = 365) -> DataFrame:
    """Rows from ``start`` on; without one, the last ``days`` days."""
    if start is None:
        start = F.current_timestamp() - F.make_interval(days=F.lit(days))
    return df.filter(F.col(col) >= start)


def first_n(df: DataFrame, n: int | None, key: str = "ticket_id") -> DataFrame:
    """The first ``n`` rows by key (top-k, no full sort); all rows if ``n`` is None."""
    return df if n is None else df.orderBy(key).limit(n)


def with_text(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def non_noise(clusters: DataFrame) -> DataFrame:
    return clusters.filter(F.col("cluster_id") >= 0)


def missing_from(left: DataFrame, right: DataFrame, key: str = "ticket_id") -> DataFrame:
    """Rows of ``left`` whose key ``right`` lacks (unprocessed, unembedded, new)."""
    return left.join(right.select(key), key, "left_anti")


def present_in(left: DataFrame, right: DataFrame, key: str = "ticket_id") -> DataFrame:
    """Rows of ``left`` whose key ``right`` has."""
    return left.join(right.select(key), key, "left_semi")


def latest_version(
    df: DataFrame, keys: Sequence[str] = ("ticket_id",), order: Sequence[str] = ("updated_at",)
) -> DataFrame:
    """The newest row per key.

    Written as ``row_number() = 1``, which Spark also applies per task before the
    shuffle: a key with a third of all rows sends one row per task, not all of them.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of every group, with their rank; pre-limited per task as above."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def random_sample(df: DataFrame, n: int | None, seed: int | None = None, key: str | None = None) -> DataFrame:
    """A uniform sample of ``n`` rows as a top-k over random numbers; None keeps all rows.

    With ``key``, the order comes from a hash of the key, so a re-run or a retried
    task picks the same rows.
    """
    if n is None:
        return df
    if key is not None:
        return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed or 0}"))), key).limit(n)
    return df.orderBy(F.rand(seed)).limit(n)


def filter_tickets(
    tickets: DataFrame,
    *,
    channel: str | None = None,
    since: Column | None = None,
    until: Column | None = None,
    clusters: DataFrame | None = None,
    intent_cluster: int | None = None,
    suggestions: DataFrame | None = None,
    with_suggestion: bool | None = None,
    time_col: str = "processed_at",
) -> DataFrame:
    """The ticket list's filters; only those given are applied."""
    if channel is not None:
        tickets = tickets.filter(F.col("channel") == channel)
    if since is not None:
        tickets = tickets.filter(F.col(time_col) >= since)
    if until is not None:
        tickets = tickets.filter(F.col(time_col) < until)
    if intent_cluster is not None:
        tickets = present_in(tickets, clusters.filter(F.col("cluster_id") == intent_cluster))
    if with_suggestion is not None:
        pick = present_in if with_suggestion else missing_from
        tickets = pick(tickets, suggestions)
    return tickets

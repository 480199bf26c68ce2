"""Run statistics and the redaction quality report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import pii as P
from ticketmill.operators.redaction import TEXT_FIELDS, leftover_pii
from ticketmill.operators.tickets import random_sample


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; 0 if there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def cleaning_stats(cleaned: DataFrame) -> DataFrame:
    """processed, pii_found, errors, pii_rate of cleaned rows flagged faulty or not."""
    good = ~F.col("is_faulty")
    return cleaned.agg(
        F.count_if(good).alias("processed"),
        F.count_if(good & F.col("has_pii_redacted")).alias("pii_found"),
        F.count_if(~good).alias("errors"),
    ).withColumn("pii_rate", ratio(F.col("pii_found"), F.col("processed")))


def qa_report(
    clean: DataFrame, n: int | None = 100, seed: int = 0, rules: Sequence[P.Rule] = P.RULES
) -> DataFrame:
    """Sample size, leftovers per (ticket, field), their rate, and a per-ticket rate.

    The first rate counts fields and may exceed 1; the last counts each ticket once.
    """
    sample = random_sample(clean, n, seed, "ticket_id")
    counts = []
    for c in TEXT_FIELDS:
        found = F.lit(False)
        for rule in rules:
            found = found | F.col(c).rlike(rule.regex)
        dirty = P.may_hold_pii(F.col(c)) & found
        counts.append(F.coalesce(dirty, F.lit(False)).cast("int"))
    per_ticket = sample.select(sum(counts[1:], counts[0]).alias("fields"))
    return per_ticket.agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.coalesce(F.sum("fields"), F.lit(0)).cast("long").alias("tickets_with_remaining_pii"),
        F.count_if(F.col("fields") > 0).alias("distinct_tickets"),
    ).select(
        "sample_size", "tickets_with_remaining_pii",
        ratio(F.col("tickets_with_remaining_pii"), F.col("sample_size")).alias("false_negative_rate"),
        ratio(F.col("distinct_tickets"), F.col("sample_size")).alias("distinct_ticket_rate"),
    )


def sample_issues(clean: DataFrame, n: int | None = 100, seed: int = 0, top: int = 10) -> DataFrame:
    """The first ``top`` leftovers of the same sample, fields in their fixed order."""
    found = leftover_pii(random_sample(clean, n, seed, "ticket_id"), "ticket_id")
    order = F.array_position(F.array(*[F.lit(c) for c in TEXT_FIELDS]), F.col("field"))
    return found.orderBy("ticket_id", order).limit(top)


def coverage(part: DataFrame, whole: DataFrame) -> DataFrame:
    """Rows of one table over rows of another (clean over raw); two metadata-only counts."""
    a = part.agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("m"))
    b = whole.agg(F.lit(0).cast("long").alias("n"), F.count(F.lit(1)).alias("m"))
    return a.unionByName(b).agg(F.sum("n").alias("part_rows"), F.sum("m").alias("whole_rows")).withColumn(
        "coverage", ratio(F.col("part_rows"), F.col("whole_rows"))
    )

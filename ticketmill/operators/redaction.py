"""Redaction jobs over DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import pii as P

TEXT_FIELDS = ("text_full", "text_customer_only", "text_agent_only")


def redact(
    df: DataFrame, cols: Sequence[str], rules: Sequence[P.Rule] = P.RULES, flag: str = "has_pii"
) -> DataFrame:
    """Redact each column on its own; ``flag`` is true if any of them held a match."""
    rules = tuple(rules)
    done = {c: f"_redacted_{c}" for c in cols}
    df = df.withColumns({done[c]: P.redact_text(F.col(c), rules) for c in cols})
    hit = F.lit(False)
    for c in cols:
        hit = hit | P.has_pii(F.col(c), F.col(done[c]))
    df = df.withColumn(flag, hit)
    return df.select(*[
        F.col(done[c]).alias(c) if c in done else F.col(c) for c in df.columns if c not in done.values()
    ])


def redaction_audit(
    df: DataFrame, id_col: str, col: str, rules: Sequence[P.Rule] = P.RULES
) -> DataFrame:
    """One row per redaction: id, step, type, original_length, position.

    ``position`` counts in the text as that rule saw it; ``step`` is the order in
    which redactions happen (rules in turn, last match first within a rule).
    Rows without an at sign or digit are dropped before any rule runs.
    """
    hits = P.all_hits(F.col(col), tuple(rules))
    return df.filter(P.may_hold_pii(F.col(col))).select(id_col, F.posexplode(hits).alias("step", "h")).select(
        id_col, F.col("step").cast("long").alias("step"), "h.type",
        F.col("h.original_length").cast("long").alias("original_length"),
        F.col("h.position").cast("long").alias("position"),
    )


def hits_by_type(df: DataFrame, col: str, rules: Sequence[P.Rule] = P.RULES) -> DataFrame:
    """Redactions and texts concerned, per type.

    Hits are counted per row first, so at most one number per rule and row goes on,
    and partial sums leave eight rows per task to shuffle.
    """
    rules = tuple(rules)
    # Every type has a row, hits or not, as long as there are texts to look at.
    none = F.array(*[F.struct(F.lit(r.name).alias("type"), F.lit(0).alias("n")) for r in rules])
    counts = df.filter(P.may_hold_pii(F.col(col))).select(
        F.explode(F.concat(P.hit_counts(F.col(col), rules), none)).alias("x"))
    return counts.groupBy("x.type").agg(
        F.sum("x.n").cast("long").alias("hits"), F.count_if(F.col("x.n") > 0).cast("long").alias("texts"))


def leftover_pii(
    df: DataFrame, id_col: str, cols: Sequence[str] = TEXT_FIELDS, rules: Sequence[P.Rule] = P.RULES
) -> DataFrame:
    """One row per (id, field) whose text still matches a rule: id, field, remaining map."""
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in cols])
    long = df.select(id_col, F.explode(fields).alias("f")).select(id_col, "f.field", "f.text")
    # A generator is not copied into the filter, so each pattern runs once a text.
    found = P.leftovers(F.col("text"), tuple(rules))
    return long.filter(P.may_hold_pii(F.col("text"))).select(
        id_col, "field", F.explode(F.filter(F.array(found), lambda m: F.size(m) > 0)).alias("remaining")
    )

"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources get shares of a word budget by weight. A target stops at ``max_epochs`` times its
source's size, and the excess is shared anew by weight until none is above. A source whose
target is e times its size and a rest takes every document e times first (complete epochs);
the rest is drawn without replacement: each document gets the exponential key ``-ln(u) / w`` from
a hash ``u`` of its doc_id and its quality weight ``w``, and documents are taken in the order of
their keys until their running sizes fill the budget. The document on the edge gives only as
many words as are left, so a source yields its target to within half a word.

Sources stand in code point order, null last, and weigh ``WEIGHTS`` in turn. The keys are sorted
by ranges over all tasks, so one source may hold any share of the rows; per-source figures
stay in a table, and the driver sees only sums over it.

Null texts and texts without words have size 0 and are taken 0 times; a null doc_id draws the
key of its missing id; rows that repeat a doc_id share a key and stand by size, equal ones are
interchangeable. An empty table gives no rows; extra columns are ignored, whatever their
names; long texts are counted whole. Quality weights must be above 0; documents without one weigh 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import join_checked, settle
from ticketmill.operators.ranking import running_total

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix"
GOOD, BAD = 2.0, 0.5


def label_weights(labels: DataFrame) -> DataFrame:
    """doc_id, quality_weight: ``GOOD`` for documents labelled good and not toxic, ``BAD`` for the other labelled ones."""
    good = (F.coalesce(F.min("quality"), F.lit(1)) == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)
    return labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.when(good, F.lit(GOOD)).otherwise(F.lit(BAD)).alias("quality_weight"))


def exponential_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """``-ln(u) / weight`` with u strictly between 0 and 1, from 52 bits of a SHA-256 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(16 ** 13)) / weight


def targets(sources: DataFrame, total: float, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``sources`` (weight, source_size, ...) with ``target``: shares of ``total`` by weight, capped, the excess shared anew.

    All that a round needs is the budget for one unit of weight: it grows as sources reach
    their caps, and ends when none is newly above. Each round is one aggregate of the table.
    """
    cap = F.col("source_size") * float(max_epochs)
    unit = 0.0
    while True:
        above = F.col("weight") * F.lit(unit) > cap
        spent, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))).first()
        if not open_weight:
            break
        grown = (total - spent) / open_weight
        if grown <= unit:
            break
        unit = grown
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(unit), cap))


def mix(
    docs: DataFrame, quality: DataFrame | None = None, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
    max_epochs: int = MAX_EPOCHS, seed: str = SEED,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words, repeats counted), epochs (whole passes over the source).

    ``quality`` holds doc_id (once each) and quality_weight.
    """
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), F.col("source"))).alias("key"),  # null last
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"))
    weight = F.lit(1.0)
    if quality is not None:
        sized = join_checked(sized, settle(quality.select("doc_id", "quality_weight"), "quality"), "doc_id", "left", 24)
        weight = F.coalesce("quality_weight", F.lit(1.0))
    sized = settle(sized.select("doc_id", "key", "size", exponential_key(F.col("doc_id"), weight, seed).alias("draw")), "sized")

    sources = settle(sized.groupBy("key").agg(F.sum("size").alias("source_size")).withColumn("all", F.lit("")), "sources")
    ranked = running_total(sources, "all", [F.col("key")], name="nth")
    cycle = F.array(*map(F.lit, map(float, weights)))
    weighed = settle(ranked.select(
        "key", "source_size", F.get(cycle, F.pmod("nth", F.lit(len(weights))).cast("int")).alias("weight")), "weighed")
    words = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    budgets = settle(targets(weighed, share * words, max_epochs).select(
        "key", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("epochs"),
    ).withColumn("rest", F.floor(F.col("target") + 0.5).cast("long") - F.col("epochs") * F.col("source_size")), "budgets")

    drawn = running_total(sized, "key", [F.col("draw"), F.col("doc_id"), F.col("size")], "size", "before")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return join_checked(drawn, budgets, "key", "inner", "48 + octet_length(key)").select(
        "doc_id", F.when(F.col("key") != "1", F.substring("key", 2, 1 << 30)).alias("source"), "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + part).alias("taken"), "epochs")

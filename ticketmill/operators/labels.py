"""Cluster examples, prompts, labels, and the intent catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions.text import strip
from ticketmill.operators.tickets import top_per_group
from ticketmill.session import settle

# --- Fixed values ------------------------------------------------------------
EXAMPLES_PER_CLUSTER = 5
PROMPT_CHARS = 500
FALLBACK_NAME = "Sin clasificar"
FALLBACK_CHARS = 200
RETIRED_INTENT_STATUS = "inactive"
NEW_INTENT_STATUS = "pending"
# -----------------------------------------------------------------------------
NAME_TERMS = 4


def cluster_examples(clusters: DataFrame, clean: DataFrame, n: int = EXAMPLES_PER_CLUSTER) -> DataFrame:
    """The ``n`` members nearest each centroid, with their texts.

    Ranking runs on the narrow cluster table after a key-only semi join, so texts
    are fetched for the winners alone.
    """
    members = clusters.filter(F.col("cluster_id") >= 0).select(
        "ticket_id", "cluster_id", "distance_to_centroid"
    ).join(clean.select("ticket_id"), "ticket_id", "left_semi")
    best = top_per_group(members, "cluster_id", [F.col("distance_to_centroid"), F.col("ticket_id")], n)
    return best.join(
        clean.select("ticket_id", "text_customer_only", "text_full"), "ticket_id"
    ).select(
        "cluster_id", F.col("rank").cast("long").alias("rank"), "ticket_id", "distance_to_centroid",
        "text_customer_only", "text_full",
    )


def label_prompts(examples: DataFrame) -> DataFrame:
    """The example block of each cluster's prompt (bounded: n examples of 500 characters)."""
    snippet = F.concat(
        F.lit("Ejemplo "), F.col("rank").cast("string"), F.lit(":\n"),
        F.substring(F.coalesce("text_customer_only", F.lit("")), 1, PROMPT_CHARS),
    )
    return examples.groupBy("cluster_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", snippet.alias("s")))).alias("x")
    ).select("cluster_id", F.array_join(F.transform("x", lambda e: e["s"]), "\n\n").alias("examples_text"))


def class_terms(texts: DataFrame, group: str, col: str, n: int = NAME_TERMS) -> DataFrame:
    """The ``n`` most telling words per cluster by class TF-IDF: group, rank, term, score.

    score = share of the word in its cluster x ln(1 + mean words per cluster / all
    uses of the word). Counts combine map-side and are written once, so texts are
    split a single time; the top n are pre-limited per task.
    """
    words = texts.select(
        group, F.explode(F.split(F.lower(F.col(col)), r"[^\p{L}\p{N}]+")).alias("term")
    ).filter(F.length("term") >= 3)
    per = settle(words.groupBy(group, "term").agg(F.count(F.lit(1)).alias("n")), "terms")
    size = per.groupBy(group).agg(F.sum("n").alias("words"))
    uses = per.groupBy("term").agg(F.sum("n").alias("uses"))
    mean = size.agg(F.avg("words").alias("mean_words"), F.lit(1).alias("_one"))
    scored = (
        per.join(size, group).join(uses, "term")
        .withColumn("_one", F.lit(1)).join(F.broadcast(mean), "_one")
        .select(group, "term", F.round(
            F.col("n") / F.col("words") * F.log(1 + F.col("mean_words") / F.col("uses")), 9
        ).alias("score"))
    )
    return top_per_group(scored, group, [F.desc("score"), F.col("term")], n)


def keyword_labels(texts: DataFrame, col: str = "text_customer_only") -> DataFrame:
    """The default labeller: cluster_id, name (four words at most), description."""
    terms = class_terms(texts, "cluster_id", col)
    listed = terms.groupBy("cluster_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("x")
    ).select("cluster_id", F.transform("x", lambda e: e["term"]).alias("t"))
    return listed.select(
        "cluster_id", F.array_join("t", " ").alias("name"),
        F.concat(F.lit("Consultas sobre "), F.array_join("t", ", ")).alias("description"),
    )


def parse_labels(replies: DataFrame, col: str = "reply") -> DataFrame:
    """Model replies to name and description.

    A code fence and its ``json`` tag are removed. Defaults stand in for absent keys
    only; a reply that is no JSON becomes the description, cut to 200 characters.
    ``is_faulty`` marks JSON that is no object.
    """
    bare = strip(F.col(col))
    fenced = F.get(F.split(bare, "```"), F.lit(1))
    untagged = F.when(fenced.startswith("json"), F.expr("substring(_f, 5)")).otherwise(F.col("_f"))
    df = replies.withColumn("_f", F.when(bare.startswith("```"), fenced))
    df = df.withColumn("_c", F.when(F.col("_f").isNotNull(), strip(untagged)).otherwise(bare))
    df = df.withColumn("_v", F.try_parse_json("_c"))
    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))

    def field(name: str, default: str) -> Column:
        absent = F.variant_get("_v", f"$.{name}", "variant").isNull()
        return F.when(absent, F.lit(default)).otherwise(F.try_variant_get("_v", f"$.{name}", "string"))

    bad_json = F.col("_v").isNull()
    return df.withColumns({
        "name": F.when(bad_json, F.lit(FALLBACK_NAME)).when(is_object, field("name", FALLBACK_NAME)),
        "description": F.when(bad_json, F.substring("_c", 1, FALLBACK_CHARS)).when(
            is_object, field("description", "")),
        "is_faulty": ~bad_json & ~is_object,
    }).drop("_f", "_c", "_v")


def intent_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """One pending intent per labelled cluster; clusters without a label are left out."""
    now = F.current_timestamp()
    return stats.join(labels, "cluster_id").select(
        F.col("cluster_id").cast("string").alias("intent_id"), F.col("cluster_id").cast("long").alias("cluster_id"),
        "name", "description", "volume", F.lit(NEW_INTENT_STATUS).alias("status"),
        now.alias("created_at"), now.alias("updated_at"),
    )


def top_clusters(stats: DataFrame, n: int | None) -> DataFrame:
    return stats if n is None else stats.orderBy(F.desc("volume"), "cluster_id").limit(n)


def intent_summary(intents: DataFrame, n: int = 20) -> DataFrame:
    return intents.filter(F.col("status") != RETIRED_INTENT_STATUS).select(
        "intent_id", "name", "description", "volume", "status"
    ).orderBy(
        F.desc("volume"), "intent_id"
    ).limit(n)

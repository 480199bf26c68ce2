"""Intent scoring: detection, confidence, tag overlap, cohesion, composite score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import vectors as V
from ticketmill.operators.centroids import nearest_centroid

# --- Fixed values ------------------------------------------------------------
HIGH_CONFIDENCE = 0.75
MEDIUM_CONFIDENCE = 0.5
NO_INTENT = "no_intent"
# -----------------------------------------------------------------------------
DEFAULT_WEIGHTS = {"volume": 0.4, "time": 0.3, "repetition": 0.2, "risk": 0.1}
RISK_LEVELS = {"low": 0.0, "medium": 0.5, "high": 1.0}


def detect_intent(
    points: DataFrame, cents: DataFrame, id_col: str, vec: str, threshold: float
) -> DataFrame:
    """id, intent_id, distance: nearest centroid, or no intent beyond the threshold."""
    near = nearest_centroid(points, cents, id_col, vec)
    return near.select(
        id_col,
        F.when(F.col("distance") > threshold, F.lit(NO_INTENT))
        .otherwise(F.col("cluster_id").cast("string")).alias("intent_id"),
        "distance",
    )


def confidence(clusters: DataFrame) -> DataFrame:
    """Adds confidence_score = 1 - distance / greatest distance in the cluster, and its band.

    The scale is our choice: 1 at the centroid, 0 at the farthest member. Noise has none.
    The maxima are one row per cluster and come from map-side partial results.
    """
    farthest = clusters.filter("cluster_id >= 0").groupBy("cluster_id").agg(
        F.max("distance_to_centroid").alias("_far")
    )
    scored = clusters.join(farthest, "cluster_id", "left").withColumn(
        "confidence_score",
        F.when(F.col("_far") > 0, 1 - F.col("distance_to_centroid") / F.col("_far"))
        .when(F.col("_far").isNotNull(), F.lit(1.0)),
    )
    s = F.col("confidence_score")
    return scored.withColumn(
        "confidence_band",
        F.when(s > HIGH_CONFIDENCE, "high").when(s >= MEDIUM_CONFIDENCE, "medium").otherwise("low"),
    ).withColumn(
        "suggest", F.coalesce(s >= MEDIUM_CONFIDENCE, F.lit(False))
    ).drop("_far")


def tag_overlap(clusters: DataFrame, tickets: DataFrame, tags: str = "tags") -> DataFrame:
    """cluster_id, tag, tickets, share: how much of each cluster carries each tag."""
    member = clusters.filter("cluster_id >= 0").select("ticket_id", "cluster_id")
    size = member.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("_size"))
    tagged = tickets.select("ticket_id", F.explode(F.array_distinct(tags)).alias("tag"))
    counted = member.join(tagged, "ticket_id").groupBy("cluster_id", "tag").agg(
        F.count(F.lit(1)).alias("tickets")
    )
    return counted.join(size, "cluster_id").select(
        "cluster_id", "tag", "tickets", (F.col("tickets") / F.col("_size")).alias("share")
    )


def resolution_hours(tickets: DataFrame, group: str) -> DataFrame:
    """Mean hours from creation to the last update of solved or closed tickets."""
    hours = (F.unix_micros(F.col("updated_at").cast("timestamp"))
             - F.unix_micros(F.col("created_at").cast("timestamp"))) / 3.6e9
    return tickets.filter(F.col("status").isin("solved", "closed")).groupBy(group).agg(
        F.avg(hours).alias("avg_resolution_time_hours")
    )


def repetition(points: DataFrame, vec: str, label: str = "cluster_id") -> DataFrame:
    """Mean pairwise cosine per cluster, without forming a pair.

    Over unit vectors the sum of all cosines is |sum|^2, of which n are with oneself.
    """
    sums = points.filter(F.col(label) >= 0).groupBy(F.col(label).cast("long").alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("n"), V.sum_vector(V.unit(V.as_doubles(F.col(vec)))).alias("s")
    )
    pairs = F.col("n") * (F.col("n") - 1)
    return sums.select(
        "cluster_id",
        F.when(pairs > 0, (V.squared_norm(F.col("s")) - F.col("n")) / pairs).alias("repetition_score"),
    )


def composite_score(intents: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Adds composite_score in 0..1 for intents with the four score columns.

    Volume and time are scaled by their greatest value; weights are parameters, as no
    formula is given anywhere. A missing part counts as 0.
    """
    w = {**DEFAULT_WEIGHTS, **(weights or {})}
    top = intents.agg(
        F.max("volume").alias("_v"), F.max("avg_resolution_time_hours").alias("_t"), F.lit(1).alias("_one")
    )
    risk = F.coalesce(*[F.when(F.col("risk_level") == k, F.lit(x)) for k, x in RISK_LEVELS.items()], F.lit(0.0))

    def part(c) -> F.Column:
        return F.coalesce(c, F.lit(0.0))

    return intents.withColumn("_one", F.lit(1)).join(F.broadcast(top), "_one").withColumn(
        "composite_score",
        w["volume"] * part(F.try_divide("volume", "_v"))
        + w["time"] * part(F.try_divide("avg_resolution_time_hours", "_t"))
        + w["repetition"] * part(F.col("repetition_score"))
        + w["risk"] * risk,
    ).drop("_one", "_v", "_t")

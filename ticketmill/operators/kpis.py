"""Business figures over suggestions, feedback and intents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.operators.quality import ratio


def feedback_rates(feedback: DataFrame) -> DataFrame:
    """Feedback count, acceptance (accept or edit) and rejection rates."""
    a = F.col("action")
    return feedback.agg(
        F.count(F.lit(1)).alias("feedback"),
        F.count_if(a.isin("accept", "edit")).alias("accepted"),
        F.count_if(a == "reject").alias("rejected"),
    ).select(
        "feedback", ratio(F.col("accepted"), F.col("feedback")).alias("acceptance_rate"),
        ratio(F.col("rejected"), F.col("feedback")).alias("rejection_rate"),
    )


def suggestion_coverage(tickets: DataFrame, suggestions: DataFrame, intents: DataFrame) -> DataFrame:
    """Share of the tickets in active intents that have a suggestion.

    ``tickets`` has ticket_id and intent_id. Only keys are joined; suggestions are
    reduced to one row per ticket first.
    """
    active = tickets.select("ticket_id", "intent_id").join(
        intents.filter(F.col("status") == "active").select("intent_id"), "intent_id", "left_semi"
    )
    done = suggestions.select("ticket_id").distinct().withColumn("_s", F.lit(1))
    return active.join(done, "ticket_id", "left").agg(
        F.count(F.lit(1)).alias("active_tickets"), F.count("_s").alias("with_suggestion")
    ).withColumn("suggestion_coverage", ratio(F.col("with_suggestion"), F.col("active_tickets")))


def hours_saved(suggestions: DataFrame, feedback: DataFrame, intents: DataFrame) -> DataFrame:
    """Per intent: accepted suggestions and accepted x its mean resolution time."""
    accepted = feedback.filter(F.col("action").isin("accept", "edit")).select("suggestion_id")
    per = suggestions.select("suggestion_id", "intent_id").join(accepted, "suggestion_id").groupBy(
        "intent_id"
    ).agg(F.count(F.lit(1)).alias("accepted"))
    return per.join(intents.select("intent_id", "avg_resolution_time_hours"), "intent_id").withColumn(
        "hours_saved", F.col("accepted") * F.col("avg_resolution_time_hours")
    ).drop("avg_resolution_time_hours")


def confidence_by_intent(suggestions: DataFrame) -> DataFrame:
    return suggestions.groupBy("intent_id").agg(
        F.count(F.lit(1)).alias("suggestions"), F.avg("confidence_score").alias("mean_confidence")
    )


def feedback_timeline(feedback: DataFrame) -> DataFrame:
    """Feedback per day, by action."""
    a = F.col("action")
    return feedback.groupBy(F.to_date("created_at").alias("day")).agg(
        F.count(F.lit(1)).alias("feedback"), F.count_if(a == "accept").alias("accepted"),
        F.count_if(a == "edit").alias("edited"), F.count_if(a == "reject").alias("rejected"),
    )


def intent_coverage(intents: DataFrame, total_tickets: DataFrame) -> DataFrame:
    """Volume of active intents over all tickets."""
    active = intents.filter(F.col("status") == "active").agg(
        F.coalesce(F.sum("volume"), F.lit(0)).cast("long").alias("active_volume"), F.lit(0).cast("long").alias("m")
    )
    whole = total_tickets.agg(F.lit(0).cast("long").alias("active_volume"), F.count(F.lit(1)).alias("m"))
    return active.unionByName(whole).agg(
        F.sum("active_volume").alias("active_volume"), F.sum("m").alias("total_tickets")
    ).withColumn("intent_coverage", ratio(F.col("active_volume"), F.col("total_tickets")))

"""Landing files: ticket and comment JSON lines to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.operators.comments import attach_comments
from ticketmill.schemas import RAW_TICKETS, conform

# ``requester`` and ``public`` are VARIANT: the first may be an object or a number,
# and for the second an absent key and a null mean different things.
TICKET_JSON = (
    "id long, subject string, description string, created_at string, updated_at string, "
    "tags array<string>, via struct<channel:string>, assignee_id long, status string, "
    "priority string, requester variant, comments array<variant>, _corrupt_record string"
)
COMMENT_JSON = (
    "ticket_id long, seq long, id long, body string, author_id long, public variant, "
    "created_at string, _corrupt_record string"
)


def landing_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TICKET_JSON).json(path)


def is_bad(lines: DataFrame) -> F.Column:
    """Unreadable lines, and tickets without an id or usable times."""
    return (
        F.col("_corrupt_record").isNotNull() | F.col("id").isNull()
        | F.try_to_timestamp("created_at").isNull() | F.try_to_timestamp("updated_at").isNull()
    )


def bad_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(is_bad(lines)).select(
        F.coalesce("_corrupt_record", F.to_json(F.struct("id", "subject", "created_at", "updated_at"))).alias("record")
    )


def parse_tickets(lines: DataFrame) -> DataFrame:
    """Good lines as typed tickets; embedded comments, if any, become comments_json."""
    comment = F.transform("comments", lambda c: F.struct(
        F.try_variant_get(c, "$.id", "long").alias("id"),
        F.try_variant_get(c, "$.body", "string").alias("body"),
        F.try_variant_get(c, "$.author_id", "long").alias("author_id"),
        F.when(F.variant_get(c, "$.public", "variant").isNull(), F.lit(True))
        .otherwise(F.try_variant_get(c, "$.public", "boolean")).alias("public"),
        F.try_variant_get(c, "$.created_at", "string").alias("created_at"),
    ))
    return lines.filter(~is_bad(lines)).select(
        F.col("id").alias("ticket_id"), "subject", "description",
        F.coalesce(F.to_json(comment, {"ignoreNullFields": "false"}), F.lit("[]")).alias("comments_json"),
        F.to_timestamp("created_at").alias("created_at"), F.to_timestamp("updated_at").alias("updated_at"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        F.col("via.channel").alias("channel"), "assignee_id", "status", "priority",
        F.try_variant_get("requester", "$.email", "string").alias("requester_email"),
    )


def to_raw_rows(tickets: DataFrame) -> DataFrame:
    """Stamp ``ingested_at`` and conform to the raw table."""
    return conform(tickets.withColumn("ingested_at", F.current_timestamp()), RAW_TICKETS)


def comment_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMMENT_JSON).json(path)


def is_bad_comment() -> F.Column:
    """Unreadable comment lines, and those of no ticket."""
    return F.col("_corrupt_record").isNotNull() | F.col("ticket_id").isNull()


def bad_comments(lines: DataFrame) -> DataFrame:
    return lines.filter(is_bad_comment()).select(
        F.coalesce("_corrupt_record", F.to_json(F.struct("seq", "id", "body"))).alias("record"))


def read_tickets(spark: SparkSession, tickets_dir: str, comments_dir: str | None = None) -> DataFrame:
    """Raw rows from landing files; comments embedded, or in files of their own."""
    tickets = parse_tickets(landing_lines(spark, tickets_dir))
    if comments_dir is not None:
        comments = comment_lines(spark, comments_dir)
        tickets = attach_comments(tickets.drop("comments_json"), comments.filter(~is_bad_comment()))
    return to_raw_rows(tickets)


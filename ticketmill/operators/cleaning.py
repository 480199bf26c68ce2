"""Cleaning jobs over DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import messages as M
from ticketmill.functions import text as X


def strip_html(df: DataFrame, col: str) -> DataFrame:
    """Tags to spaces, then entities decoded (in that order)."""
    return df.withColumn(col, X.strip_tags(F.col(col))).withColumn(col, X.decode_entities(F.col(col)))


def mask_urls(df: DataFrame, col: str, token: str = X.URL_TOKEN) -> DataFrame:
    return df.withColumn(col, X.mask_urls(F.col(col), token))


def cut_signature(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, X.cut_signature(F.col(col)))


def cut_quotes(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, X.cut_quotes(F.col(col)))


def flag_auto(df: DataFrame, col: str, out: str = "is_auto") -> DataFrame:
    return df.withColumn(out, X.is_auto_response(F.col(col)))


def mask_mentions(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, X.mask_mentions(F.col(col)))


def normalize_ws(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, X.normalize_whitespace(F.col(col)))


def drop_empty_and_auto(df: DataFrame, col: str) -> DataFrame:
    """Keep messages that still say something and are no automatic answer."""
    kept = F.filter(F.array(F.col(col)), lambda c: (c != "") & ~X.is_auto_response(c))
    # A generator keeps the text that it tests, so what made the text is not evaluated again.
    names = df.columns
    return df.withColumn("_kept", F.explode(kept)).drop(col).withColumnRenamed("_kept", col).select(*names)


def _by_channel(channel: Column, build) -> Column:
    """``build(kind)`` for the row's class; chat and other share one treatment."""
    return (
        F.when(channel.isin("email", "web"), build("email"))
        .when(channel == "social", build("social"))
        .otherwise(build("other"))
    )


def clean_text(
    df: DataFrame, col: str, channel_col: str, remove_urls: bool = True, token: str = X.URL_TOKEN
) -> DataFrame:
    """Full cleaning of one text column by channel class; null and '' become ''."""
    df = df.withColumn(col, X.strip_tags(F.coalesce(F.col(col), F.lit(""))))
    df = df.withColumn(col, X.decode_entities(F.col(col)))
    return df.withColumn(col, _by_channel(
        F.col(channel_col), lambda kind: X.channel_body(F.col(col), kind, remove_urls, token)
    ))


def clean_tickets(raw: DataFrame, keep: tuple[str, ...] = (), remove_urls: bool = True) -> DataFrame:
    """Raw tickets to ticket_id, channel, three texts, word_count, ``is_faulty``.

    A ticket and its comments sit in one row, so the whole job is a narrow
    projection: no shuffle, whatever the number of messages per ticket. Steps are
    chained ``transform`` calls over the row's messages; Python sees only rows that
    hold an HTML entity. Rows flagged faulty carry no comments and belong in quarantine.
    """
    df = raw.select(
        "ticket_id", *keep, "subject", "description",
        X.channel_class(F.coalesce("channel", F.lit(""))).alias("channel"),
        M.parse(F.col("comments_json")).alias("_v"),
    )
    df = df.withColumn("_m", M.with_description(M.from_parsed(F.col("_v")), F.col("description")))
    df = df.withColumn("is_faulty", M.is_faulty(F.col("_v"))).drop("_v", "description")
    df = df.withColumn("_b", F.transform("_m", lambda m: X.strip_tags(m["body"])))
    df = df.withColumn("_b", X.decode_entities_each(F.col("_b")))
    df = df.withColumn("_b", _by_channel(
        F.col("channel"),
        lambda kind: F.transform("_b", lambda b: X.channel_body(b, kind, remove_urls)),
    ))
    df = df.withColumn("_k", F.filter(
        F.zip_with("_m", "_b", lambda m, b: F.struct(m["role"].alias("role"), b.alias("body"))),
        lambda m: (m["body"] != "") & ~X.is_auto_response(m["body"]),
    ))

    def spoken_by(role: str) -> Column:
        return F.transform(F.filter("_k", lambda m: m["role"] == role), lambda m: m["body"])

    df = df.withColumn("_c", spoken_by("customer")).withColumn("_a", spoken_by("agent"))
    head = F.when(
        F.coalesce("subject", F.lit("")) != "", F.array(F.concat(F.lit("Asunto: "), F.col("subject")))
    ).otherwise(F.array().cast("array<string>"))
    df = df.select(
        "ticket_id", *keep, "channel", "is_faulty",
        F.array_join(F.concat(head, "_c", "_a"), "\n\n").alias("text_full"),
        F.array_join("_c", "\n\n").alias("text_customer_only"),
        F.array_join("_a", "\n\n").alias("text_agent_only"),
    )
    return df.withColumn("word_count", X.word_count(F.col("text_full")))

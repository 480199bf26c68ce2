"""Comments: normalise, attach to tickets, explode to messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import messages as M

# Comments gathered at a time: one long conversation is sorted in pieces by several tasks
# before its row is put together.
PIECE_SIZE = 10_000


def normalize_comments(comments: DataFrame) -> DataFrame:
    """Keep the five comment fields; ``public`` is true if the key is absent.

    ``public`` may be a VARIANT (absent and null differ) or a boolean.
    """
    if dict(comments.dtypes)["public"] == "variant":
        public: Column = F.when(F.col("public").isNull(), F.lit(True)).otherwise(
            F.try_variant_get("public", "$", "boolean")
        )
    else:
        public = F.col("public")
    return comments.select(
        "ticket_id", "seq", "id", "body", "author_id", public.alias("public"), "created_at"
    )


def attach_comments(tickets: DataFrame, comments: DataFrame, piece_size: int = PIECE_SIZE) -> DataFrame:
    """Add ``comments_json``, all comments in page order, to each ticket: one row a ticket.

    ``seq`` is the comment's position in its ticket; comments without one come last.
    """
    order = (F.col("seq").isNull().alias("unplaced"), "seq", "id", "body", "author_id", "public", "created_at")
    pieces = (
        normalize_comments(comments)
        .groupBy("ticket_id", F.floor(F.col("seq") / piece_size).cast("long").alias("piece"))
        .agg(F.sort_array(F.collect_list(F.struct(*order))).alias("items"))
        .select("ticket_id", F.struct(
            F.col("piece").isNull().alias("unplaced"), "piece", comments_to_json(F.col("items")).alias("json")).alias("p"))
    )
    inner = F.transform(F.sort_array(F.collect_list("p")), lambda p: F.substring(p["json"], F.lit(2), F.length(p["json"]) - 2))
    whole = pieces.groupBy("ticket_id").agg(F.concat(F.lit("["), F.array_join(inner, ","), F.lit("]")).alias("comments_json"))
    return tickets.join(whole, "ticket_id", "left").withColumn("comments_json", F.coalesce("comments_json", F.lit("[]")))


def comments_to_json(items: Column) -> Column:
    """JSON text of a comment array: nulls stay, letters stay unescaped, ``seq`` goes."""
    kept = F.transform(
        items,
        lambda c: F.struct(*[
            c[f].alias(f) for f in ("id", "body", "author_id", "public", "created_at")
        ]),
    )
    return F.to_json(kept, {"ignoreNullFields": "false"})


def explode_messages(raw: DataFrame) -> DataFrame:
    """One row per message: ticket_id, seq (description is -1), role, body."""
    parsed = raw.select("ticket_id", "description", M.parse(F.col("comments_json")).alias("v"))
    listed = parsed.select(
        "ticket_id", "description", F.posexplode_outer(M.from_parsed(F.col("v"))).alias("seq", "m")
    )
    # The description rides on the first row of its ticket, so nothing is scanned twice.
    both = listed.select(
        "ticket_id",
        F.explode(F.filter(
            F.array(
                F.when(
                    F.coalesce("seq", F.lit(0)) == 0,
                    F.struct(F.lit(-1).alias("seq"), F.lit("customer").alias("role"),
                             F.col("description").alias("body")),
                ),
                F.when(
                    F.col("m").isNotNull(),
                    F.struct(F.col("seq"), F.col("m.role").alias("role"), F.col("m.body").alias("body")),
                ),
            ),
            lambda x: F.coalesce(x["body"], F.lit("")) != "",
        )).alias("x"),
    )
    return both.select("ticket_id", F.col("x.seq").cast("long").alias("seq"), "x.role", "x.body")

"""Registry of runnable queries and the views they share.

Each query reads the given tables and may carry an equivalent SQL text. The views
below turn those tables into the ticket model; each has a Spark form and an SQL form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.operators.comments import attach_comments

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sql_text(value: str) -> str:
    """A DuckDB string literal; escapes are spelled out so that newlines survive."""
    return "E'" + value.replace("\\", "\\\\").replace("'", "''").replace("\n", "\\n") + "'"


def sql_list(values: list[str | None]) -> str:
    return "[" + ", ".join("NULL" if v is None else sql_text(v) for v in values) + "]"


def pick(values: list[str | None], index: Column) -> Column:
    """The element of a literal list at ``index`` modulo its length."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


# Endings added to table texts so that every cleaning and redaction rule has work to
# do on every scale: the plain tables hold hardly any of these patterns.
SNIPPETS: list[str | None] = [
    "",
    "\n\nSaludos,\nJuan Pérez\nGerente de Ventas",
    " <p>ver <b>estado</b></p> https://tienda.example/ruta?id=1&amp;x=2 para seguir",
    "\nEl lunes 3 de enero Ana escribió:\n> hola\n> adios",
    " escribeme a juan.perez@example.com por favor",
    " llamame al +56 9 1234 5678 hoy",
    " mi documento es 12.345.678-9 gracias",
    " @tienda necesito ayuda #reclamo    \t ya\n\n\n\nfin",
    " el pedido #1234567 no ha llegado",
    " vivo en Calle Las Flores 567 cerca del parque",
    " mi pasaporte es AB1234567 vigente",
    " Este es un mensaje automático. ",
    " tarjeta 4111-1111-1111-1111 vencida",
    " fono +44 12345678901 de oficina",
    "\n   \n  > cita suelta\ntexto debajo",
    "\nFrom: soporte@tienda.example\nSent: ayer\ncuerpo anterior\n\n--\nfirma",
]
CHANNEL_WORDS: list[str | None] = ["Email", "web_form", "Twitter DM", "live chat", "api", None, "WhatsApp", "Facebook"]
STATUSES: list[str | None] = ["open", "pending", "solved", "closed", None]

DECORATED_SQL = f"""
decorated AS (
  SELECT doc_id, text || {sql_list(SNIPPETS)}[doc_id % {len(SNIPPETS)} + 1] AS text
  FROM documents)"""


def decorated(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents, each with one ending: doc_id, text.

    Dealt out by id, however few row groups the table has: chains of patterns follow.
    """
    return table(spark, sf, "documents").select("doc_id", "text").repartition("doc_id").select(
        "doc_id", F.concat("text", pick(SNIPPETS, F.col("doc_id"))).alias("text")
    )


# A conversation is a ticket: its first user turn is the description, every other turn
# a comment. Users are author 1, everyone else author 2.
_TURNS_SQL = f"""
turns AS (
  SELECT conv_id AS ticket_id, turn AS seq, role,
         text || {sql_list(SNIPPETS)}[(conv_id * 7 + turn) % {len(SNIPPETS)} + 1] AS body
  FROM conversations),
opening AS (
  SELECT ticket_id, min(seq) AS seq FROM turns WHERE role = 'user' GROUP BY ticket_id),
base AS (
  SELECT c.ticket_id, t.body AS description, c.n_turns
  FROM (SELECT ticket_id, count(*) AS n_turns FROM turns GROUP BY ticket_id) c
  LEFT JOIN opening o ON o.ticket_id = c.ticket_id
  LEFT JOIN turns t ON t.ticket_id = o.ticket_id AND t.seq = o.seq),
comments AS (
  SELECT t.* FROM turns t LEFT JOIN opening o ON o.ticket_id = t.ticket_id
  WHERE o.seq IS NULL OR t.seq <> o.seq)"""

TICKETS_SQL = _TURNS_SQL + f""",
tickets AS (
  SELECT ticket_id,
         CASE WHEN ticket_id % 7 = 0 THEN NULL ELSE 'Consulta ' || ticket_id END AS subject,
         description,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(ticket_id AS INT)) AS created_at,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(ticket_id + n_turns * 3 AS INT)) AS updated_at,
         ['canal' || (ticket_id % 3), 'tema' || (ticket_id % 5)] AS tags,
         {sql_list(CHANNEL_WORDS)}[ticket_id % {len(CHANNEL_WORDS)} + 1] AS channel,
         CASE WHEN ticket_id % 4 = 0 THEN NULL ELSE ticket_id % 11 END AS assignee_id,
         {sql_list(STATUSES)}[ticket_id % {len(STATUSES)} + 1] AS status
  FROM base)"""


def turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("ticket_id"), F.col("turn").alias("seq"), "role",
        F.concat("text", pick(SNIPPETS, F.col("conv_id") * 7 + F.col("turn"))).alias("body"),
    )


def tickets_and_comments(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Tickets without comments, and their comments, from the conversations."""
    t = turns(spark, sf)
    per = t.groupBy("ticket_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.min(F.when(F.col("role") == "user", F.col("seq"))).alias("first")
    )
    joined = t.join(per, "ticket_id")
    is_first = F.col("seq") == F.col("first")
    first = joined.filter(is_first).select("ticket_id", F.col("body").alias("description"))
    i = F.col("ticket_id")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    tickets = per.join(first, "ticket_id", "left").select(
        "ticket_id",
        F.when(i % 7 != 0, F.concat(F.lit("Consulta "), i.cast("string"))).alias("subject"),
        "description",
        (at + F.make_interval(hours=i.cast("int"))).alias("created_at"),
        (at + F.make_interval(hours=(i + F.col("n_turns") * 3).cast("int"))).alias("updated_at"),
        F.array(
            F.concat(F.lit("canal"), (i % 3).cast("string")), F.concat(F.lit("tema"), (i % 5).cast("string"))
        ).alias("tags"),
        pick(CHANNEL_WORDS, i).alias("channel"),
        F.when(i % 4 != 0, i % 11).alias("assignee_id"),
        pick(STATUSES, i).alias("status"),
        F.lit(None).cast("string").alias("priority"), F.lit(None).cast("string").alias("requester_email"),
    )
    comments = joined.filter(F.col("first").isNull() | ~is_first).select(
        "ticket_id", "seq", F.col("seq").alias("id"), "body",
        F.when(F.col("role") == "user", 1).otherwise(2).cast("long").alias("author_id"),
        (F.col("role") == "user").alias("public"), F.lit(None).cast("string").alias("created_at"),
    )
    return tickets, comments


def raw_tickets(spark: SparkSession, sf: str) -> DataFrame:
    """The raw table: tickets with comments_json."""
    return attach_comments(*tickets_and_comments(spark, sf))


# --- cleaning in SQL, from list operations rather than one pattern -------------
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
WS_LINE = r"[ \t\r\f\x0b\x1c-\x1f\x85\p{Z}]"


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, {sql_text(rf'^{WS}+|{WS}+$')}, '', 'g')"


def sql_cut(c: str, anchors: tuple[str, ...], or_line: str = "false") -> str:
    """Lines before the first that an anchor matches, found by list position."""
    starts = sql_text("(?i)" + "|".join("^" + a for a in anchors))
    hit = f"regexp_matches(l, {starts}) OR {or_line}"
    lines = f"string_split({c}, chr(10))"
    return (
        f"array_to_string(list_slice({lines}, 1, coalesce("
        f"list_position(list_transform({lines}, lambda l: {hit}), true) - 1, len({lines}))), chr(10))"
    )


def sql_normalize(c: str) -> str:
    c = f"regexp_replace({c}, {sql_text('[ ' + chr(92) + 't]+')}, ' ', 'g')"
    c = f"regexp_replace({c}, {sql_text(chr(92) + 'n{3,}')}, chr(10) || chr(10), 'g')"
    lines = f"list_transform(string_split({c}, chr(10)), lambda l: {sql_strip('l')})"
    return sql_strip(f"array_to_string({lines}, chr(10))")


def sql_decode(c: str) -> str:
    """The entities that occur in the tables; the ampersand last, in one pass."""
    for name, char in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">")):
        c = f"replace({c}, '{name}', {sql_text(char)})"
    return f"regexp_replace({c}, '&amp;?', '&', 'g')"

"""Queries over the cleaning steps (TX, CH, MSG, JOB1, FLT4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketmill.catalog.base import (
    DECORATED_SQL,
    CHANNEL_WORDS,
    TICKETS_SQL,
    decorated,
    pick,
    query,
    raw_tickets,
    sql_cut,
    sql_decode,
    sql_list,
    sql_normalize,
    sql_strip,
    sql_text,
    table,
    tickets_and_comments,
    turns,
)
from ticketmill.functions import text as X
from ticketmill.operators import cleaning as C
from ticketmill.operators.comments import explode_messages

RE2_URL = r"(?i)https?://(?:[-\pL\pN_.]|(?:%[0-9a-fA-F]{2}))+[^\s\p{Z}\x85]*"
RE2_MENTION = r"@[\pL\pN_]+"
AUTO_SQL = " OR ".join(f"contains(lower({{c}}), {sql_text(p)})" for p in X.AUTO_PHRASES)


def auto(c: str) -> str:
    return "(" + AUTO_SQL.replace("{c}", c) + ")"


def sql_urls(c: str) -> str:
    return f"regexp_replace({c}, {sql_text(RE2_URL)}, '[URL]', 'g')"


def sql_quotes(c: str) -> str:
    return sql_cut(c, X.QUOTE_ANCHORS, f"starts_with({sql_strip('l')}, '>')")


def sql_signature(c: str) -> str:
    return sql_cut(c, X.SIGNATURE_ANCHORS)


def sql_mentions(c: str) -> str:
    return f"regexp_replace({c}, {sql_text(RE2_MENTION)}, '[USUARIO]', 'g')"


def sql_tags(c: str) -> str:
    return f"regexp_replace({c}, '<[^>]+>', ' ', 'g')"


def channel_sql(c: str) -> str:
    low = f"lower({c})"

    def has(*words: str) -> str:
        return " OR ".join(f"contains({low}, '{w}')" for w in words)

    return (
        f"CASE WHEN {has('mail')} THEN 'email' "
        f"WHEN {has('twitter', 'facebook', 'instagram', 'social')} THEN 'social' "
        f"WHEN {has('web', 'form')} THEN 'web' WHEN {has('chat')} THEN 'chat' ELSE 'other' END"
    )


def cleaned_sql(source: str, keep: str, c: str = "text", kind: str = "kind") -> str:
    """CTEs that clean column ``c`` of ``source`` by ``kind``; the last is named done."""
    return f"""
decoded AS (SELECT {keep}, {kind}, {sql_urls(sql_decode(sql_tags(c)))} AS t FROM {source}),
unsigned AS (SELECT {keep}, {kind}, t, {sql_signature('t')} AS s FROM decoded),
bodies AS (
  SELECT {keep}, {kind}, CASE WHEN {kind} IN ('email', 'web') THEN {sql_quotes('s')}
              WHEN {kind} = 'social' THEN {sql_mentions('t')} ELSE t END AS t
  FROM unsigned),
done AS (SELECT {keep}, {kind}, {sql_normalize('t')} AS t FROM bodies)"""


@query("tx1_strip_tags", f"SELECT page_id, {sql_tags('html')} AS text FROM pages")
def tx1(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.strip_tags(F.col("html")).alias("text"))


@query("tx2_strip_html_decode_entities", f"SELECT page_id, {sql_decode(sql_tags('html'))} AS html FROM pages")
def tx2(spark, sf):
    return C.strip_html(table(spark, sf, "pages").select("page_id", "html"), "html")


def _step(name: str, sql: str, step) -> None:
    query(name, f"WITH {DECORATED_SQL} SELECT doc_id, {sql} AS text FROM decorated")(
        lambda spark, sf: step(decorated(spark, sf), "text")
    )


_step("tx3_mask_urls", sql_urls("text"), C.mask_urls)
_step("tx4_cut_signature", sql_signature("text"), C.cut_signature)
_step("tx5_cut_quotes", sql_quotes("text"), C.cut_quotes)
_step("tx7_mask_mentions", sql_mentions("text"), C.mask_mentions)
_step("tx8_normalize_whitespace", sql_normalize("text"), C.normalize_ws)


@query("tx6_flag_auto_response", f"WITH {DECORATED_SQL} SELECT doc_id, {auto('text')} AS is_auto FROM decorated")
def tx6(spark, sf):
    return C.flag_auto(decorated(spark, sf), "text").select("doc_id", "is_auto")


_KINDS = ["email", "social", "web", "chat", "other"]


@query("tx9_clean_text_by_channel", f"""
WITH {DECORATED_SQL},
src AS (SELECT doc_id, text, {sql_list(_KINDS)}[doc_id // 16 % 5 + 1] AS kind FROM decorated),
{cleaned_sql('src', 'doc_id')}
SELECT doc_id, kind AS channel, t AS text FROM done""")
def tx9(spark, sf):
    df = decorated(spark, sf).withColumn("channel", pick(_KINDS, F.floor(F.col("doc_id") / 16)))
    return C.clean_text(df, "text", "channel")


@query("ch1_channel_class", f"""
WITH src AS (SELECT doc_id, {sql_list(CHANNEL_WORDS)}[doc_id % {len(CHANNEL_WORDS)} + 1] AS c FROM documents)
SELECT {channel_sql('c')} AS channel, count(*) AS tickets FROM src GROUP BY 1""")
def ch1(spark, sf):
    word = F.coalesce(pick(CHANNEL_WORDS, F.col("doc_id")), F.lit(""))
    return table(spark, sf, "documents").groupBy(X.channel_class(word).alias("channel")).agg(
        F.count(F.lit(1)).alias("tickets")
    )


@query("flt4_drop_empty_and_auto", f"""
WITH {TICKETS_SQL}, n AS (SELECT ticket_id, seq, {sql_normalize('body')} AS body FROM turns)
SELECT ticket_id, seq, body FROM n WHERE body <> '' AND NOT {auto('body')}""")
def flt4(spark, sf):
    return C.drop_empty_and_auto(C.normalize_ws(turns(spark, sf).drop("role"), "body"), "body")


@query("msg_explode_roles", f"""
WITH {TICKETS_SQL},
numbered AS (
  SELECT ticket_id, row_number() OVER (PARTITION BY ticket_id ORDER BY seq) - 1 AS seq,
         CASE WHEN role = 'user' THEN 'customer' ELSE 'agent' END AS role, body
  FROM comments WHERE body <> '')
SELECT * FROM numbered
UNION ALL SELECT ticket_id, -1, 'customer', description FROM base WHERE description <> ''""")
def msg_roles(spark, sf):
    # Positions count messages within the ticket; the description is -1.
    return explode_messages(raw_tickets(spark, sf))


@query("src2_attach_comments", f"""
WITH {TICKETS_SQL}
SELECT t.ticket_id, count(c.seq) AS n_comments, coalesce(sum(length(c.body)), 0)::BIGINT AS chars,
       coalesce(string_agg(c.body, '|' ORDER BY c.seq), '') AS bodies
FROM tickets t LEFT JOIN comments c ON c.ticket_id = t.ticket_id GROUP BY t.ticket_id""")
def src2(spark, sf):
    items = F.from_json("comments_json", "array<struct<id:bigint,body:string>>")
    return raw_tickets(spark, sf).select("ticket_id", items.alias("x")).select(
        "ticket_id", F.size("x").cast("long").alias("n_comments"),
        F.aggregate("x", F.lit(0).cast("long"), lambda s, c: s + F.length(c["body"])).alias("chars"),
        F.array_join(F.transform("x", lambda c: c["body"]), "|").alias("bodies"),
    )


@query("src3_normalize_comments", f"""
WITH {TICKETS_SQL}
SELECT ticket_id, seq, seq AS id, body, CASE WHEN role = 'user' THEN 1 ELSE 2 END::BIGINT AS author_id,
       role = 'user' AS public, CAST(NULL AS VARCHAR) AS created_at
FROM comments""")
def src3(spark, sf):
    from ticketmill.operators.comments import normalize_comments

    return normalize_comments(tickets_and_comments(spark, sf)[1])


CLEAN_TICKETS_SQL = f"""{TICKETS_SQL},
spoken AS (
  SELECT ticket_id, -1 AS seq, 'customer' AS role, description AS text FROM base WHERE description <> ''
  UNION ALL
  SELECT ticket_id, seq, CASE WHEN role = 'user' THEN 'customer' ELSE 'agent' END, body
  FROM comments WHERE body <> ''),
kinds AS (
  SELECT s.*, {channel_sql("coalesce(t.channel, '')")} AS kind
  FROM spoken s JOIN tickets t ON t.ticket_id = s.ticket_id),
{cleaned_sql('kinds', 'ticket_id, seq, role')},
kept AS (SELECT * FROM done WHERE t <> '' AND NOT {auto('t')}),
parts AS (
  SELECT ticket_id,
         string_agg(t, chr(10) || chr(10) ORDER BY seq) FILTER (WHERE role = 'customer') AS c,
         string_agg(t, chr(10) || chr(10) ORDER BY seq) FILTER (WHERE role = 'agent') AS a
  FROM kept GROUP BY ticket_id),
clean0 AS (
  SELECT t.ticket_id, {channel_sql("coalesce(t.channel, '')")} AS channel,
         coalesce(p.c, '') AS text_customer_only, coalesce(p.a, '') AS text_agent_only,
         concat_ws(chr(10) || chr(10), CASE WHEN subject <> '' THEN 'Asunto: ' || subject END, p.c, p.a) AS text_full
  FROM tickets t LEFT JOIN parts p ON p.ticket_id = t.ticket_id),
clean AS (
  SELECT *, len(list_filter(regexp_split_to_array(text_full, {sql_text(r'[\s\x0b\x1c-\x1f\x85\p{Z}]+')}),
                            lambda w: w <> '')) AS word_count
  FROM clean0)"""


@query("job1_clean_tickets", f"""
WITH {CLEAN_TICKETS_SQL}
SELECT ticket_id, channel, text_full, text_customer_only, text_agent_only, word_count FROM clean""")
def job1(spark, sf):
    return C.clean_tickets(raw_tickets(spark, sf)).drop("is_faulty")


@query("msg6_word_counts", f"""
WITH {CLEAN_TICKETS_SQL}
SELECT channel, count(*) AS tickets, sum(word_count)::BIGINT AS words, max(word_count) AS longest
FROM clean GROUP BY channel""")
def msg6(spark, sf):
    return C.clean_tickets(raw_tickets(spark, sf)).groupBy("channel").agg(
        F.count(F.lit(1)).alias("tickets"), F.sum("word_count").alias("words"),
        F.max("word_count").alias("longest"),
    )

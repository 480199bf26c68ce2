"""Queries over sources, sinks, joins, filters, windows, sorts and streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.catalog.base import (
    TICKETS_SQL,
    query,
    raw_tickets,
    table,
    tickets_and_comments,
)
from ticketmill.operators import profile as E
from ticketmill.operators import tickets as K
from ticketmill.operators.quality import coverage
from ticketmill.session import fresh_path
from ticketmill.sources import landing as L
from ticketmill.sources import tables as S
from ticketmill.streaming import ingest as I

# --- landing files ---------------------------------------------------------------


def write_landing(spark, sf, files: int | None = None, damage: bool = False) -> str:
    """Every conversation as a ticket JSON line; with ``damage``, status-less ones are cut short."""
    raw = raw_tickets(spark, sf)
    requester = F.when(
        F.col("ticket_id") % 3 == 0, F.parse_json(F.lit("5"))
    ).otherwise(F.parse_json(F.concat(F.lit('{"email":"u'), F.col("ticket_id"), F.lit('@example.com"}'))))
    line = F.to_json(F.struct(
        F.col("ticket_id").alias("id"), "subject", "description",
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"),
        F.when(F.col("ticket_id") % 6 != 0, F.col("tags")).alias("tags"),
        F.struct(F.col("channel")).alias("via"), "assignee_id", "status", requester.alias("requester"),
        F.parse_json("comments_json").alias("comments"),
    ))
    if damage:
        line = F.when(F.col("status").isNull(), F.substring(line, 1, 40)).otherwise(line)
    out = raw.select(line.alias("value"))
    path = fresh_path(spark, "landing")
    (out.repartition(files) if files else out).write.text(path)
    return path


_LANDED_SQL = f"""{TICKETS_SQL},
landed AS (
  SELECT ticket_id, subject, description, created_at, updated_at,
         CASE WHEN ticket_id % 6 = 0 THEN '' ELSE array_to_string(tags, ',') END AS tags,
         channel, assignee_id::VARCHAR AS assignee_id, status,
         CASE WHEN ticket_id % 3 = 0 THEN NULL ELSE 'u' || ticket_id || '@example.com' END AS requester_email
  FROM tickets)"""

def _landed(df):
    return df.select(
        "ticket_id", "subject", "description", F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"), F.array_join("tags", ",").alias("tags"),
        "channel", F.col("assignee_id").cast("string").alias("assignee_id"), "status", "requester_email",
    )


@query("src1_read_landing", f"WITH {_LANDED_SQL} SELECT * FROM landed")
def src1(spark, sf):
    return _landed(L.read_tickets(spark, write_landing(spark, sf)))


@query("src4_to_raw_rows", f"""
WITH {TICKETS_SQL},
j AS (
  SELECT ticket_id, string_agg('{{"id":' || seq || ',"body":' || to_json(body) || ',"author_id":'
         || CASE WHEN role = 'user' THEN 1 ELSE 2 END || ',"public":' || (role = 'user') || ',"created_at":null}}',
         ',' ORDER BY seq) AS x
  FROM comments GROUP BY ticket_id)
SELECT t.ticket_id, subject, description, '[' || coalesce(x, '') || ']' AS comments_json, channel, status
FROM tickets t LEFT JOIN j ON j.ticket_id = t.ticket_id""")
def src4(spark, sf):
    return L.to_raw_rows(raw_tickets(spark, sf)).select(
        "ticket_id", "subject", "description", "comments_json", "channel", "status"
    )


@query("src5_get_ticket", f"WITH {TICKETS_SQL} SELECT ticket_id, subject, description, channel FROM tickets WHERE ticket_id = 15")
def src5(spark, sf):
    """A point lookup by its nature; the table is searched whole."""
    return K.get_ticket(tickets_and_comments(spark, sf)[0], 15).select(
        "ticket_id", "subject", "description", "channel"
    )


@query("src6_load_embeddings", """
SELECT vec_id AS ticket_id, len(embedding) AS dims, round(list_sum(embedding::DOUBLE[]), 4) AS total FROM embeddings""")
def src6(spark, sf):
    e = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("ticket_id"), F.col("embedding").cast("array<double>").alias("embedding_vector")
    )
    return S.load_embeddings(e).select(
        "ticket_id", F.size("embedding_vector").cast("long").alias("dims"),
        F.round(F.aggregate("embedding_vector", F.lit(0.0), lambda s, x: s + x), 4).alias("total"),
    )


@query("src7_eda_sample", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 10000")
def src7(spark, sf):
    return E.sample_rows(table(spark, sf, "orders"), key="o_orderkey").select("o_orderkey", "o_orderstatus")


# --- sinks -------------------------------------------------------------------------

_FEEDBACK_SQL = """
fb AS (
  SELECT doc_id::VARCHAR AS feedback_id, doc_id::VARCHAR AS suggestion_id, doc_id AS ticket_id,
         CASE WHEN toxic = 1 THEN 'reject' WHEN quality = 1 THEN 'accept' ELSE 'edit' END AS action,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(doc_id % 2000 AS INT)) AS created_at
  FROM labels)"""


def feedback(spark, sf):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("feedback_id"), F.col("doc_id").cast("string").alias("suggestion_id"),
        F.col("doc_id").alias("ticket_id"),
        F.when(F.col("toxic") == 1, "reject").when(F.col("quality") == 1, "accept").otherwise("edit").alias("action"),
        (at + F.make_interval(hours=(F.col("doc_id") % 2000).cast("int"))).alias("created_at"),
    )


@query("snk1_append", f"WITH {_FEEDBACK_SQL} SELECT action, 2 * count(*) AS n FROM fb GROUP BY 1")
def snk1(spark, sf):
    from ticketmill.schemas import FEEDBACK

    path, rows = fresh_path(spark, "append"), feedback(spark, sf)
    S.append(rows, path, FEEDBACK)
    S.append(rows, path, FEEDBACK)
    return spark.read.schema(FEEDBACK).parquet(path).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("set1_union_all", f"""
WITH {_FEEDBACK_SQL}, u AS (SELECT * FROM fb UNION ALL SELECT * FROM fb)
SELECT action, count(*) AS n, count(DISTINCT feedback_id) AS ids FROM u GROUP BY 1""")
def set1(spark, sf):
    rows = feedback(spark, sf)
    return rows.unionByName(rows).groupBy("action").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("feedback_id").alias("ids")
    )


@query("snk3_ensure_tables", """
SELECT * FROM (VALUES ('clean.tickets', 8), ('features.clusters', 7), ('features.embeddings', 4),
  ('features.feedback', 8), ('features.intents', 12), ('features.suggestions', 8), ('raw.tickets', 13), ('raw.quarantine', 14)) t(name, cols)
CROSS JOIN (SELECT count(*) AS feedback_rows FROM labels)""")
def snk3(spark, sf):
    """All tables created; the feedback table then takes every label."""
    made = S.ensure_tables(spark, fresh_path(spark, "tables"))
    made["features.feedback"].upsert(feedback(spark, sf), keep=(), order=("created_at",))
    names = spark.createDataFrame([(n, len(t.schema)) for n, t in made.items()], "name string, cols int")
    rows = made["features.feedback"].read().agg(F.count(F.lit(1)).alias("feedback_rows"))
    return names.withColumn("_one", F.lit(1)).join(F.broadcast(rows.withColumn("_one", F.lit(1))), "_one").drop("_one")


USER_STATE = T.StructType([
    T.StructField("user_id", T.LongType(), False), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()), T.StructField("seq", T.LongType()),
])
_EARLY = ("view", "click")


def user_events(spark, sf):
    return table(spark, sf, "events").select(
        "user_id", "event_type", "value", F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"),
        F.col("event_id").alias("seq"),
    )


_UPSERT_SQL = """
WITH ranked AS (
  SELECT *, event_type IN ('view', 'click') AS early,
         row_number() OVER (PARTITION BY user_id, event_type IN ('view', 'click')
                            ORDER BY ts DESC, event_id DESC) AS rn
  FROM events),
a AS (SELECT * FROM ranked WHERE rn = 1 AND early),
b AS (SELECT * FROM ranked WHERE rn = 1 AND NOT early)
SELECT coalesce(b.user_id, a.user_id) AS user_id, coalesce(b.event_type, a.event_type) AS event_type,
       coalesce(b.value, a.value) AS value, coalesce(a.ts, b.ts) AS created_at,
       coalesce(b.ts, a.ts) AS updated_at, coalesce(b.event_id, a.event_id) AS seq
FROM a FULL JOIN b ON a.user_id = b.user_id"""


@query("snk2_upsert_snapshot_table", _UPSERT_SQL)
def snk2(spark, sf):
    """Two batches into a keyed table: browsing events first, then all others."""
    target = S.SnapshotTable(spark, fresh_path(spark, "users"), USER_STATE, ("user_id",)).ensure()
    e = user_events(spark, sf)
    early = F.col("event_type").isin(*_EARLY)
    target.upsert(e.filter(early), order=("updated_at", "seq"))
    target.upsert(e.filter(~early), order=("updated_at", "seq"))
    return target.read()


@query("snk2_upsert_frame", _UPSERT_SQL)
def snk2_frame(spark, sf):
    e = user_events(spark, sf)
    early, order = F.col("event_type").isin(*_EARLY), ("updated_at", "seq")
    base = K.latest_version(e.filter(early), ("user_id",), order)
    return S.upsert(base, e.filter(~early), ("user_id",), order=order)


@query("agg13_upsert_counts", """
WITH a AS (SELECT DISTINCT user_id FROM events WHERE event_type IN ('view', 'click')),
     b AS (SELECT DISTINCT user_id FROM events WHERE event_type NOT IN ('view', 'click'))
SELECT count(*) FILTER (WHERE a.user_id IS NULL) AS inserted, count(a.user_id) AS updated
FROM b LEFT JOIN a ON a.user_id = b.user_id""")
def agg13(spark, sf):
    e = user_events(spark, sf)
    early = F.col("event_type").isin(*_EARLY)
    known = e.filter(early).select("user_id").distinct()
    return S.upsert_counts(known, e.filter(~early), ("user_id",))


# --- streams -------------------------------------------------------------------------

_LATEST_SQL = """
SELECT user_id, event_type, value, ts AS updated_at, event_id AS seq FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


@query("str1_stream_upsert", _LATEST_SQL)
def str1(spark, sf):
    """Events as a file stream in several micro-batches, upserted by user; order of arrival is moot."""
    folder = fresh_path(spark, "event-files")
    user_events(spark, sf).repartition(4).write.parquet(folder)
    source = spark.readStream.schema(USER_STATE).option("maxFilesPerTrigger", 2).parquet(folder)
    target = S.SnapshotTable(spark, fresh_path(spark, "users"), USER_STATE, ("user_id",)).ensure()
    I.stream_upsert(source, target, fresh_path(spark, "ck"), order=("updated_at", "seq"))
    return target.read().drop("created_at")


@query("str1_incremental_tickets", f"WITH {_LANDED_SQL} SELECT * FROM landed WHERE status IS NOT NULL")
def str1_tickets(spark, sf):
    """Landing files with damaged lines, taken up incrementally; bad lines go to quarantine."""
    target = S.table(spark, fresh_path(spark, "inc"), "raw.tickets").ensure()
    I.run_incremental(
        spark, write_landing(spark, sf, 3, damage=True), target, fresh_path(spark, "ck"),
        fresh_path(spark, "bad"), start=F.lit("2000-01-01").cast("timestamp"), max_files=2,
    )
    return _landed(target.read())


@query("str3_checkpoint_resume", f"""
WITH {TICKETS_SQL}, n AS (SELECT count(*) AS t FROM tickets)
SELECT 1 AS run, t AS inserted, 0::BIGINT AS updated FROM n UNION ALL SELECT 2, 0, 0 FROM n""")
def str3(spark, sf):
    """A second run on the same checkpoint finds nothing new."""
    where, ck, bad = write_landing(spark, sf), fresh_path(spark, "ck"), fresh_path(spark, "bad")
    target = S.table(spark, fresh_path(spark, "inc"), "raw.tickets").ensure()
    runs = []
    for run in (1, 2):
        s = I.run_incremental(spark, where, target, ck, bad, start=F.lit("2000-01-01").cast("timestamp"))
        runs.append((run, s.inserted, s.updated))
    return spark.createDataFrame(runs, "run int, inserted long, updated long")


@query("str2_backfill", f"WITH {_LANDED_SQL} SELECT * FROM landed WHERE updated_at >= TIMESTAMP '2024-01-02 12:00:00'")
def str2(spark, sf):
    target = S.table(spark, fresh_path(spark, "bf"), "raw.tickets").ensure()
    I.run_backfill(spark, write_landing(spark, sf), target, start=F.lit("2024-01-02 12:00:00").cast("timestamp"))
    return _landed(target.read())


@query("str4_late_updates", """
WITH last AS (
  SELECT user_id, ts, event_id FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, ts AS updated_at, event_id AS seq FROM last""")
def str4(spark, sf):
    """The newest batch first, everything older after it: nothing is undone."""
    target = S.SnapshotTable(spark, fresh_path(spark, "users"), USER_STATE, ("user_id",)).ensure()
    e, order = user_events(spark, sf), ("updated_at", "seq")
    recent = F.col("updated_at") >= F.lit("2024-01-20").cast("timestamp_ntz")
    target.upsert(e.filter(recent), order=order, newest_wins=True)
    target.upsert(e.filter(~recent), order=order, newest_wins=True)
    return target.read().select("user_id", "updated_at", "seq")


# --- filters ---------------------------------------------------------------------------


@query("flt1_time_range", "SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1")
def flt1(spark, sf):
    start = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return K.time_range(table(spark, sf, "events"), start, "ts").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("flt2_first_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def flt2(spark, sf):
    """A job limit by its nature: a top-k by key."""
    return K.first_n(table(spark, sf, "orders"), 100, "o_orderkey").select("o_orderkey", "o_totalprice")


@query("flt3_text_not_null", """
SELECT lang, count(*) AS n FROM (SELECT lang, CASE WHEN source <> 'src3' THEN text END AS text FROM documents)
WHERE text IS NOT NULL GROUP BY 1""")
def flt3(spark, sf):
    d = table(spark, sf, "documents").select("lang", F.when(F.col("source") != "src3", F.col("text")).alias("text"))
    return K.with_text(d, "text").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("flt6_quarantine", f"""
WITH {TICKETS_SQL}
SELECT count(*) FILTER (WHERE status IS NOT NULL) AS good, count(*) FILTER (WHERE status IS NULL) AS bad FROM tickets""")
def flt6(spark, sf):
    lines = L.landing_lines(spark, write_landing(spark, sf, damage=True))
    return lines.agg(F.count_if(~L.is_bad(lines)).alias("good"), F.count_if(L.is_bad(lines)).alias("bad"))


_DOC_CLUSTER_SQL = "CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 WHEN 'es' THEN 3 ELSE -1 END"


def doc_cluster():
    return F.coalesce(*[F.when(F.col("lang") == k, F.lit(i)) for i, k in enumerate(("en", "fr", "de", "es"))], F.lit(-1)).cast("long")


@query("flt7_ticket_list", f"""
SELECT doc_id AS ticket_id, source AS channel, lang FROM documents d
WHERE source = 'src3' AND TIMESTAMP '2024-01-01' + to_minutes(n_chars::INT) >= TIMESTAMP '2024-01-01 06:00:00'
  AND TIMESTAMP '2024-01-01' + to_minutes(n_chars::INT) < TIMESTAMP '2024-02-15'
  AND {_DOC_CLUSTER_SQL} = 0 AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def flt7(spark, sf):
    d = table(spark, sf, "documents")
    t = d.select(
        F.col("doc_id").alias("ticket_id"), F.col("source").alias("channel"), "lang",
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(mins=F.col("n_chars").cast("int"))).alias("processed_at"),
    )
    clusters = d.select(F.col("doc_id").alias("ticket_id"), doc_cluster().alias("cluster_id"))
    suggestions = table(spark, sf, "labels").select(F.col("doc_id").alias("ticket_id"))
    return K.filter_tickets(
        t, channel="src3", since=F.lit("2024-01-01 06:00:00").cast("timestamp"),
        until=F.lit("2024-02-15").cast("timestamp"), clusters=clusters, intent_cluster=0,
        suggestions=suggestions, with_suggestion=False,
    ).drop("processed_at")


# --- joins -------------------------------------------------------------------------------


@query("jn1_unprocessed", "SELECT doc_id, n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def jn1(spark, sf):
    return K.missing_from(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id").select("doc_id", "n_chars")


@query("jn2_unembedded", "SELECT doc_id FROM documents WHERE text IS NOT NULL AND doc_id NOT IN (SELECT vec_id FROM embeddings)")
def jn2(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return K.missing_from(K.with_text(table(spark, sf, "documents"), "text"), e, "doc_id").select("doc_id")


@query("jn3_existing_keys", """
SELECT c_mktsegment, count(*) FILTER (WHERE known) AS existing, count(*) FILTER (WHERE NOT known) AS new_keys
FROM (SELECT c_mktsegment, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS known FROM customer) GROUP BY 1""")
def jn3(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    old, new = K.present_in(c, o, "c_custkey"), K.missing_from(c, o, "c_custkey")
    return old.withColumn("known", F.lit(True)).unionByName(new.withColumn("known", F.lit(False))).groupBy(
        "c_mktsegment"
    ).agg(F.count_if("known").alias("existing"), F.count_if(~F.col("known")).alias("new_keys"))


@query("jn4_clusters_with_texts", """
SELECT vec_id AS ticket_id, label::BIGINT AS cluster_id, n_chars FROM embeddings JOIN documents ON doc_id = vec_id""")
def jn4(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("ticket_id"), F.col("label").cast("long").alias("cluster_id"))
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("ticket_id"), "n_chars")
    return e.join(d, "ticket_id")


# --- windows, sorts, samples ---------------------------------------------------------------


@query("win2_latest_version", _LATEST_SQL)
def win2(spark, sf):
    return K.latest_version(user_events(spark, sf), ("user_id",), ("updated_at", "seq")).drop("created_at")


@query("srt3_random_sample", "SELECT doc_id, lang FROM documents ORDER BY md5(doc_id || ':7'), doc_id LIMIT 100")
def srt3(spark, sf):
    """A sampling operator: 100 documents by hashed key."""
    return K.random_sample(table(spark, sf, "documents"), 100, 7, "doc_id").select("doc_id", "lang")


@query("srt4_order_by_key", "SELECT vec_id AS ticket_id, label FROM embeddings ORDER BY vec_id")
def srt4(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("ticket_id"), "label").orderBy("ticket_id")


# --- exploration -----------------------------------------------------------------------------


@query("agg9_value_counts_status", "SELECT o_orderstatus, count(*) AS count FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1")
def agg9(spark, sf):
    return E.value_counts(table(spark, sf, "orders"), "o_orderstatus")


@query("agg9_value_counts_channel", f"WITH {TICKETS_SQL} SELECT channel, count(*) AS count FROM tickets WHERE channel IS NOT NULL GROUP BY 1")
def agg9_channel(spark, sf):
    return E.value_counts(tickets_and_comments(spark, sf)[0], "channel")


_NUMERIC = ("o_totalprice", "o_custkey")


@query("agg10_describe", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       round(min({c})::DOUBLE, 4) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS p25,
       round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS p75,
       round(max({c})::DOUBLE, 4) AS max FROM orders""" for c in _NUMERIC))
def agg10(spark, sf):
    d = E.describe(table(spark, sf, "orders"), _NUMERIC)
    return d.withColumns({c: F.round(c, 4) for c in d.columns if c not in ("column_name", "count")})


@query("agg11_volume_by_date", "SELECT CAST(ts AS DATE) AS day, count(*) AS volume FROM events GROUP BY 1")
def agg11_volume(spark, sf):
    return E.volume_by_date(table(spark, sf, "events"), "ts")


@query("agg11_top_tags", f"""
WITH {TICKETS_SQL}
SELECT tag, count(*) AS tickets FROM (SELECT unnest(tags) AS tag FROM tickets) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def agg11_tags(spark, sf):
    return E.top_tags(tickets_and_comments(spark, sf)[0])


@query("agg11_text_length_quantiles", "\nUNION ALL\n".join(
    f"SELECT 'chars' AS column_name, {p}::DOUBLE AS prob, round(quantile_cont(length(text)::DOUBLE, {p}), 4) AS value FROM documents"
    for p in (0.05, 0.25, 0.5, 0.75, 0.95, 0.99)))
def agg11_lengths(spark, sf):
    d = table(spark, sf, "documents").select(F.length("text").alias("chars"))
    return E.exact_quantiles(d, ["chars"], (0.05, 0.25, 0.5, 0.75, 0.95, 0.99)).withColumn("value", F.round("value", 4))


@query("agg11_null_rates", f"""
WITH {TICKETS_SQL}
{' UNION ALL '.join(f"SELECT '{c}' AS column_name, count(*) AS total, count(*) - count({c}) AS nulls, round((count(*) - count({c})) / count(*), 4) AS null_rate FROM tickets" for c in ('subject', 'description', 'channel', 'assignee_id', 'status'))}""")
def agg11_nulls(spark, sf):
    t = tickets_and_comments(spark, sf)[0]
    return E.null_rates(t, ["subject", "description", "channel", "assignee_id", "status"]).withColumn(
        "null_rate", F.round("null_rate", 4)
    )


@query("agg16_ingest_coverage", """
SELECT (SELECT count(*) FROM labels) AS part_rows, (SELECT count(*) FROM documents) AS whole_rows,
       round((SELECT count(*) FROM labels) / (SELECT count(*) FROM documents), 4) AS coverage""")
def agg16(spark, sf):
    return coverage(table(spark, sf, "labels"), table(spark, sf, "documents")).withColumn("coverage", F.round("coverage", 4))

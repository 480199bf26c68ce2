"""Queries over vectors, clusters, labels, intents and KPIs (AGG4-17, ML, EMB, LB, INT, JN5-9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketmill.catalog.base import DECORATED_SQL, TICKETS_SQL, decorated, query, sql_strip, table, tickets_and_comments
from ticketmill.catalog.tables import _DOC_CLUSTER_SQL, _FEEDBACK_SQL, doc_cluster, feedback
from ticketmill.functions import vectors as V
from ticketmill.operators import centroids as N
from ticketmill.operators import agreement, density, embedding, kpis, labels, neighbors, reduction, silhouette
from ticketmill.operators import intents as T
from ticketmill.operators.tickets import missing_from, non_noise
from ticketmill.plans import jobs
from ticketmill.session import fresh_path, settle
from ticketmill.sources import tables as S

# Every seventh vector stands for noise, the rest keep their label as cluster.
POINTS_SQL = """
pts AS (
  SELECT vec_id AS ticket_id, CASE WHEN vec_id % 7 = 0 THEN -1 ELSE label END::BIGINT AS cluster_id,
         embedding::DOUBLE[] AS v FROM embeddings),
dims AS (SELECT ticket_id, cluster_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM pts),
mean AS (SELECT cluster_id, i, avg(x) AS m, count(*) AS volume FROM dims WHERE cluster_id >= 0 GROUP BY 1, 2),
cent AS (SELECT cluster_id, list(m ORDER BY i) AS c, max(volume) AS volume FROM mean GROUP BY 1)"""
CLUSTERS_SQL = POINTS_SQL + """,
near AS (
  SELECT p.ticket_id, min_by(c.cluster_id, list_distance(p.v, c.c)) AS nearest, min(list_distance(p.v, c.c)) AS d
  FROM pts p CROSS JOIN cent c GROUP BY 1),
clusters AS (
  SELECT p.ticket_id, p.cluster_id,
         CASE WHEN p.cluster_id < 0 THEN n.d ELSE list_distance(p.v, c.c) END AS distance_to_centroid
  FROM pts p JOIN near n ON n.ticket_id = p.ticket_id LEFT JOIN cent c ON c.cluster_id = p.cluster_id)"""


def points(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("ticket_id"),
        F.when(F.col("vec_id") % 7 == 0, -1).otherwise(F.col("label")).cast("long").alias("cluster_id"),
        F.col("embedding").cast("array<double>").alias("v"),
    )


def clusters(spark, sf):
    return N.distance_to_centroid(points(spark, sf), "ticket_id", "v").drop("v")


def r4(df, *cols):
    return df.withColumns({c: F.round(c, 4) for c in cols})


# --- aggregates and distances ------------------------------------------------------


@query("agg5_centroids", f"WITH {POINTS_SQL} SELECT cluster_id, i::INT AS dim, round(m, 4) AS value FROM mean")
def agg5(spark, sf):
    return N.centroids(points(spark, sf), "v").select(
        "cluster_id", F.posexplode("centroid").alias("dim", "value")
    ).withColumn("value", F.round("value", 4))


@query("ml4_distance_to_centroid", f"""
WITH {CLUSTERS_SQL} SELECT ticket_id, cluster_id, round(distance_to_centroid, 4) AS distance_to_centroid FROM clusters""")
def ml4(spark, sf):
    return r4(clusters(spark, sf), "distance_to_centroid")


@query("agg4_cluster_stats", f"""
WITH {CLUSTERS_SQL}
SELECT cluster_id, count(*) AS volume, round(avg(distance_to_centroid), 4) AS avg_distance,
       round(min(distance_to_centroid), 4) AS min_distance, round(max(distance_to_centroid), 4) AS max_distance
FROM clusters WHERE cluster_id >= 0 GROUP BY 1""")
def agg4(spark, sf):
    return r4(N.cluster_stats(clusters(spark, sf)), "avg_distance", "min_distance", "max_distance")


@query("srt2_top_clusters", f"""
WITH {CLUSTERS_SQL}
SELECT cluster_id, count(*) AS volume FROM clusters WHERE cluster_id >= 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""")
def srt2(spark, sf):
    return labels.top_clusters(N.cluster_stats(clusters(spark, sf)), 3).select("cluster_id", "volume")


@query("flt5_non_noise", f"WITH {POINTS_SQL} SELECT cluster_id, count(*) AS n FROM pts WHERE cluster_id >= 0 GROUP BY 1")
def flt5(spark, sf):
    return non_noise(points(spark, sf)).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))


@query("agg6_noise_summary", f"""
WITH {POINTS_SQL}
SELECT count(*) AS total_tickets, count(DISTINCT cluster_id) FILTER (WHERE cluster_id >= 0) AS n_clusters,
       count(*) FILTER (WHERE cluster_id < 0) AS noise_count,
       round(count(*) FILTER (WHERE cluster_id < 0) / count(*) * 100, 1) AS noise_pct FROM pts""")
def agg6(spark, sf):
    return N.noise_summary(points(spark, sf))


@query("agg7_noise_ratio", f"WITH {POINTS_SQL} SELECT round(count(*) FILTER (WHERE cluster_id < 0) / count(*), 4) AS noise_ratio FROM pts")
def agg7(spark, sf):
    return silhouette.noise_ratio(points(spark, sf))


@query("agg12_min_cluster_size", "SELECT greatest(20, trunc(count(*) * 0.03))::BIGINT AS min_cluster_size FROM documents")
def agg12(spark, sf):
    n = table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.greatest(
        F.lit(density.MIN_CLUSTER_SIZE).cast("long"), (F.col("n") * density.MIN_CLUSTER_SHARE).cast("long")
    ).alias("min_cluster_size"))


_SILHOUETTE_SQL = f"""
WITH {POINTS_SQL}, k AS (SELECT * FROM pts WHERE cluster_id >= 0),
per AS (
  SELECT a.ticket_id, a.cluster_id, b.cluster_id AS oc, sum(list_distance(a.v, b.v)) AS total, count(*) AS n
  FROM k a CROSS JOIN k b GROUP BY 1, 2, 3),
ab AS (
  SELECT ticket_id, cluster_id, max(CASE WHEN oc = cluster_id AND n > 1 THEN total / (n - 1) END) AS a,
         min(CASE WHEN oc <> cluster_id THEN total / n END) AS b FROM per GROUP BY 1, 2),
sil AS (SELECT ticket_id, cluster_id, CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)"""


@query("ml5_silhouette_points", f"{_SILHOUETTE_SQL} SELECT ticket_id, cluster_id, round(s, 4) AS silhouette FROM sil")
def ml5(spark, sf):
    return r4(silhouette.silhouette_points(points(spark, sf), "ticket_id", "v"), "silhouette")


@query("agg8_cluster_metrics", f"""
{_SILHOUETTE_SQL}
SELECT round(avg(s), 4) AS silhouette_score,
       round((SELECT count(*) FILTER (WHERE cluster_id < 0) / count(*) FROM pts), 4) AS noise_ratio FROM sil""")
def agg8(spark, sf):
    return silhouette.cluster_metrics(points(spark, sf), "ticket_id", "v")


@query("ml5_squared_silhouette", f"""
WITH {POINTS_SQL}, k AS (SELECT * FROM pts WHERE cluster_id >= 0),
per AS (
  SELECT a.ticket_id, a.cluster_id, b.cluster_id AS oc, sum(list_distance(a.v, b.v) ** 2) AS total, count(*) AS n
  FROM k a CROSS JOIN k b GROUP BY 1, 2, 3),
ab AS (
  SELECT ticket_id, max(CASE WHEN oc = cluster_id THEN total / (n - 1) END) AS a,
         min(CASE WHEN oc <> cluster_id THEN total / n END) AS b FROM per GROUP BY 1)
SELECT round(avg((b - a) / greatest(a, b)), 4) AS squared_silhouette FROM ab""")
def ml5_squared(spark, sf):
    return r4(silhouette.squared_silhouette(points(spark, sf), "v"), "squared_silhouette")


# --- nearest centroids and neighbours ------------------------------------------------


@query("jn5_noise_to_nearest_centroid", f"""
WITH {CLUSTERS_SQL}
SELECT p.ticket_id, n.nearest AS cluster_id, round(n.d, 4) AS distance
FROM pts p JOIN near n ON n.ticket_id = p.ticket_id WHERE p.cluster_id < 0""")
def jn5(spark, sf):
    p = settle(points(spark, sf), "points")
    cents = settle(N.centroids(p, "v"), "centroids")
    return r4(N.nearest_centroid(p.filter("cluster_id < 0"), cents, "ticket_id", "v"), "distance")


@query("jn8_detect_intent", f"""
WITH {CLUSTERS_SQL}
SELECT ticket_id, CASE WHEN d > 0.98 THEN 'no_intent' ELSE nearest::VARCHAR END AS intent_id, round(d, 4) AS distance
FROM near""")
def jn8(spark, sf):
    p = settle(points(spark, sf), "points")
    cents = settle(N.centroids(p, "v"), "centroids")
    return r4(T.detect_intent(p, cents, "ticket_id", "v", 0.98), "distance")


_KNN_SQL = """
WITH u AS (
  SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS v
  FROM embeddings),
d AS (
  SELECT a.vec_id, b.vec_id AS neighbor_id, list_distance(a.v, b.v) AS distance
  FROM u a JOIN u b ON a.vec_id <> b.vec_id),
top AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS rank FROM d
  QUALIFY rank <= 5)"""


@query("jn9_top_k_similar", f"{_KNN_SQL} SELECT vec_id, rank, neighbor_id, round(distance, 4) AS distance FROM top")
def jn9(spark, sf):
    return r4(neighbors.top_k_similar(table(spark, sf, "embeddings"), "vec_id", "embedding", 5), "distance")


@query("jn9_top_k_lsh", "SELECT count(*) AS vectors, true AS recalled FROM embeddings")
def jn9_lsh(spark, sf):
    """The hashed route held against the exact one, over all vectors: recall of 0.95 or more."""
    e = table(spark, sf, "embeddings")
    found, exact = (
        settle(neighbors.top_k_similar(e, "vec_id", "embedding", 5, method=m).select("vec_id", "neighbor_id"), "near")
        for m in ("lsh", "exact")
    )
    both = exact.join(found.withColumn("hit", F.lit(1)), ["vec_id", "neighbor_id"], "left")
    return both.agg(
        F.count_distinct("vec_id").alias("vectors"), (F.count("hit") >= 0.95 * F.count(F.lit(1))).alias("recalled"))


@query("jn9_similar_ticket_ids", f"""
{_KNN_SQL}
SELECT vec_id, string_agg(neighbor_id::VARCHAR, ',' ORDER BY rank) AS similar_ticket_ids FROM top GROUP BY 1""")
def jn9_ids(spark, sf):
    found = neighbors.top_k_similar(table(spark, sf, "embeddings"), "vec_id", "embedding", 5)
    return neighbors.similar_ids(found, "vec_id").select(
        "vec_id", F.array_join(F.col("similar_ticket_ids").cast("array<string>"), ",").alias("similar_ticket_ids")
    )


# --- examples and labels ----------------------------------------------------------------

_TEXTS_SQL = "texts AS (SELECT doc_id AS ticket_id, text AS text_customer_only, text AS text_full FROM documents)"


def texts(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("ticket_id"), F.col("text").alias("text_customer_only"), F.col("text").alias("text_full")
    )


_EXAMPLES_SQL = f"""
WITH {CLUSTERS_SQL}, {_TEXTS_SQL},
ex AS (
  SELECT cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY distance_to_centroid, c.ticket_id) AS rank,
         c.ticket_id, distance_to_centroid, text_customer_only
  FROM clusters c JOIN texts t ON t.ticket_id = c.ticket_id WHERE cluster_id >= 0 QUALIFY rank <= 5)"""


@query("win1_cluster_examples", f"""
{_EXAMPLES_SQL} SELECT cluster_id, rank, ticket_id, round(distance_to_centroid, 4) AS distance_to_centroid, text_customer_only FROM ex""")
def win1(spark, sf):
    return r4(labels.cluster_examples(clusters(spark, sf), texts(spark, sf)), "distance_to_centroid").drop("text_full")


@query("lb1_label_prompts", f"""
{_EXAMPLES_SQL}
SELECT cluster_id, string_agg('Ejemplo ' || rank || ':' || chr(10) || substring(text_customer_only, 1, 500),
                              chr(10) || chr(10) ORDER BY rank) AS examples_text FROM ex GROUP BY 1""")
def lb1(spark, sf):
    return labels.label_prompts(labels.cluster_examples(clusters(spark, sf), texts(spark, sf)))


_TERMS_SQL = r"""
WITH w AS (
  SELECT lang, unnest(string_split_regex(lower(text), '[^\pL\pN]+')) AS term FROM documents),
per AS (SELECT lang, term, count(*) AS n FROM w WHERE length(term) >= 3 GROUP BY 1, 2),
size AS (SELECT lang, sum(n)::BIGINT AS words FROM per GROUP BY 1),
uses AS (SELECT term, sum(n)::BIGINT AS uses FROM per GROUP BY 1),
scored AS (
  SELECT lang, term, round(n / words * ln(1 + (SELECT avg(words) FROM size) / uses), 9) AS score
  FROM per JOIN size USING (lang) JOIN uses USING (term)),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, term) AS rank FROM scored QUALIFY rank <= 4)"""


@query("lb2_class_terms", f"{_TERMS_SQL} SELECT lang, rank::INT AS rank, term, round(score, 4) AS score FROM top")
def lb2(spark, sf):
    return r4(labels.class_terms(table(spark, sf, "documents"), "lang", "text"), "score")


@query("lb2_keyword_labels", f"""
{_TERMS_SQL.replace('SELECT lang, unnest', f'SELECT {_DOC_CLUSTER_SQL}::BIGINT AS lang, unnest')}
SELECT lang AS cluster_id, string_agg(term, ' ' ORDER BY rank) AS name,
       'Consultas sobre ' || string_agg(term, ', ' ORDER BY rank) AS description FROM top GROUP BY 1""")
def lb2_names(spark, sf):
    d = table(spark, sf, "documents").select(doc_cluster().alias("cluster_id"), "text")
    return labels.keyword_labels(d, "text")


_REPLY_FORMS = 6


@query("lb3_parse_labels", f"""
WITH d AS (SELECT doc_id, doc_id % {_REPLY_FORMS} AS f, text, regexp_replace(text, '[^a-zA-Z ]', '', 'g') AS t FROM documents),
p AS (SELECT *, {sql_strip('text')} AS s FROM d)
SELECT doc_id,
  CASE WHEN f IN (0, 1, 2) THEN 'N ' || t WHEN f = 3 THEN 'Sin clasificar' WHEN f = 4 THEN 'Sin clasificar'
       ELSE 'N ' || t END AS name,
  CASE WHEN f IN (0, 1, 2) THEN 'D' WHEN f = 3 THEN 'solo'
       WHEN f = 4 THEN substring(regexp_replace('x ' || text, {"E'[" + chr(92)*2 + "s" + chr(92)*2 + "x0b" + chr(92)*2 + "x1c-" + chr(92)*2 + "x1f" + chr(92)*2 + "x85" + chr(92)*2 + "p{Z}]+$'"}, ''), 1, 200) ELSE '' END AS description,
  false AS is_faulty
FROM p""")
def lb3(spark, sf):
    """Every document once as a model reply, in six shapes: bare, fenced, tagged, partial, no JSON."""
    t = F.regexp_replace("text", "[^a-zA-Z ]", "")
    both = F.concat(F.lit('{"name": "N '), t, F.lit('", "description": "D"}'))
    form = F.col("doc_id") % _REPLY_FORMS
    reply = (
        F.when(form == 0, both)
        .when(form == 1, F.concat(F.lit("```\n"), both, F.lit("\n```")))
        .when(form == 2, F.concat(F.lit("```json\n"), both, F.lit("\n```  \n")))
        .when(form == 3, F.lit('{"description": "solo"}'))
        .when(form == 4, F.concat(F.lit("x "), F.col("text")))
        .otherwise(F.concat(F.lit('{"name": "N '), t, F.lit('"}')))
    )
    return labels.parse_labels(table(spark, sf, "documents").select("doc_id", reply.alias("reply"))).drop("reply")


_INTENTS_SQL = f"""
intents AS (
  SELECT {_DOC_CLUSTER_SQL}::VARCHAR AS intent_id, count(*) AS volume, avg(n_chars) / 1000 AS avg_resolution_time_hours,
         CASE WHEN {_DOC_CLUSTER_SQL} % 2 = 0 THEN 'active' ELSE 'inactive' END AS status,
         CASE {_DOC_CLUSTER_SQL} WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' END AS risk_level
  FROM documents GROUP BY {_DOC_CLUSTER_SQL})"""


def intent_table(spark, sf):
    c = F.col("c")
    return table(spark, sf, "documents").select(doc_cluster().alias("c"), "n_chars").groupBy("c").agg(
        F.count(F.lit(1)).alias("volume"), (F.avg("n_chars") / 1000).alias("avg_resolution_time_hours")
    ).select(
        c.cast("string").alias("intent_id"), "volume", "avg_resolution_time_hours",
        F.when(c % 2 == 0, "active").otherwise("inactive").alias("status"),
        F.when(c == 0, "high").when(c == 1, "medium").when(c == 2, "low").alias("risk_level"),
    )


@query("lb4_intent_rows", f"""
WITH {CLUSTERS_SQL}, s AS (SELECT cluster_id, count(*) AS volume FROM clusters WHERE cluster_id >= 0 GROUP BY 1)
SELECT cluster_id::VARCHAR AS intent_id, cluster_id, 'n' || cluster_id AS name, 'd' AS description, volume,
       'pending' AS status FROM s WHERE cluster_id <> 3""")
def lb4(spark, sf):
    """Cluster 3 has no label and yields no intent."""
    stats = N.cluster_stats(clusters(spark, sf))
    named = points(spark, sf).filter("cluster_id >= 0 and cluster_id <> 3").select("cluster_id").distinct().select(
        "cluster_id", F.concat(F.lit("n"), "cluster_id").alias("name"), F.lit("d").alias("description")
    )
    return labels.intent_rows(stats, named).drop("created_at", "updated_at")


@query("srt1_intent_summary", """
SELECT source AS intent_id, 'n' || source AS name, 'd' AS description, count(*) AS volume, 'pending' AS status
FROM documents GROUP BY 1 ORDER BY 4 DESC, 1 LIMIT 20""")
def srt1(spark, sf):
    rows = table(spark, sf, "documents").groupBy(F.col("source").alias("intent_id")).agg(
        F.count(F.lit(1)).alias("volume")
    ).select("intent_id", F.concat(F.lit("n"), "intent_id").alias("name"), F.lit("d").alias("description"),
             "volume", F.lit("pending").alias("status"))
    return labels.intent_summary(rows)


# --- intent scores --------------------------------------------------------------------------


@query("int1_confidence", f"""
WITH {CLUSTERS_SQL}, far AS (SELECT cluster_id, max(distance_to_centroid) AS m FROM clusters WHERE cluster_id >= 0 GROUP BY 1),
s AS (SELECT c.ticket_id, c.cluster_id, 1 - distance_to_centroid / m AS x FROM clusters c JOIN far f ON f.cluster_id = c.cluster_id)
SELECT ticket_id, cluster_id, round(x, 4) AS confidence_score,
       CASE WHEN x > 0.75 THEN 'high' WHEN x >= 0.5 THEN 'medium' ELSE 'low' END AS confidence_band, x >= 0.5 AS suggest FROM s""")
def int1(spark, sf):
    scored = T.confidence(clusters(spark, sf)).filter("cluster_id >= 0")
    return r4(scored, "confidence_score").drop("distance_to_centroid")


@query("agg14_tag_overlap", f"""
WITH {TICKETS_SQL}, c AS (SELECT ticket_id, ticket_id % 4 AS cluster_id FROM tickets),
size AS (SELECT cluster_id, count(*) AS n FROM c GROUP BY 1),
t AS (SELECT DISTINCT ticket_id, tag FROM (SELECT ticket_id, unnest(tags) AS tag FROM tickets))
SELECT c.cluster_id, tag, count(*) AS tickets, round(count(*) / max(size.n), 4) AS share
FROM c JOIN t ON t.ticket_id = c.ticket_id JOIN size ON size.cluster_id = c.cluster_id GROUP BY 1, 2""")
def agg14(spark, sf):
    tickets = tickets_and_comments(spark, sf)[0]
    return r4(T.tag_overlap(tickets.select("ticket_id", (F.col("ticket_id") % 4).alias("cluster_id")), tickets), "share")


@query("agg17_resolution_hours", f"""
WITH {TICKETS_SQL}
SELECT channel, round(avg(epoch(updated_at - created_at) / 3600), 4) AS avg_resolution_time_hours
FROM tickets WHERE status IN ('solved', 'closed') GROUP BY 1""")
def agg17_hours(spark, sf):
    return r4(T.resolution_hours(tickets_and_comments(spark, sf)[0], "channel"), "avg_resolution_time_hours")


@query("agg17_repetition", f"""
WITH {POINTS_SQL}, k AS (SELECT * FROM pts WHERE cluster_id >= 0)
SELECT a.cluster_id, round(avg(list_cosine_similarity(a.v, b.v)), 4) + 0.0 AS repetition_score
FROM k a JOIN k b ON a.cluster_id = b.cluster_id AND a.ticket_id <> b.ticket_id GROUP BY 1""")
def agg17_repetition(spark, sf):
    rep = T.repetition(points(spark, sf), "v")
    return rep.withColumn("repetition_score", F.round("repetition_score", 4) + 0.0)


@query("agg17_composite_score", f"""
WITH {_INTENTS_SQL}
SELECT intent_id, volume, round(0.4 * volume / max(volume) OVER ()
         + 0.3 * avg_resolution_time_hours / max(avg_resolution_time_hours) OVER () + 0.2 * 0.5
         + 0.1 * CASE risk_level WHEN 'high' THEN 1.0 WHEN 'medium' THEN 0.5 ELSE 0 END, 4) AS composite_score
FROM intents""")
def agg17_composite(spark, sf):
    scored = T.composite_score(intent_table(spark, sf).withColumn("repetition_score", F.lit(0.5)))
    return r4(scored.select("intent_id", "volume", "composite_score"), "composite_score")


# --- KPIs ---------------------------------------------------------------------------------------

_SUGGESTIONS_SQL = f"""
sg AS (
  SELECT doc_id::VARCHAR AS suggestion_id, doc_id AS ticket_id, {_DOC_CLUSTER_SQL}::VARCHAR AS intent_id,
         (n_chars % 101) / 100.0 AS confidence_score
  FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings WHERE label = 9))"""


def suggestions(spark, sf):
    """One suggestion per document, except those whose vector has label 9."""
    nine = table(spark, sf, "embeddings").filter("label = 9").select(F.col("vec_id").alias("doc_id"))
    return missing_from(table(spark, sf, "documents"), nine, "doc_id").select(
        F.col("doc_id").cast("string").alias("suggestion_id"), F.col("doc_id").alias("ticket_id"),
        doc_cluster().cast("string").alias("intent_id"), (F.col("n_chars") % 101 / 100.0).alias("confidence_score"),
    )


@query("agg15_feedback_rates", f"""
WITH {_FEEDBACK_SQL}
SELECT count(*) AS feedback, round(count(*) FILTER (WHERE action IN ('accept', 'edit')) / count(*), 4) AS acceptance_rate,
       round(count(*) FILTER (WHERE action = 'reject') / count(*), 4) AS rejection_rate FROM fb""")
def agg15_rates(spark, sf):
    return r4(kpis.feedback_rates(feedback(spark, sf)), "acceptance_rate", "rejection_rate")


@query("agg15_suggestion_coverage", f"""
WITH {_SUGGESTIONS_SQL}, {_INTENTS_SQL}
SELECT count(*) AS active_tickets, count(sg.ticket_id) AS with_suggestion,
       round(count(sg.ticket_id) / count(*), 4) AS suggestion_coverage
FROM documents d JOIN intents i ON i.intent_id = {_DOC_CLUSTER_SQL}::VARCHAR AND i.status = 'active'
LEFT JOIN sg ON sg.ticket_id = d.doc_id""")
def agg15_coverage(spark, sf):
    tickets = table(spark, sf, "documents").select(
        F.col("doc_id").alias("ticket_id"), doc_cluster().cast("string").alias("intent_id")
    )
    return r4(kpis.suggestion_coverage(tickets, suggestions(spark, sf), intent_table(spark, sf)), "suggestion_coverage")


@query("jn7_hours_saved", f"""
WITH {_SUGGESTIONS_SQL}, {_INTENTS_SQL}, {_FEEDBACK_SQL}
SELECT sg.intent_id, count(*) AS accepted, round(count(*) * max(avg_resolution_time_hours), 4) AS hours_saved
FROM sg JOIN fb ON fb.suggestion_id = sg.suggestion_id AND action <> 'reject' JOIN intents i ON i.intent_id = sg.intent_id
GROUP BY 1""")
def jn7(spark, sf):
    return r4(kpis.hours_saved(suggestions(spark, sf), feedback(spark, sf), intent_table(spark, sf)), "hours_saved")


@query("agg15_confidence_by_intent", f"""
WITH {_SUGGESTIONS_SQL} SELECT intent_id, count(*) AS suggestions, round(avg(confidence_score), 4) AS mean_confidence FROM sg GROUP BY 1""")
def agg15_confidence(spark, sf):
    return r4(kpis.confidence_by_intent(suggestions(spark, sf)), "mean_confidence")


@query("agg15_feedback_timeline", f"""
WITH {_FEEDBACK_SQL}
SELECT CAST(created_at AS DATE) AS day, count(*) AS feedback, count(*) FILTER (WHERE action = 'accept') AS accepted,
       count(*) FILTER (WHERE action = 'edit') AS edited, count(*) FILTER (WHERE action = 'reject') AS rejected
FROM fb GROUP BY 1""")
def agg15_timeline(spark, sf):
    return kpis.feedback_timeline(feedback(spark, sf))


@query("agg16_intent_coverage", f"""
WITH {_INTENTS_SQL}
SELECT (sum(volume) FILTER (WHERE status = 'active'))::BIGINT AS active_volume, (SELECT count(*) FROM documents) AS total_tickets,
       round(sum(volume) FILTER (WHERE status = 'active') / (SELECT count(*) FROM documents), 4) AS intent_coverage FROM intents""")
def agg16_intents(spark, sf):
    return r4(kpis.intent_coverage(intent_table(spark, sf), table(spark, sf, "documents")), "intent_coverage")


# --- embeddings, reduction, clustering: no SQL form --------------------------------------------


def document_vectors(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("ticket_id"), "text")
    model = embedding.fit_embedder(d, "text")
    return embedding.embed(d, "text", model).drop("text")


@query("emb2_fill_blank", f"""
WITH {DECORATED_SQL}, b AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN ' ' || chr(160) || chr(10) ELSE text END AS text FROM decorated)
SELECT doc_id, CASE WHEN {sql_strip('text')} = '' THEN '[vacío]' ELSE text END AS text FROM b""")
def emb2(spark, sf):
    blank = F.when(F.col("doc_id") % 9 == 0, F.lit("  \n")).otherwise(F.col("text"))
    return decorated(spark, sf).select("doc_id", embedding.fill_blank(blank).alias("text"))


@query("emb1_embed_documents", """
SELECT doc_id AS ticket_id, 1536 AS dims, CASE WHEN regexp_matches(text, '[\\p{L}\\p{N}]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm
FROM documents""")
def emb1(spark, sf):
    v = F.col("embedding_vector")
    return document_vectors(spark, sf).select(
        "ticket_id", F.size(v).alias("dims"), F.round(F.sqrt(V.squared_norm(v)), 4).alias("norm")
    )


def _fragile(texts):
    """A model that fails on any batch with a very long text; else three figures of each."""
    if any(len(t) > 10_000 for t in texts):
        raise ValueError("text too long")
    return [[float(len(t)), float(t.count(" ")), 1.0] for t in texts]


@query("emb3_run_embeddings", """
SELECT doc_id AS ticket_id, CASE WHEN length(text) > 10000 THEN 'hashing-tfidf-1536' ELSE 'figures' END AS model_version FROM documents""")
def emb3(spark, sf):
    """Labelled documents and then all with a model that fails on some; the default model takes those."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("ticket_id"), F.col("text").alias("text_customer_only"))
    target = S.table(spark, fresh_path(spark, "emb"), "features.embeddings").ensure()
    known = table(spark, sf, "labels").select(F.col("doc_id").alias("ticket_id"))
    for some in (d.join(known, "ticket_id", "left_semi"), d):
        jobs.run_embeddings(some, target, encode=_fragile, batch_size=1, model_version="figures")
    jobs.run_embeddings(d, target, embedding.fit_embedder(d, "text_customer_only"))
    return target.read().select("ticket_id", "model_version")


# Principal axes by power iteration on the covariance of the unit vectors: the second one stays
# orthogonal to the first. The strongest coordinate of an axis is positive.
_AXES_SQL = """
RECURSIVE u AS (
  SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS v
  FROM embeddings),
e AS (SELECT vec_id, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM u),
cov AS (SELECT a.i, b.i AS j, avg(a.x * b.x) - avg(a.x) * avg(b.x) AS c FROM e a JOIN e b USING (vec_id) GROUP BY 1, 2),
m AS (SELECT list(r ORDER BY i) AS rows FROM (SELECT i, list(c ORDER BY j) AS r FROM cov GROUP BY i)),
p AS (
  SELECT 0 AS k, list_transform(rows, lambda r: 1::DOUBLE) AS a, list_transform(rows, lambda r, i: CASE WHEN i % 2 = 0 THEN 1::DOUBLE ELSE -0.5::DOUBLE END) AS b FROM m
  UNION ALL
  SELECT k + 1, list_transform(y, lambda t: t / sqrt(list_dot_product(y, y))), list_transform(w, lambda t: t / sqrt(list_dot_product(w, w)))
  FROM (SELECT k, y, list_transform(z, lambda t, i: t - list_dot_product(z, a) * a[i]) AS w
        FROM (SELECT k, a, list_transform(rows, lambda r: list_dot_product(r, a)) AS y,
                     list_transform(rows, lambda r: list_dot_product(r, b)) AS z FROM p, m WHERE k < 3000))),
axes AS (
  SELECT list_transform(a, lambda t: t * sign(a[list_position(list_transform(a, lambda s: abs(s)), list_max(list_transform(a, lambda s: abs(s))))])) AS one,
         list_transform(b, lambda t: t * sign(b[list_position(list_transform(b, lambda s: abs(s)), list_max(list_transform(b, lambda s: abs(s))))])) AS two
  FROM p WHERE k = 3000)"""


@query("ml1_reduce", f"""
WITH {_AXES_SQL} SELECT vec_id, 25 AS dims, round(list_dot_product(v, one), 4) AS first FROM u, axes""")
def ml1(spark, sf):
    return reduction.reduce(table(spark, sf, "embeddings"), "embedding").select(
        "vec_id", F.size("reduced").alias("dims"), F.round(F.get("reduced", F.lit(0)), 4).alias("first")
    )


@query("ml2_plot_coordinates", f"""
WITH {_AXES_SQL} SELECT vec_id, round(list_dot_product(v, one), 4) AS umap_x, round(list_dot_product(v, two), 4) AS umap_y FROM u, axes""")
def ml2(spark, sf):
    two = reduction.reduce(table(spark, sf, "embeddings"), "embedding", reduction.PLOT_DIMENSIONS)
    return r4(reduction.plot_coordinates(two).select("vec_id", "umap_x", "umap_y"), "umap_x", "umap_y")


@query("ml3_density_cluster", "SELECT lang, count(*) AS n, true AS several FROM documents GROUP BY lang")
def ml3(spark, sf):
    """Clusters of all documents by their words: every document once, in several clusters."""
    vectors = settle(document_vectors(spark, sf), "vectors")
    reduced = reduction.reduce(vectors, "embedding_vector").select("ticket_id", "reduced")
    found = density.density_cluster(reduced, "ticket_id", "reduced")
    lang = table(spark, sf, "documents").select(F.col("doc_id").alias("ticket_id"), "lang")
    found = settle(found, "found")
    several = found.filter("cluster_id >= 0").select("cluster_id").distinct().count() > 1
    return found.join(lang, "ticket_id").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumn("several", F.lit(several))


@query("ml6_run_clustering_and_lb5_labels", "SELECT count(*) AS documents, true AS all_pending FROM documents")
def ml6(spark, sf):
    """Vectors to clusters to intents over all documents: volumes and noise add up to every document."""
    root = fresh_path(spark, "run")
    made = {n: S.table(spark, root, n).ensure() for n in ("features.clusters", "features.intents")}
    vectors = settle(document_vectors(spark, sf), "vectors")
    jobs.run_clustering(vectors, made["features.clusters"])
    jobs.run_labeling(made["features.clusters"].read(), texts(spark, sf), made["features.intents"])
    noise = made["features.clusters"].read().filter("is_noise").select(F.lit(1).cast("long").alias("n"), F.lit("pending").alias("status"))
    volumes = made["features.intents"].read().select(F.col("volume").alias("n"), "status")
    return volumes.union(noise).agg(F.sum("n").alias("documents"), F.bool_and(F.col("status") == "pending").alias("all_pending"))


@query("int2_stability_runs", """
SELECT m AS min_cluster_size, s AS min_samples, (SELECT count(*) FROM embeddings) AS total
FROM (VALUES (20::BIGINT, 5::BIGINT), (30, 5), (20, 10)) t(m, s)""")
def int2(spark, sf):
    reduced = settle(reduction.reduce(table(spark, sf, "embeddings"), "embedding", 5).select("vec_id", "reduced"), "r")
    runs, _, _ = density.stability_runs(reduced, "vec_id", "reduced", [(20, 5), (30, 5), (20, 10)])
    return runs.select("min_cluster_size", "min_samples", F.col("total_tickets").alias("total"))


# Vectors moved apart by their label: the labels are then the clusters, which SQL can tell.
_GROUPS_SQL = """
WITH g AS (SELECT vec_id, min(vec_id) OVER (PARTITION BY label) AS first_member, count(*) OVER (PARTITION BY label) AS members FROM embeddings)"""


def spread_vectors(spark, sf):
    e = table(spark, sf, "embeddings")
    moved = F.transform("embedding", lambda x, i: x.cast("double") + F.when(i == F.col("label"), 6.0).otherwise(0.0))
    return e.select("vec_id", "label", moved.alias("v"))


def by_member(found, key="vec_id"):
    """Each clustered row with the smallest id and the size of its cluster."""
    heads = found.filter("cluster_id >= 0").groupBy("cluster_id").agg(F.min(key).alias("first_member"), F.count(F.lit(1)).alias("members"))
    return found.join(heads, "cluster_id", "left").select(F.col(key).alias("vec_id"), "first_member", "members")


@query("ml3_cluster_members", f"{_GROUPS_SQL} SELECT vec_id, first_member, members FROM g")
def ml3_members(spark, sf):
    """Who is in whose cluster, row by row."""
    return by_member(settle(density.density_cluster(spread_vectors(spark, sf), "vec_id", "v"), "found"))


@query("ml6_cluster_rows", f"{_GROUPS_SQL} SELECT vec_id, first_member, members, false AS is_noise FROM g")
def ml6_rows(spark, sf):
    """The clustering job's table, row by row: unit vectors, reduced, clustered, upserted."""
    clusters = S.table(spark, fresh_path(spark, "clusters"), "features.clusters").ensure()
    jobs.run_clustering(spread_vectors(spark, sf).select(F.col("vec_id").alias("ticket_id"), F.col("v").alias("embedding_vector")), clusters)
    rows = clusters.read()
    noise = rows.select(F.col("ticket_id").alias("vec_id"), "is_noise")
    return by_member(rows.select("ticket_id", "cluster_id"), "ticket_id").join(noise, "vec_id")


@query("int2_run_agreement", """
SELECT a AS first, b AS second, (SELECT count(*) FROM embeddings) AS points, 1.0::DOUBLE AS adjusted_rand,
       (SELECT count(DISTINCT label) FROM embeddings) AS clusters, 1.0::DOUBLE AS least_kept
FROM (VALUES (0::BIGINT, 1::BIGINT), (0, 2), (1, 2)) t(a, b)""")
def int2_agreement(spark, sf):
    """Three settings over one neighbour graph: pairs of runs, and the least share that a cluster keeps."""
    _, pairs, fates = density.stability_runs(spread_vectors(spark, sf), "vec_id", "v", [(20, 5), (25, 5), (20, 8)])
    kept = fates.groupBy("first", "second").agg(F.count(F.lit(1)).alias("clusters"), F.min("kept").alias("least_kept"))
    return pairs.join(kept, ["first", "second"])


@query("int2_label_agreement", """
WITH l AS (SELECT label AS a, CASE WHEN vec_id % 3 = 0 THEN vec_id % 4 ELSE label % 5 END::BIGINT AS b FROM embeddings),
t AS (SELECT a, b, count(*) AS n FROM l GROUP BY 1, 2),
p AS (SELECT sum(n * (n - 1) / 2) AS same, sum(n) AS points FROM t),
pa AS (SELECT sum(m * (m - 1) / 2) AS p FROM (SELECT sum(n) AS m FROM t GROUP BY a)),
pb AS (SELECT sum(m * (m - 1) / 2) AS p FROM (SELECT sum(n) AS m FROM t GROUP BY b)),
e AS (SELECT points::BIGINT AS points, same, pa.p AS pa, pb.p AS pb, pa.p * pb.p / (points * (points - 1) / 2) AS expected FROM p, pa, pb)
SELECT points, round((same - expected) / ((pa + pb) / 2 - expected), 6) AS adjusted_rand FROM e""")
def int2_labels(spark, sf):
    other = F.when(F.col("vec_id") % 3 == 0, F.col("vec_id") % 4).otherwise(F.col("label") % 5)
    both = table(spark, sf, "embeddings").select(F.col("label").alias("a"), other.alias("b"))
    found = agreement.agreement(settle(agreement.contingency(both, "a", "b"), "contingency"), "a", "b")
    return found.withColumn("adjusted_rand", F.round("adjusted_rand", 6))

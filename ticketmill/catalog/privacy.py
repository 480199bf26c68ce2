"""Queries over the redaction rules (PII, JOB2, JOB4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketmill.catalog.base import (
    DECORATED_SQL, TICKETS_SQL, decorated, query, raw_tickets, sql_text, tickets_and_comments,
)
from ticketmill.catalog.text import CLEAN_TICKETS_SQL
from ticketmill.functions import pii as P
from ticketmill.operators import quality as Q
from ticketmill.operators.redaction import hits_by_type, leftover_pii, redact, redaction_audit
from ticketmill.plans.jobs import clean_and_redact, run_clean
from ticketmill.session import fresh_path, settle
from ticketmill.sources import tables as S
from ticketmill.sources.landing import to_raw_rows


def re2(rule: P.Rule) -> str:
    return sql_text(("(?i)" if rule.ignore_case else "") + rule.pattern)


def sql_redact(c: str, rules=P.RULES) -> str:
    for rule in rules:
        c = f"regexp_replace({c}, {re2(rule)}, '{rule.token}', 'g')"
    return c


def sql_steps(source: str, id_col: str, c: str, rules=P.RULES) -> str:
    """CTEs s0..s8: the text as each rule sees it."""
    out = [f"s0 AS (SELECT {id_col}, {c} AS t FROM {source})"]
    for i, rule in enumerate(rules):
        out.append(
            f"s{i + 1} AS (SELECT {id_col}, regexp_replace(t, {re2(rule)}, '{rule.token}', 'g') AS t FROM s{i})"
        )
    return ",\n".join(out)


def _one_rule(number: int, rule: P.Rule) -> None:
    @query(f"pii{number}_{rule.name}", f"""
WITH {DECORATED_SQL}
SELECT doc_id, regexp_replace(text, {re2(rule)}, '{rule.token}', 'g') AS text,
       len(regexp_extract_all(text, {re2(rule)})) AS hits
FROM decorated""")
    def run(spark, sf):
        return decorated(spark, sf).select(
            "doc_id", P.apply_rule(F.col("text"), rule).alias("text"),
            F.regexp_count("text", F.lit(rule.regex)).cast("long").alias("hits"),
        )


for _i, _rule in enumerate(P.RULES):
    _one_rule(_i + 1, _rule)


def _redact_query(name: str, rules) -> None:
    @query(name, f"""
WITH {DECORATED_SQL}, r AS (SELECT doc_id, text AS before, {sql_redact('text', rules)} AS text FROM decorated)
SELECT doc_id, text, text <> before AS has_pii FROM r""")
    def run(spark, sf):
        return redact(decorated(spark, sf), ["text"], rules)


_redact_query("pii9_redact", P.RULES)
_redact_query("pii9_redact_strict_cards", P.strict_cards())

_AUDIT_SQL = "\nUNION ALL\n".join(f"""
SELECT doc_id, {i} AS step, '{rule.name}' AS type, len(found[k]) AS original_length,
       list_sum(list_transform(gaps[1:k], lambda g: len(g)))::BIGINT
       + coalesce(list_sum(list_transform(found[1:k - 1], lambda m: len(m))), 0)::BIGINT AS position
FROM (SELECT doc_id, found, gaps, unnest(range(1, len(found) + 1)) AS k
      FROM (SELECT doc_id, regexp_extract_all(t, {re2(rule)}) AS found,
                   string_split_regex(t, {re2(rule)}) AS gaps FROM s{i}))""" for i, rule in enumerate(P.RULES))


@query("pii10_redaction_audit", f"""
WITH {DECORATED_SQL}, {sql_steps('decorated', 'doc_id', 'text')}, hits AS ({_AUDIT_SQL})
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY step, position DESC) - 1 AS step,
       type, original_length, position FROM hits""")
def pii10(spark, sf):
    return redaction_audit(decorated(spark, sf), "doc_id", "text")


_COUNT_SQL = "\nUNION ALL\n".join(
    f"SELECT '{rule.name}' AS type, len(regexp_extract_all(t, {re2(rule)})) AS n FROM s{i}"
    for i, rule in enumerate(P.RULES)
)


@query("pii14_hits_by_type", f"""
WITH {DECORATED_SQL}, {sql_steps('decorated', 'doc_id', 'text')}, c AS ({_COUNT_SQL})
SELECT type, sum(n)::BIGINT AS hits, count(*) FILTER (WHERE n > 0) AS texts FROM c GROUP BY type""")
def pii14(spark, sf):
    return hits_by_type(decorated(spark, sf), "text")


_LEFT_SQL = "\nUNION ALL\n".join(
    f"SELECT doc_id, '{rule.name}' AS type, regexp_extract_all(text, {re2(rule)}, {rule.group}) AS found FROM decorated"
    for rule in P.RULES
)


@query("pii12_leftovers", f"""
WITH {DECORATED_SQL}, f AS ({_LEFT_SQL})
SELECT doc_id, 'text' AS field, type, array_to_string(found, '|') AS found FROM f WHERE len(found) > 0""")
def pii12(spark, sf):
    return leftover_pii(decorated(spark, sf), "doc_id", ["text"]).select(
        "doc_id", "field", F.explode("remaining").alias("type", "x")
    ).select("doc_id", "field", "type", F.array_join("x", "|").alias("found"))


REDACTED_SQL = f"""{CLEAN_TICKETS_SQL},
redacted AS (
  SELECT ticket_id, channel, word_count, {sql_redact('text_full')} AS text_full,
         {sql_redact('text_customer_only')} AS text_customer_only, {sql_redact('text_agent_only')} AS text_agent_only,
         {sql_redact('text_full')} <> text_full OR {sql_redact('text_customer_only')} <> text_customer_only
         OR {sql_redact('text_agent_only')} <> text_agent_only AS has_pii_redacted
  FROM clean)"""


@query("job2_clean_and_redact", f"""
WITH {REDACTED_SQL}
SELECT ticket_id, channel, word_count, text_full, text_customer_only, text_agent_only, has_pii_redacted
FROM redacted""")
def job2(spark, sf):
    return clean_and_redact(raw_tickets(spark, sf)).drop("is_faulty", "processed_at")


@query("job3_run_clean", f"""
WITH {REDACTED_SQL}
SELECT ticket_id, channel, word_count, text_full, text_customer_only, text_agent_only, has_pii_redacted
FROM redacted""")
def job3(spark, sf):
    """Runs over growing input: a third of the tickets without comments, then all with them, then nothing new."""
    tickets, comments = tickets_and_comments(spark, sf)
    clean = S.table(spark, fresh_path(spark, "clean"), "clean.tickets").ensure()
    early = to_raw_rows(tickets.filter(F.col("ticket_id") % 3 == 0).withColumn("comments_json", F.lit("[]")))
    run_clean(settle(early, "early"), clean)
    late = settle(to_raw_rows(raw_tickets(spark, sf)), "late")
    for _ in range(2):
        run_clean(late, clean)
    return clean.read().drop("processed_at")


@query("flt6_faulty_tickets", f"""
WITH {TICKETS_SQL} SELECT ticket_id, subject FROM tickets WHERE ticket_id % 5 = 1""")
def flt6_faulty(spark, sf):
    """Tickets whose comments are no list go to quarantine, once, and stay out of the clean table."""
    raw = settle(to_raw_rows(_some_faulty(raw_tickets(spark, sf))), "raw")
    clean, bad = (S.table(spark, fresh_path(spark, n), n).ensure() for n in ("clean.tickets", "raw.quarantine"))
    for _ in range(2):
        run_clean(raw, clean, quarantine=bad)
    return bad.read().join(clean.read(), "ticket_id", "left_anti").select("ticket_id", "subject")


def _some_faulty(raw):
    """Every fifth ticket with comments of the wrong shape."""
    return raw.withColumn("comments_json", F.when(F.col("ticket_id") % 5 == 1, F.lit("[1, 2]")).otherwise(F.col("comments_json")))


@query("agg1_cleaning_stats", f"""
WITH {REDACTED_SQL}, g AS (SELECT *, ticket_id % 5 <> 1 AS good FROM redacted)
SELECT count(*) FILTER (WHERE good) AS processed, count(*) FILTER (WHERE good AND has_pii_redacted) AS pii_found,
       count(*) FILTER (WHERE NOT good) AS errors,
       round(coalesce(count(*) FILTER (WHERE good AND has_pii_redacted) / nullif(count(*) FILTER (WHERE good), 0), 0), 4) AS pii_rate
FROM g""")
def agg1(spark, sf):
    cleaned = clean_and_redact(_some_faulty(raw_tickets(spark, sf)))
    return Q.cleaning_stats(cleaned).withColumn("pii_rate", F.round("pii_rate", 4))


# Unredacted texts, so that the report has something to find; the sample is every ticket.
_FIELDS = ("text_full", "text_customer_only", "text_agent_only")
_DIRTY = {f: "(" + " OR ".join(f"regexp_matches({f}, {re2(r)})" for r in P.RULES) + ")" for f in _FIELDS}


@query("agg2_qa_report", f"""
WITH {CLEAN_TICKETS_SQL},
d AS (SELECT {' + '.join(f'{x}::INT' for x in _DIRTY.values())} AS fields FROM clean)
SELECT count(*) AS sample_size, sum(fields)::BIGINT AS tickets_with_remaining_pii,
       round(sum(fields) / count(*), 4) AS false_negative_rate,
       round(count(*) FILTER (WHERE fields > 0) / count(*), 4) AS distinct_ticket_rate
FROM d""")
def agg2(spark, sf):
    from ticketmill.operators.cleaning import clean_tickets

    report = Q.qa_report(clean_tickets(raw_tickets(spark, sf)), None)
    return report.withColumns({c: F.round(c, 4) for c in ("false_negative_rate", "distinct_ticket_rate")})


@query("agg3_sample_issues", f"""
WITH {CLEAN_TICKETS_SQL},
long AS ({' UNION ALL '.join(f"SELECT ticket_id, {i} AS o, '{f}' AS field, {f} AS t FROM clean" for i, f in enumerate(_FIELDS))}),
top AS (
  SELECT * FROM long WHERE {' OR '.join(f'regexp_matches(t, {re2(r)})' for r in P.RULES)}
  ORDER BY ticket_id, o LIMIT 10)
SELECT ticket_id, field, concat_ws(',', {', '.join(
    f"CASE WHEN regexp_matches(t, {re2(r)}) THEN '{r.name}' END" for r in P.RULES)}) AS types FROM top""")
def agg3(spark, sf):
    from ticketmill.operators.cleaning import clean_tickets

    return Q.sample_issues(clean_tickets(raw_tickets(spark, sf)), None).select(
        "ticket_id", "field", F.array_join(F.map_keys("remaining"), ",").alias("types")
    )


_LEFT = {f: "(" + " OR ".join(f"regexp_matches({f}, {re2(r)})" for r in P.RULES) + ")" for f in _FIELDS}


@query("job4_qa_sample_redacted", f"""
WITH {REDACTED_SQL},
s AS (SELECT * FROM redacted ORDER BY md5(ticket_id || ':0'), ticket_id LIMIT 100),
d AS (SELECT {' + '.join(f'{x}::INT' for x in _LEFT.values())} AS fields FROM s)
SELECT count(*) AS sample_size, coalesce(sum(fields), 0)::BIGINT AS tickets_with_remaining_pii,
       coalesce(sum(fields) / nullif(count(*), 0), 0)::DOUBLE AS false_negative_rate,
       coalesce(count(*) FILTER (WHERE fields > 0) / nullif(count(*), 0), 0)::DOUBLE AS distinct_ticket_rate
FROM d""")
def job4(spark, sf):
    """The report as run in production: a sample of 100 redacted tickets."""
    return Q.qa_report(clean_and_redact(raw_tickets(spark, sf)), 100)

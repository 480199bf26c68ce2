"""Redaction rules, their order, the audit and the leftovers report."""

import re

import pytest
from pyspark.sql import functions as F

from ticketmill.functions import pii as P
from ticketmill.operators import quality as Q
from ticketmill.operators import redaction as R


@pytest.mark.parametrize("token, texts", [
    ("[EMAIL]", ["Contactame a juan.perez@gmail.com por favor", "X@Y.COM"]),
    ("[TELEFONO]", ["Llamame al +56 9 1234 5678", "Mi celular es 912345678", "Tel: 56 9 8765 4321", "fono +44 12345678901"]),
    ("[RUT]", ["Mi RUT es 12.345.678-9", "RUT: 12345678-K", "Documento: 12345678k"]),
    ("[TARJETA]", ["Mi tarjeta es 4111-1111-1111-1111", "Número: 4111 1111 1111 1111"]),
    ("[PEDIDO]", ["Mi pedido #123456 no llegó", "ORDER 55555"]),
    ("[DIRECCION]", ["Vivo en Av. Providencia 1234", "Dirección: Calle Las Flores 567", "Pasaje Los Aromos 89",
                     "Dirección: Av. José María Caro 1234, Ñuñoa"]),
    ("[DOCUMENTO]", ["pasaporte AB1234567 ok"]),
])
def test_each_rule(apply, token, texts):
    for before, after in zip(texts, apply(P.redact_text, *texts)):
        assert token in after and after != before


def test_clean_and_empty_texts(apply):
    text = "Hola, tengo una consulta sobre los horarios de atención."
    assert apply(P.redact_text, text, "", None) == [text, "", ""]


def python_redact(text, rules=P.RULES):
    hits = []
    for rule in rules:
        found = list(re.finditer(rule.pattern, text, re.I if rule.ignore_case else 0))
        hits += [(rule.name, m.end() - m.start(), m.start()) for m in reversed(found)]
        text = re.sub(rule.pattern, rule.token, text, flags=re.I if rule.ignore_case else 0)
    return text, hits


MIXED = [
    "Email: juan@example.com\nTel: +56 9 1234 5678 RUT: 12.345.678-9 y ana@b.cl, ana@c.cl",
    "tarjeta 4111 1111 1111 1111 y 4610568912345678",
    "😀 pedido 12345 calle ñuñoa\nnorte 55 AB123456 +1 1234567 ÁB123456",
    "sin nada", "solo 12", "a@b", "calle x\n\n 9",
    "9 1234 5678 y pedido # 99999",
]


def test_whole_redaction_and_audit_match_a_direct_evaluation(spark, apply):
    assert apply(P.redact_text, *MIXED) == [python_redact(t)[0] for t in MIXED]
    df = spark.createDataFrame(list(enumerate(MIXED)), "i long, t string")
    rows = R.redaction_audit(df, "i", "t").orderBy("i", "step").collect()
    got = [[(r.type, r.original_length, r.position) for r in rows if r.i == i] for i in range(len(MIXED))]
    assert got == [python_redact(t)[1] for t in MIXED]


def test_phone_rule_eats_a_card_tail_unless_cards_go_first(apply):
    text = "tarjeta 4610568912345678"
    assert apply(P.redact_text, text) == ["tarjeta 4610568[TELEFONO]"]
    assert apply(lambda c: P.redact_text(c, P.strict_cards()), text) == ["tarjeta [TARJETA]"]


def test_redacting_twice_changes_nothing(spark, apply):
    once = apply(P.redact_text, *MIXED)
    assert apply(P.redact_text, *once) == once


def test_batch_flags(spark):
    df = spark.createDataFrame(
        [(1, "Email: test@example.com", "x"), (2, "nada", "Tel: +56 9 1234 5678"), (3, "Sin PII aquí", None)],
        "i int, a string, b string")
    got = {r.i: r for r in R.redact(df, ["a", "b"]).collect()}
    assert [got[i].has_pii for i in (1, 2, 3)] == [True, True, False]
    assert got[3].b == "" and got[1].a == "Email: [EMAIL]"


def test_leftovers(spark):
    df = spark.createDataFrame(
        [(1, "mi consulta es sobre [EMAIL] y [TELEFONO]"), (2, "test@example.com y pedido #12345"), (3, None)], "i long, t string")
    rows = R.leftover_pii(df, "i", ["t"]).collect()
    assert [(r.i, r.field, r.remaining) for r in rows] == [
        (2, "t", {"email": ["test@example.com"], "order_number": ["12345"]})]


def test_counts_by_type_agree_with_the_audit(spark):
    df = spark.createDataFrame(list(enumerate(MIXED)), "i long, t string")
    audit = {r.type: r.n for r in R.redaction_audit(df, "i", "t").groupBy("type").agg(F.count("*").alias("n")).collect()}
    counts = {r.type: r.hits for r in R.hits_by_type(df, "t").collect()}
    assert {k: v for k, v in counts.items() if v} == audit and len(counts) == len(P.RULES)


def test_qa_rate_counts_fields_and_may_exceed_one(spark):
    dirty = "a@b.cl"
    df = spark.createDataFrame(
        [(1, dirty, dirty, dirty), (2, "limpio", dirty, None)],
        "ticket_id long, text_full string, text_customer_only string, text_agent_only string")
    r = Q.qa_report(df).first()
    assert (r.sample_size, r.tickets_with_remaining_pii, r.false_negative_rate, r.distinct_ticket_rate) == (2, 4, 2.0, 1.0)
    issues = Q.sample_issues(df).collect()
    assert [(i.ticket_id, i.field) for i in issues] == [
        (1, "text_full"), (1, "text_customer_only"), (1, "text_agent_only"), (2, "text_customer_only")]
    empty = Q.qa_report(df.filter("ticket_id > 5")).first()
    assert (empty.sample_size, empty.false_negative_rate) == (0, 0.0)


def test_each_pattern_runs_once_a_row(spark):
    """No filter on a computed value makes the optimiser evaluate the patterns twice."""
    from ticketmill.operators.cleaning import drop_empty_and_auto
    from ticketmill.operators.redaction import leftover_pii, redaction_audit

    df = spark.createDataFrame([(1, "a@b.cl 12345678-9")], "id int, t string").repartition(2)

    def plan(out):
        return out._jdf.queryExecution().optimizedPlan().toString()

    assert plan(leftover_pii(df, "id", ["t"])).count("regexp_extract_all(") == 8
    assert plan(redaction_audit(df, "id", "t")).count("regexp_extract_all(") <= 9
    made = df.withColumn("t", F.regexp_replace("t", "zz+", "y"))
    assert plan(drop_empty_and_auto(made, "t")).count("zz+") == 1
    assert [r.t for r in drop_empty_and_auto(made, "t").collect()] == ["a@b.cl 12345678-9"]

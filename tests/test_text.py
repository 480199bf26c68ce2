"""Cleaning steps: the fixture vectors, and every known trap."""

import re

import pytest

from ticketmill.functions import text as X
from ticketmill.operators import cleaning as C


def test_tags_become_spaces_and_may_span_lines(apply):
    assert apply(X.strip_tags, "<p>Hello <b>world</b>!</p>", "a<br\n/>b", "1 < 2") == [
        " Hello  world ! ", "a b", "1 < 2"]


def test_entities(apply):
    got = apply(X.decode_entities, "Caf&eacute; &amp; T&eacute;", "a &lt;b&gt; &#39; &#x27;", "no entity", "&amp;lt;", "&am &amp x", None)
    assert got == ["Café & Té", "a <b> ' '", "no entity", "&lt;", "&am & x", None]


def test_urls(apply):
    got = apply(X.mask_urls, "Visita https://example.com/path?param=value para más info", "HTTP://ñandú.cl/x", "http:// no")
    assert got == ["Visita [URL] para más info", "[URL]", "http:// no"]


def test_url_token_is_literal(apply):
    assert apply(lambda c: X.mask_urls(c, r"$1\x"), "ver https://a.cl") == [r"ver $1\x"]


@pytest.mark.parametrize("text, kept", [
    ("Hola, ayuda.\n\nSaludos,\nJuan\nTel: 1", "Hola, ayuda.\n"),
    ("Por favor.\n\nEnviado desde mi iPhone", "Por favor.\n"),
    ("Saludos", ""),
    ("a\n--\nb", "a"),
    ("a\n-- x\nb", "a"),  # two dashes cut whatever follows, as at a Markdown rule
    ("a\n***\nb", "a"),
    ("Gracias,\nquiero mi pedido", ""),
    (" Saludos,\nb", " Saludos,\nb"),  # no leading blank allowed
    ("Saludos a todos\nb", "Saludos a todos\nb"),
    ("a\nSALUDOS,  \nb", "a"),
    ("a\nSaludos,\r\nb", "a"),
    ("sin firma", "sin firma"),
    ("", ""),
])
def test_signature(apply, text, kept):
    assert apply(X.cut_signature, text) == [kept]


@pytest.mark.parametrize("text, kept", [
    ("Gracias.\n\nEl 15 de enero de 2024 escribió:\n> x\n> y", "Gracias.\n"),
    ("a\n> b\nc", "a"),
    ("a\n   > b\nc", "a"),
    ("a\n\n > b", "a\n"),  # the blank line before the quote stays
    ("a \n > b", "a "),
    ("El lunes ANA ESCRIBIÓ:\nx", ""),
    ("El lunes Ana escribió:\r\nx", "El lunes Ana escribió:\r\nx"),  # only a newline ends a line
    ("On Monday Bob wrote:\nx", ""),
    ("a\nFrom: b", "a"),
    ("a\nDesde: b", "a\nDesde: b"),
    ("1 > 0", "1 > 0"),
])
def test_quotes(apply, text, kept):
    assert apply(X.cut_quotes, text) == [kept]


def test_auto_response(apply):
    got = apply(X.is_auto_response, "Este es un mensaje automático. No responder.", "Hola, tengo una consulta.",
                "OUT OF OFFICE", "RESPUESTA AUTOMÁTICA", "please do not   reply", "no-reply@x.cl", "")
    assert got == [True, False, True, True, False, True, False]


def test_mentions_keep_hashtags_and_take_accents(apply):
    assert apply(X.mask_mentions, "@tienda Hola #ayuda 😡", "@tiendañ!") == ["[USUARIO] Hola #ayuda 😡", "[USUARIO]!"]


def reference_whitespace(text):
    text = re.sub(r"[ \t]+", " ", text)
    text = re.sub(r"\n{3,}", "\n\n", text)
    return "\n".join(x.strip() for x in text.split("\n")).strip()


def test_whitespace_follows_the_step_order(apply):
    cases = [
        "Hola    mundo\n\n\n\nMás texto", "a\n \n \n \nb", " \t a\t\tb \n", " x \n　y ",
        "a\r\nb\r\n\r\n\r\nc", "\x1ca\x1f", "", "\n\n", "a \t b",
    ]
    assert apply(X.normalize_whitespace, *cases) == [reference_whitespace(c) for c in cases]


def test_word_count_is_a_unicode_split(apply):
    cases = ["uno dos", "", " \n ", "a b c", "Asunto: x\n\ny", "\x1ca b\x1f", "ñ"]
    assert apply(X.word_count, *cases) == [len(c.split()) for c in cases]


def test_strip(apply):
    cases = [" a b　", "", "\n\t ", "x"]
    assert apply(X.strip, *cases) == [c.strip() for c in cases]


def test_channel_words(apply):
    got = apply(X.channel_class, "Email", "gmail", "Twitter", "instagram_direct", "web_chat", "platform", "live chat", "api", "")
    assert got == ["email", "email", "social", "social", "web", "web", "chat", "other", "other"]


def test_clean_text_by_channel(spark):
    mail = """<p>Hola, necesito ayuda con mi pedido.</p>

<p>El número es 12345.</p>

Visita https://tracking.com/123 para ver el estado.

Saludos,
María

El 10 de enero escribió:
> Mensaje anterior"""
    rows = [
        (1, mail, "email"), (2, "@tienda Mi pedido #1234 no llegó 😡", "social"), (3, "a\nSaludos,\nb", "chat"),
        (4, None, "email"), (5, "<div>ok</div>\n<div>Saludos,</div>", "web"), (6, "x\n&gt; cita", "email"),
    ]
    df = spark.createDataFrame(rows, "i int, t string, ch string")
    got = {r.i: r.t for r in C.clean_text(df, "t", "ch").collect()}
    assert got[1] == "Hola, necesito ayuda con mi pedido.\n\nEl número es 12345.\n\nVisita [URL] para ver el estado."
    assert got[2] == "[USUARIO] Mi pedido #1234 no llegó 😡"
    assert got[3] == "a\nSaludos,\nb"
    assert got[4] == ""
    assert got[5] == "ok\nSaludos,"  # a tag leaves a blank before the anchor
    assert got[6] == "x"  # entities are decoded before quotes are cut
    kept = {r.i: r.t for r in C.clean_text(df, "t", "ch", remove_urls=False).collect()}
    assert "https://tracking.com/123" in kept[1]


def ticket(spark, *rows):
    return spark.createDataFrame(rows, "ticket_id long, subject string, description string, comments_json string, channel string")


def test_process_ticket(spark):
    comments = ('[{"id": 1, "body": "Mensaje adicional", "author_id": 100, "public": true},'
                '{"id": 2, "body": "Nota", "author_id": 200, "public": false},'
                '{"id": 3, "body": "nula", "author_id": 7, "public": null},'
                '{"id": 4, "body": "sin clave", "author_id": 7},'
                '{"id": 5, "body": "sin autor", "author_id": 0}, {"id": 6, "body": ""},'
                '{"id": 7, "body": "respuesta automática", "author_id": 1}]')
    df = ticket(
        spark, (1, "Problema con pedido", "No me llegó mi pedido #999", comments, "email"),
        (2, None, None, None, None), (3, "s", None, "bad [", "chat"), (4, "s", "d", '{"body": "x"}', "chat"),
        (5, "s", "d", '[1, {"body": "x"}]', "chat"), (6, "", "d", "[]", "chat"), (7, None, "d", "null", "chat"),
    )
    got = {r.ticket_id: r for r in C.clean_tickets(df).collect()}
    assert got[1].text_customer_only == "No me llegó mi pedido #999\n\nMensaje adicional\n\nsin clave"
    assert got[1].text_agent_only == "Nota\n\nnula\n\nsin autor"
    assert got[1].text_full.startswith("Asunto: Problema con pedido\n\nNo me llegó")
    assert got[1].word_count == len(got[1].text_full.split()) and got[1].channel == "email"
    assert (got[2].text_full, got[2].channel, got[2].word_count) == ("", "other", 0)
    assert got[3].text_full == "Asunto: s" and not got[3].is_faulty
    assert got[4].is_faulty and got[5].is_faulty and got[7].is_faulty
    assert got[6].text_full == "d" and not got[6].is_faulty


def test_cleaning_is_one_narrow_pass(spark):
    plan = C.clean_tickets(ticket(spark, (1, "s", "d", "[]", "email")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

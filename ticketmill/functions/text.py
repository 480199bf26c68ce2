"""Cleaning steps as Column expressions: each takes and returns a Column.

They work on a plain column and, equally, on the element of an array inside
``transform``. Every step refers to its input once, so steps nest without
repeating work.

Patterns carry ``(?U)`` because Java's classes are ASCII-only by default, and
``(?d)`` wherever a line end matters, so that only a newline ends a line.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values ------------------------------------------------------------
# Line starts that open an e-mail signature.
SIGNATURE_ANCHORS = (
    r"--\s*$",
    r"_{2,}",
    r"-{2,}",
    r"Enviado desde mi (?:iPhone|iPad|Android|Samsung|Huawei)",
    r"Sent from my (?:iPhone|iPad|Android)",
    r"Saludos,?\s*$",
    r"Atentamente,?\s*$",
    r"Cordialmente,?\s*$",
    r"Un abrazo,?\s*$",
    r"Gracias,?\s*$",
    r"Quedo atento,?\s*$",
    r"Quedo atenta,?\s*$",
    r"Best regards,?\s*$",
    r"Kind regards,?\s*$",
    r"Thanks,?\s*$",
    r"Get Outlook for",
    r"\*{3,}",
)
# Line starts that open a quoted reply.
QUOTE_ANCHORS = (
    r">+\s*",
    r"El .+ escribió:$",
    r"On .+ wrote:$",
    r"De:\s*",
    r"From:\s*",
    r"Enviado:\s*",
    r"Sent:\s*",
    r"Para:\s*",
    r"To:\s*",
    r"Asunto:\s*",
    r"Subject:\s*",
    r"Fecha:\s*",
    r"Date:\s*",
    r"\*De:\*",
    r"\*From:\*",
)
# Phrases that mark an automatic answer.
AUTO_PHRASES = (
    "este es un mensaje automático",
    "this is an automated message",
    "no-reply",
    "noreply",
    "do not reply",
    "no responder",
    "mensaje generado automáticamente",
    "respuesta automática",
    "auto-reply",
    "autoreply",
    "out of office",
    "fuera de la oficina",
)
TAG = r"<[^>]+>"
URL = r"https?://(?:[-\w.]|(?:%[\da-fA-F]{2}))+[^\s]*"
URL_TOKEN = "[URL]"
MENTION = r"@[\p{L}\p{N}_]+"
MENTION_TOKEN = "[USUARIO]"
# -----------------------------------------------------------------------------

# Whitespace as Unicode text strips it: Java's property lacks the four separators.
BLANKS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
WS_IN_LINE = r"[[\s\x1c-\x1f]&&[^\n]]"
WORD = r"(?U)[^\s\x1c-\x1f]+"


def _literal(replacement: str) -> Column:
    """A replacement string in which ``$`` and backslash mean themselves."""
    return F.lit(replacement.replace("\\", "\\\\").replace("$", "\\$"))


def _sub(c: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), _literal(replacement))


def strip_tags(c: Column) -> Column:
    """Each markup tag, even one spanning lines, becomes one space."""
    return _sub(c, TAG, " ")


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _unescape_each(texts: pd.Series) -> pd.Series:
    return texts.map(lambda xs: [html.unescape(x) for x in xs], na_action="ignore")


def decode_entities(c: Column) -> Column:
    """Decode HTML entities. Only texts holding ``&`` are sent to Python."""
    return F.coalesce(_unescape(F.when(F.contains(c, F.lit("&")), c)), c)


def decode_entities_each(c: Column) -> Column:
    """The same for an array of texts, in one Arrow hop per row batch."""
    needs = F.exists(c, lambda x: F.contains(x, F.lit("&")))
    return F.coalesce(_unescape_each(F.when(needs, c)), c)


def mask_urls(c: Column, token: str = URL_TOKEN) -> Column:
    return _sub(c, "(?iU)" + URL, token)


def _cut_from(c: Column, anchors: tuple[str, ...], extra: str = "") -> Column:
    """Drop everything from the first line that starts with an anchor.

    One scan: the match opens at the newline before that line and runs to the end,
    which leaves exactly the earlier lines.
    """
    starts = "|".join(anchors) + extra
    return _sub(c, rf"(?iUdm)(?:\A|\n)(?:{starts})(?s:.*)", "")


def cut_signature(c: Column) -> Column:
    return _cut_from(c, SIGNATURE_ANCHORS)


def cut_quotes(c: Column) -> Column:
    return _cut_from(c, QUOTE_ANCHORS, extra=rf"|{WS_IN_LINE}*>")


def is_auto_response(c: Column) -> Column:
    """Plain substring tests on the lowercased text, which is bound once for all of them.

    Lowercasing leaves two letters that case-blind matching equates with s and i.
    """
    low = F.translate(F.lower(c), "ſı", "si")

    def any_phrase(text: Column) -> Column:
        hit = F.contains(text, F.lit(AUTO_PHRASES[0]))
        for phrase in AUTO_PHRASES[1:]:
            hit = hit | F.contains(text, F.lit(phrase))
        return hit

    return F.exists(F.array(low), any_phrase)


def mask_mentions(c: Column) -> Column:
    return _sub(c, MENTION, MENTION_TOKEN)


def strip(c: Column) -> Column:
    """Remove Unicode whitespace from both ends (``trim`` removes spaces only)."""
    return F.trim(c, F.lit(BLANKS))


def normalize_whitespace(c: Column) -> Column:
    """Runs of blanks to one space, 3+ newlines to two, then strip every line.

    Line stripping comes last on purpose: blank-but-not-empty lines can leave more
    than two newlines in a row, as the fixed step order demands.
    """
    c = _sub(c, r" [ \t]+|\t[ \t]*", " ")  # single spaces already are what they become
    c = _sub(c, r"\n{3,}", "\n\n")
    c = _sub(c, rf"(?U){WS_IN_LINE}*\n{WS_IN_LINE}*", "\n")
    return strip(c)


def channel_class(c: Column) -> Column:
    """Free-text channel to one of the five classes; the first hit wins."""
    low = F.lower(c)

    def has(*words: str) -> Column:
        hit = F.contains(low, F.lit(words[0]))
        for word in words[1:]:
            hit = hit | F.contains(low, F.lit(word))
        return hit

    return (
        F.when(has("mail"), "email")
        .when(has("twitter", "facebook", "instagram", "social"), "social")
        .when(has("web", "form"), "web")
        .when(has("chat"), "chat")
        .otherwise("other")
    )


def channel_body(c: Column, kind: str, remove_urls: bool = True, token: str = URL_TOKEN) -> Column:
    """Steps after entity decoding for one channel class."""
    if remove_urls:
        c = mask_urls(c, token)
    if kind in ("email", "web"):
        c = cut_quotes(cut_signature(c))
    elif kind == "social":
        c = mask_mentions(c)
    return normalize_whitespace(c)


def word_count(c: Column) -> Column:
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(WORD)).cast("long")

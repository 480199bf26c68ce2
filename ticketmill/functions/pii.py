"""Personal-data rules and the expressions built on them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rule(NamedTuple):
    name: str
    pattern: str
    token: str
    ignore_case: bool = False
    group: int = 0  # what a leftover report shows: 0 whole match, 1 first group
    # What every match holds, so that a cheap look tells most texts off: so many digits in a row, and some text.
    digits: int = 0
    holds: str = ""

    @property
    def regex(self) -> str:
        return ("(?iU)" if self.ignore_case else "(?U)") + self.pattern


# --- Fixed values: the eight rules, in the order they apply -------------------
RULES: tuple[Rule, ...] = (
    Rule("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "[EMAIL]", True, holds="@"),
    Rule("phone_cl", r"(?:\+?56\s*)?(?:9|2)\s*\d{4}\s*\d{4}\b", "[TELEFONO]", digits=4),
    Rule("phone_intl", r"\+\d{1,3}\s*\d{6,14}\b", "[TELEFONO]", digits=6, holds="+"),
    Rule("rut", r"\b\d{1,2}\.?\d{3}\.?\d{3}[-]?[0-9kK]\b", "[RUT]", digits=3),
    Rule("credit_card", r"\b(?:\d{4}[-\s]?){3}\d{4}\b", "[TARJETA]", digits=4),
    Rule("order_number", r"\b(?:pedido|orden|order)\s*#?\s*(\d{5,})\b", "[PEDIDO]", True, 1, digits=5),
    Rule("address",
         r"\b(?:calle|av\.?|avenida|pasaje|psje\.?)\s+[A-Za-zÁáÉéÍíÓóÚúÑñ\s]+\s*\d+",
         "[DIRECCION]", True, digits=1),
    Rule("passport", r"\b[A-Z]{1,2}\d{6,9}\b", "[DOCUMENTO]", digits=6),
)
# -----------------------------------------------------------------------------


def strict_cards(rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """The rules with cards first, so that no phone rule eats a card's tail."""
    cards = tuple(r for r in rules if r.name == "credit_card")
    return cards + tuple(r for r in rules if r.name != "credit_card")


def apply_rule(c: Column, rule: Rule) -> Column:
    return F.regexp_replace(c, F.lit(rule.regex), F.lit(rule.token))


def may_hold_pii(c: Column) -> Column:
    """A cheap test that no rule can match without: an at sign or a digit."""
    return c.rlike(r"(?U)[@\d]")


def _texts(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({r.holds for r in rules if r.holds})


def signs(c: Column, rules: tuple[Rule, ...]) -> list[Column]:
    """What a text shows of ``Rule.digits`` and ``Rule.holds``: its longest run of digits, and which texts it holds.

    A redaction takes text out and puts a token in that holds neither, so a text without a sign never gains it.
    """
    runs = F.transform(F.split(c, r"(?U)\D+", -1), F.length)
    return [F.coalesce(F.array_max(runs), F.lit(0)).alias("run"),
            *(F.contains(c, F.lit(h)).alias(f"h{k}") for k, h in enumerate(_texts(rules)))]


def _needed(state: Column, rule: Rule, rules: tuple[Rule, ...]) -> Column:
    if any(c.isdigit() or c in _texts(rules) for r in rules for c in r.token):
        return F.lit(True)  # tokens of one's own may bring a sign in
    out = state["run"] >= rule.digits
    return out & state[f"h{_texts(rules).index(rule.holds)}"] if rule.holds else out


def _fold(c: Column, rules: tuple[Rule, ...], fields: dict[str, Column], find, step) -> Column:
    """Rules in order on the progressively redacted text; the last state, null for a null text.

    The state is the one element of an array, so the text and its signs are worked out once, and so is
    what ``find(state, rule)`` finds, from which ``step(state, rule, found)`` makes the new ``t`` and
    ``fields``. A rule whose signs are missing costs nothing.
    """
    marks = ["run", *(f"h{k}" for k in range(len(_texts(rules))))]

    def apply_to(rule: Rule):
        def after(s):
            def made(found):
                new = step(s, rule, found)
                return F.struct(new["t"].alias("t"), *[s[n].alias(n) for n in marks], *[new[k].alias(k) for k in fields])

            return F.when(_needed(s, rule, rules), F.get(F.transform(F.array(find(s, rule)), made), F.lit(0))).otherwise(s)
        return after

    state = F.when(c.isNotNull(), F.array(F.struct(c.alias("t"), *signs(c, rules), *[v.alias(k) for k, v in fields.items()])))
    for rule in rules:
        state = F.transform(state, apply_to(rule))
    return F.get(state, F.lit(0))


def redact_text(c: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All rules in order on the progressively redacted text; null becomes ''."""
    done = _fold(c, rules, {}, lambda s, rule: apply_rule(s["t"], rule), lambda s, rule, text: {"t": text})
    return F.coalesce(done["t"], F.lit(""))


def has_pii(before: Column, after: Column) -> Column:
    """Whether any rule matched.

    Each match adds a bracketed token that no later rule can remove, so a match
    anywhere means the texts differ.
    """
    return F.coalesce(before, F.lit("")) != after


_HITS = "array<struct<type:string,original_length:int,position:int>>"


def all_hits(c: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Array of (type, original_length, position): rules in turn, last match first within a rule.

    Positions count in the text as the rule saw it. A rule scans a text twice at most: one extract gives
    the lengths of its matches, one split the gaps between them, and the gaps joined by the
    token are the text for the next rule.
    """
    def find(s: Column, rule: Rule) -> Column:
        lens = F.transform(F.regexp_extract_all(s["t"], F.lit(rule.regex), F.lit(0)), F.length)
        return F.struct(lens.alias("lens"), F.split(s["t"], rule.regex, -1).alias("gaps"))

    def step(s: Column, rule: Rule, m: Column) -> dict[str, Column]:
        return {"t": F.array_join(m["gaps"], rule.token), "hits": F.concat(s["hits"], _places(m, rule))}

    return _fold(c, rules, {"hits": F.array().cast(_HITS)}, find, step)["hits"]


def _places(m: Column, rule: Rule) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_HITS).alias("hits"))

    def walk(acc: Column, p: Column) -> Column:
        position = acc["at"] + p["gap"]
        hit = F.struct(F.lit(rule.name).alias("type"), p["len"].alias("original_length"), position.alias("position"))
        return F.struct((position + p["len"]).alias("at"), F.concat(F.array(hit), acc["hits"]).alias("hits"))

    pairs = F.zip_with(m["lens"], F.slice(m["gaps"], F.lit(1), F.size(m["lens"])),
                       lambda n, g: F.struct(F.length(g).alias("gap"), n.alias("len")))
    return F.aggregate(pairs, start, walk, lambda acc: acc["hits"])


def hit_counts(c: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Array of (type, n), one for each rule that a text shows the signs of; one scan a rule."""
    def step(s: Column, rule: Rule, gaps: Column) -> dict[str, Column]:
        n = F.struct(F.lit(rule.name).alias("type"), (F.size(gaps) - 1).alias("n"))
        return {"t": F.array_join(gaps, rule.token), "counts": F.concat(s["counts"], F.array(n))}

    none = F.array().cast("array<struct<type:string,n:int>>")
    return _fold(c, rules, {"counts": none}, lambda s, rule: F.split(s["t"], rule.regex, -1), step)["counts"]


def leftovers(c: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Map of rule name to what that rule still finds in the text as it stands."""
    empty = F.array().cast("array<string>")

    def look(s: Column) -> Column:
        entries = []
        for rule in rules:
            entries += [F.lit(rule.name), F.when(_needed(s, rule, rules), F.regexp_extract_all(
                s["t"], F.lit(rule.regex), F.lit(rule.group))).otherwise(empty)]
        return F.map_filter(F.create_map(*entries), lambda _, v: F.size(v) > 0)

    none = F.create_map().cast("map<string,array<string>>")
    seen = F.transform(F.array(F.struct(c.alias("t"), *signs(c, rules))), look)
    return F.coalesce(F.when(c.isNotNull(), F.get(seen, F.lit(0))), none)

"""Comments JSON to messages, row by row, without a shuffle.

VARIANT is used rather than a fixed schema because a missing ``public`` (customer
message) must be told apart from a null one (agent message).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MESSAGES_TYPE = "array<struct<role:string,body:string>>"


def parse(comments_json: Column) -> Column:
    """VARIANT of the JSON text; null if blank or malformed."""
    return F.try_parse_json(comments_json)


def elements(parsed: Column) -> Column:
    return F.try_variant_get(parsed, "$", "array<variant>")


def is_faulty(parsed: Column) -> Column:
    """Well-formed JSON that is no list of objects: such a ticket is quarantined.

    The element type is only worked out for elements without a body.
    """
    items = elements(parsed)
    odd = F.exists(
        items,
        lambda e: F.try_variant_get(e, "$.body", "string").isNull()
        & ~F.coalesce(F.schema_of_variant(e).startswith("OBJECT"), F.lit(False)),
    )
    # An empty object or text has nothing to go through: no messages, no fault.
    empty = F.to_json(parsed).isin("{}", '""')
    return F.coalesce(parsed.isNotNull() & ~empty & (items.isNull() | odd), F.lit(False))


def _truthy(e: Column, path: str) -> Column:
    value = F.try_variant_get(e, path, "string")
    return F.coalesce(~value.isin("", "0", "0.0", "false"), F.lit(False))


def from_parsed(parsed: Column) -> Column:
    """Array of (role, body) in comment order; comments without a body are dropped."""
    def message(e: Column) -> Column:
        # An absent key gives SQL NULL; an explicit JSON null gives a variant null.
        is_public = F.variant_get(e, "$.public", "variant").isNull() | _truthy(e, "$.public")
        role = F.when(is_public & _truthy(e, "$.author_id"), "customer").otherwise("agent")
        return F.struct(
            role.alias("role"), F.try_variant_get(e, "$.body", "string").alias("body"),
        )

    made = F.filter(F.transform(elements(parsed), message), lambda m: F.coalesce(m["body"], F.lit("")) != "")
    return F.coalesce(made, F.array().cast(MESSAGES_TYPE))


def with_description(messages: Column, description: Column) -> Column:
    """A non-empty description becomes customer message 0."""
    first = F.array(F.struct(F.lit("customer").alias("role"), description.alias("body")))
    return F.when(
        F.coalesce(description, F.lit("")) != "", F.concat(first.cast(MESSAGES_TYPE), messages)
    ).otherwise(messages)

"""All registered queries."""

from ticketmill.catalog import intents, privacy, tables, text  # noqa: F401
from ticketmill.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

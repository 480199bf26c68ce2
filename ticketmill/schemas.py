"""Table schemas of the three namespaces, and the write-time null check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LONG, _STR, _TS = T.LongType(), T.StringType(), T.TimestampType()
_DBL, _BOOL = T.DoubleType(), T.BooleanType()


def _table(**fields: T.DataType | tuple[T.DataType, str]) -> T.StructType:
    """Fields given as ``(type, "required")`` may not be null."""
    return T.StructType([
        T.StructField(name, spec[0], False) if isinstance(spec, tuple) else T.StructField(name, spec, True)
        for name, spec in fields.items()
    ])


def _req(dtype: T.DataType) -> tuple[T.DataType, str]:
    return dtype, "required"


RAW_TICKETS = _table(
    ticket_id=_req(_LONG), subject=_STR, description=_STR, comments_json=_STR,
    created_at=_req(_TS), updated_at=_req(_TS), tags=T.ArrayType(_STR), channel=_STR,
    assignee_id=_LONG, status=_STR, priority=_STR, requester_email=_STR, ingested_at=_req(_TS),
)
CLEAN_TICKETS = _table(
    ticket_id=_req(_LONG), text_full=_STR, text_customer_only=_STR, text_agent_only=_STR,
    channel=_STR, word_count=_LONG, has_pii_redacted=_req(_BOOL), processed_at=_req(_TS),
)
# Tickets that cleaning could not read, as they came.
QUARANTINE = T.StructType([*RAW_TICKETS, T.StructField("processed_at", _TS, False)])
# Beside the clean table (ours): the fingerprint of the input that each ticket was last processed from.
CLEAN_INPUTS = _table(ticket_id=_req(_LONG), input_hash=_req(_LONG), processed_at=_req(_TS))
EMBEDDINGS = _table(
    ticket_id=_req(_LONG), embedding_vector=T.ArrayType(_DBL),
    model_version=_req(_STR), created_at=_req(_TS),
)
CLUSTERS = _table(
    ticket_id=_req(_LONG), cluster_id=_req(_LONG), distance_to_centroid=_DBL,
    is_noise=_req(_BOOL), umap_x=_DBL, umap_y=_DBL, created_at=_req(_TS),
)
INTENTS = _table(
    intent_id=_req(_STR), cluster_id=_req(_LONG), name=_req(_STR), description=_STR,
    volume=_req(_LONG), avg_resolution_time_hours=_DBL, repetition_score=_DBL,
    risk_level=_STR, composite_score=_DBL, status=_req(_STR),
    created_at=_req(_TS), updated_at=_req(_TS),
)
SUGGESTIONS = _table(
    suggestion_id=_req(_STR), ticket_id=_req(_LONG), intent_id=_req(_STR),
    response_text=_req(_STR), confidence_score=_DBL, similar_ticket_ids=T.ArrayType(_LONG),
    prompt_version=_STR, created_at=_req(_TS),
)
FEEDBACK = _table(
    feedback_id=_req(_STR), suggestion_id=_req(_STR), ticket_id=_req(_LONG), agent_id=_STR,
    action=_req(_STR), edited_text=_STR, rejection_reason=_STR, created_at=_req(_TS),
)

TABLES: dict[str, T.StructType] = {
    "raw.tickets": RAW_TICKETS,
    "raw.quarantine": QUARANTINE,
    "clean.tickets": CLEAN_TICKETS,
    "features.embeddings": EMBEDDINGS,
    "features.clusters": CLUSTERS,
    "features.intents": INTENTS,
    "features.suggestions": SUGGESTIONS,
    "features.feedback": FEEDBACK,
}

CHANNELS = ("email", "social", "web", "chat", "other")
FEEDBACK_ACTIONS = ("accept", "edit", "reject")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to ``schema``, fill absent nullable columns, fail on a null required value.

    The null check is part of the projection, so it costs no extra pass.
    """
    out = []
    for field in schema:
        if field.name in df.columns:
            value = F.col(field.name).cast(field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        if not field.nullable:
            message = F.lit(f"null in required column {field.name}")
            value = F.coalesce(value, F.raise_error(message).cast(field.dataType))
        out.append(value.alias(field.name))
    return df.select(*out)

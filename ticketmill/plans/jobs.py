"""End-to-end jobs: each reads tables, upserts one, and returns its statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import pii as P
from ticketmill.operators import density, labels, reduction, silhouette
from ticketmill.operators.centroids import cluster_stats, distance_to_centroid, noise_summary
from ticketmill.operators.cleaning import clean_tickets
from ticketmill.operators.embedding import MODEL_VERSION, embed, embed_with, fit_embedder
from ticketmill.operators.quality import cleaning_stats
from ticketmill.operators.redaction import TEXT_FIELDS, redact
from ticketmill.operators.tickets import first_n, missing_from, with_text
from ticketmill.schemas import CLEAN_INPUTS
from ticketmill.session import settle
from ticketmill.sources.tables import SnapshotTable, load_embeddings

# The raw columns that ``clean_tickets`` reads.
CLEANED_FROM = ("subject", "description", "comments_json", "channel")

Encode = Callable[[list[str]], list[list[float]]]


def clean_and_redact(raw: DataFrame, rules: Sequence[P.Rule] = P.RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw rows to clean rows plus ``is_faulty`` and the columns ``keep``, in one narrow lazy plan."""
    cleaned = clean_tickets(raw, keep)
    return redact(cleaned, TEXT_FIELDS, rules, "has_pii_redacted").withColumn(
        "processed_at", F.current_timestamp()
    )


def run_clean(
    raw: DataFrame, clean: SnapshotTable, limit: int | None = None, reprocess: bool = False,
    rules: Sequence[P.Rule] = P.RULES, quarantine: SnapshotTable | None = None,
) -> dict[str, float]:
    """Clean what is not yet clean, or has changed since (or everything), and upsert it by ticket.

    A ticket has changed if the fingerprint of the columns that cleaning reads differs from the one
    that ``processed_inputs`` holds for it. Clock times play no part, so a version that arrives while a run is
    on is found by the next run, and one that changes other columns only is not cleaned again.
    New ``rules`` need ``reprocess``. Tickets whose comments are malformed are counted as errors and,
    with ``quarantine``, stored there; they are tried again once they change, not on every run.
    """
    inputs = processed_inputs(clean)
    todo = raw.withColumn("input_hash", input_hash())
    if not reprocess:
        todo = changed(todo, inputs.read())
    todo = settle(first_n(todo, limit), "todo")
    done = settle(clean_and_redact(todo, rules, keep=("input_hash",)), "cleaned")
    stats = cleaning_stats(done).first().asDict()
    good = done.filter(~F.col("is_faulty"))
    clean.upsert(good, keep=(), order=("processed_at",))
    if quarantine is not None:
        bad = todo.join(done.filter("is_faulty").select("ticket_id", "input_hash", "processed_at"), ["ticket_id", "input_hash"])
        quarantine.upsert(bad, keep=(), order=("processed_at",))
    # Last, so that a run that dies before is done again, with the same result.
    inputs.upsert(good if quarantine is None else done, keep=(), order=("processed_at",))
    return stats


def processed_inputs(clean: SnapshotTable) -> SnapshotTable:
    """ticket_id, input_hash, processed_at of what ``run_clean`` has processed, beside the clean table."""
    return SnapshotTable(clean.spark, f"{clean.path}.inputs", CLEAN_INPUTS, bucket_rows=clean.bucket_rows).ensure()


def input_hash() -> Column:
    """Fingerprint of what cleaning reads of a raw ticket; a null differs from any text, also in the next column."""
    return F.xxhash64(*[c for name in CLEANED_FROM for c in (F.col(name), F.col(name).isNull())])


def changed(raw: DataFrame, done: DataFrame) -> DataFrame:
    """Tickets (with ``input_hash``) that ``done`` lacks or made from other input."""
    seen = done.select("ticket_id", F.col("input_hash").alias("_seen"), F.lit(True).alias("_known"))
    fresh = raw.join(seen, "ticket_id", "left")
    return fresh.filter(F.col("_known").isNull() | ~F.col("_seen").eqNullSafe(F.col("input_hash"))).drop("_seen", "_known")


def run_embeddings(
    clean: DataFrame, embeddings: SnapshotTable, model: PipelineModel | None = None,
    limit: int | None = None, reprocess: bool = False, col: str = "text_customer_only",
    model_version: str = MODEL_VERSION, encode: Encode | None = None, batch_size: int = 100,
) -> dict[str, int]:
    """Embed what has no vector yet. Pass the saved model on every run after the first.

    ``encode`` takes any other model: a list of texts to vectors, called per batch in the
    tasks. A batch that fails counts whole as errors and is left for the next run.
    """
    texts = with_text(clean, col)
    todo = first_n(texts if reprocess else missing_from(texts, embeddings.read()), limit)
    if encode is not None:
        made = settle(embed_with(todo, "ticket_id", col, encode, batch_size), "encoded")
    else:
        model = model or fit_embedder(texts, col)
        made = settle(embed(todo, col, model).select("ticket_id", "embedding_vector"), "embedded")
    good = made.filter(F.col("embedding_vector").isNotNull())
    errors = made.filter(F.col("embedding_vector").isNull()).count()
    rows = good.select(
        "ticket_id", "embedding_vector", F.lit(model_version).alias("model_version"),
        F.current_timestamp().alias("created_at"),
    )
    result = embeddings.upsert(rows, keep=(), order=("created_at",))
    done = result.inserted + result.updated
    return {"processed": done, "errors": errors, "total": done + errors}


def cluster_vectors(
    vectors: DataFrame, min_cluster_size: int | None = None,
    dimensions: int = reduction.CLUSTER_DIMENSIONS,
) -> tuple[DataFrame, DataFrame]:
    """(ticket_id, embedding_vector) to cluster rows, and the reduced points with labels."""
    reduced = settle(
        reduction.reduce(vectors, "embedding_vector", dimensions).select("ticket_id", "reduced"), "reduced"
    )
    labelled = density.density_cluster(reduced, "ticket_id", "reduced", min_cluster_size)
    points = settle(reduced.join(labelled, "ticket_id"), "labelled")
    rows = reduction.plot_coordinates(distance_to_centroid(points, "ticket_id", "reduced")).select(
        "ticket_id", "cluster_id", "distance_to_centroid",
        (F.col("cluster_id") < 0).alias("is_noise"), "umap_x", "umap_y",
        F.current_timestamp().alias("created_at"),
    )
    return rows, points


def run_clustering(
    embeddings: DataFrame, clusters: SnapshotTable, limit: int | None = None,
    min_cluster_size: int | None = None, exact_silhouette: bool = False,
) -> dict:
    """Cluster all embeddings, upsert the result, report size, noise and quality.

    The score is the linear-time squared one, under its own name; ``exact_silhouette``
    asks for the Euclidean one, whose work grows with the square of the points.
    """
    # Without a limit there is nothing to order: the operators do not depend on row order.
    embeddings = embeddings.filter(F.col("embedding_vector").isNotNull())
    vectors = embeddings if limit is None else load_embeddings(embeddings, limit)
    if vectors.isEmpty():
        return {"error": "No embeddings found"}
    rows, points = cluster_vectors(vectors, min_cluster_size)
    clusters.upsert(rows, keep=(), order=("created_at",))
    stats = noise_summary(points).first().asDict()
    if exact_silhouette:
        quality = silhouette.cluster_metrics(points, "ticket_id", "reduced").first().asDict()
    else:
        quality = {
            **silhouette.squared_silhouette(points, "reduced").first().asDict(),
            **silhouette.noise_ratio(points).first().asDict(),
        }
    return {**stats, **quality}


def run_labeling(
    clusters: DataFrame, clean: DataFrame, intents: SnapshotTable, limit_clusters: int | None = None,
    replies: DataFrame | None = None,
) -> dict[str, int]:
    """Label the largest clusters and upsert their intents.

    Without ``replies`` (cluster_id, reply) from a model, names are each cluster's
    most telling words; with them, replies are parsed and faulty ones counted.
    """
    stats = settle(labels.top_clusters(cluster_stats(clusters), limit_clusters), "stats")
    members = clusters.select("ticket_id", "cluster_id").join(stats.select("cluster_id"), "cluster_id", "left_semi")
    if replies is None:
        texts = members.join(clean.select("ticket_id", "text_customer_only"), "ticket_id")
        named, errors = labels.keyword_labels(texts), 0
    else:
        parsed = labels.parse_labels(replies.join(stats.select("cluster_id"), "cluster_id", "left_semi"))
        named = parsed.filter(~F.col("is_faulty")).select(
            "cluster_id", F.coalesce("name", F.lit(labels.FALLBACK_NAME)).alias("name"), "description"
        )
        errors = parsed.filter("is_faulty").count()
    result = intents.upsert(labels.intent_rows(stats, named))
    # Intents of clusters that no longer exist are retired, not listed on.
    gone = missing_from(intents.read(), clusters.select("cluster_id").distinct(), "cluster_id").filter(
        F.col("status") != labels.RETIRED_INTENT_STATUS)
    intents.upsert(gone.withColumns({
        "status": F.lit(labels.RETIRED_INTENT_STATUS), "updated_at": F.current_timestamp()}))
    return {
        "total_clusters": stats.count(), "labeled": result.inserted + result.updated, "errors": errors,
    }


def prompts_for(
    clusters: DataFrame, clean: DataFrame, limit_clusters: int | None = None, examples: int = labels.EXAMPLES_PER_CLUSTER
) -> DataFrame:
    """cluster_id and examples_text for a model, for the clusters that ``run_labeling`` would label."""
    stats = labels.top_clusters(cluster_stats(clusters), limit_clusters)
    chosen = clusters.join(stats.select("cluster_id"), "cluster_id", "left_semi")
    return labels.label_prompts(labels.cluster_examples(chosen, clean, examples))

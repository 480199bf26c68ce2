"""From raw documents to packed training sequences: five stages over the ``documents`` table.

Every stage works on all that its predecessor kept, and its decisions take effect: all but the
last hand on the columns of ``documents``, the last one returns the packed pieces. Rows
without a doc_id are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm import bins, decontaminate, fuzzy_lines, languages, simhash
from ticketmill.llm.common import documents, join_checked, settle
from ticketmill.llm.encoding import vocabulary_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.5
BATCH_ROWS = "1000"


def _small_batches(spark: SparkSession) -> None:
    """Rows are whole texts, so the Arrow batches between the JVM and Python stay small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, by a posterior of ``LEAST_SCORE`` or more; others are rejected."""
    _small_batches(spark)
    vocabulary = vocabulary_path("piece_bpe_32k.model")
    model = languages.train(docs.filter(~languages.held_out(F.col("doc_id"))), vocabulary)
    found = languages.predict(docs.filter(F.col("doc_id").isNotNull()), model, vocabulary)
    kept = found.filter((F.col("lang_pred") != languages.UNDEFINED) & (F.col("score") >= LEAST_SCORE))
    return kept.select("row.*").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; documents of which no word is left go."""
    _small_batches(spark)
    cut = fuzzy_lines.drop_lines(docs, fuzzy_lines.removals(docs, least_words=1))
    left = cut.filter((F.col("n_removed") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    return left.select(
        "doc_id", F.col("kept").alias("text"), "row.lang", "row.source",
        F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length("kept")).cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest doc_id."""
    _small_batches(spark)
    kept = settle(simhash.groups(docs).filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct(), "kept")
    return join_checked(docs, kept, "doc_id", "left_semi", 16).select(*COLUMNS)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontaminate.contaminated(docs, documents(spark, sf_dir, "benchmark"))
    hit = settle(found.filter("n_hit > 0").select("doc_id"), "hit")
    return join_checked(docs, hit, "doc_id", "left_anti", 16).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of the documents placed in a sequence of a permitted length."""
    _small_batches(spark)
    return bins.pack_documents(bins.token_lengths(docs, vocabulary_path("byte_bpe_50k.json")))


STAGES = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", remove_benchmarks),
    ("packing", pack_sequences),
]
# The language model and the packing are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs

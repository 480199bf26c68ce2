"""Text to vectors: a local, deterministic default, and a hook for any other model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions.text import strip

# --- Fixed values ------------------------------------------------------------
DIMENSIONS = 1536
BLANK_TOKEN = "[vacío]"
# -----------------------------------------------------------------------------
MODEL_VERSION = f"hashing-tfidf-{DIMENSIONS}"
_TEXT = "_embed_text"


def fill_blank(c: Column) -> Column:
    """Blank text becomes a placeholder, so that it has a vector too."""
    return F.when(F.coalesce(strip(c), F.lit("")) == "", F.lit(BLANK_TOKEN)).otherwise(c)


def fit_embedder(df: DataFrame, col: str, dimensions: int = DIMENSIONS) -> PipelineModel:
    """Hashed term counts, inverse document frequency, unit length.

    One pass; a task sends one vector of document frequencies. Keep the fitted model
    (it can be saved) and embed later batches with it, or vectors will not compare.
    """
    tokens = RegexTokenizer(inputCol=_TEXT, outputCol="_tok", pattern=r"[^\p{L}\p{N}]+")
    counts = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=dimensions)
    idf = IDF(inputCol="_tf", outputCol="_idf", minDocFreq=1)
    unit = Normalizer(inputCol="_idf", outputCol="_unit", p=2.0)
    return Pipeline(stages=[tokens, counts, idf, unit]).fit(
        df.select(fill_blank(F.col(col)).alias(_TEXT))
    )


def embed(
    df: DataFrame, col: str, model: PipelineModel, out: str = "embedding_vector",
) -> DataFrame:
    """Adds the vector of one text column; a narrow pass."""
    made = model.transform(df.withColumn(_TEXT, fill_blank(F.col(col))))
    return made.withColumn(out, vector_to_array("_unit")).drop(_TEXT, "_tok", "_tf", "_idf", "_unit")


def embed_with(
    df: DataFrame, id_col: str, col: str, encode: Callable[[list[str]], list[list[float]]],
    batch_size: int = 100, out: str = "embedding_vector",
) -> DataFrame:
    """The hook: ``encode`` maps a list of texts to vectors, called per batch in each task.

    A batch that raises yields null vectors, so the caller can count and retry it.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), batch_size):
                part = b.iloc[at:at + batch_size]
                try:
                    vectors = [list(map(float, v)) for v in encode(part["text"].tolist())]
                except Exception:  # noqa: BLE001 - any model failure fails the batch, not the job
                    vectors = [None] * len(part)
                yield pd.DataFrame({id_col: part["id"], out: vectors})

    texts = df.select(F.col(id_col).alias("id"), fill_blank(F.col(col)).alias("text"))
    return texts.mapInPandas(run, f"{id_col} long, {out} array<double>")

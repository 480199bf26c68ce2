"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.session import join_checked, settle

__all__ = ["settle", "shuffle_width", "join_checked", "documents", "LETTERS", "lower_ascii"]

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col):
    """A-Z to a-z and nothing else, unlike ``lower``."""
    return F.translate(col, LETTERS, LETTERS.lower())

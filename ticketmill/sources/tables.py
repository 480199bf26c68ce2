"""Keyed parquet tables with atomic upserts, and plain append sinks.

A table is a folder of immutable parquet plus a log of numbered snapshot files. Rows lie in
buckets, ranges of the key whose bounds come from the keys themselves: a bucket that outgrows
twice the target size is split at its quantiles when it is next written. So there are as many
buckets as the rows need, however far the ids are spread, and a batch reads and rewrites only
the ranges that it touches. Readers take the newest snapshot file; a writer moves the next
number into place, which fails if someone else did.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.operators.tickets import latest_version
from ticketmill.schemas import TABLES, conform
from ticketmill.session import settle

BUCKET_ROWS = 1_000_000
# Files that the rows of one bucket are written to.
BUCKET_FILES = 8


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Publish a small file on any Hadoop file system, whole or not at all; fail if it exists."""
    folder, _, name = path.rpartition("/")
    fs, part = _hadoop(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(part, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    jvm = spark.sparkContext._jvm
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(part, fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), none)  # never overwrites
    except Exception:
        fs.delete(part, False)
        raise


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _hadoop(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


@dataclass(frozen=True)
class UpsertResult:
    inserted: int
    updated: int
    version: int
    skipped: bool = False


def range_of(key: Column, bounds: Sequence[int]) -> Column:
    """Number of the range that holds ``key``; ``bounds`` are the lower ends of ranges 1, 2, ..."""
    @F.pandas_udf("long")
    def search(keys: pd.Series) -> pd.Series:
        import numpy as np

        return pd.Series(np.searchsorted(np.array(bounds, "int64"), keys.to_numpy("int64"), side="right"))

    return search(key) if bounds else F.lit(0).cast("long")


class SnapshotTable:
    """One table under ``path``; ``keys[0]`` is the numeric id whose ranges are the buckets.

    The snapshot lists the buckets in order: lower end (null for the first), rows, folder.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType,
        keys: Sequence[str] = ("ticket_id",), bucket_rows: int = BUCKET_ROWS,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.bucket_rows = tuple(keys), bucket_rows

    # -- snapshots ---------------------------------------------------------
    def _snapshot(self) -> dict:
        names = [n for n in list_names(self.spark, f"{self.path}/_log") if n.endswith(".json") and n[0] != "."]
        if not names:
            return {"version": 0, "buckets": [{"from": None, "rows": 0, "folder": None}], "batches": {}}
        return json.loads(read_text(self.spark, f"{self.path}/_log/{max(names)}"))

    def _commit(self, snapshot: dict) -> None:
        name = f"{snapshot['version']:012d}.json"
        write_text(self.spark, f"{self.path}/_log/{name}", json.dumps(snapshot))

    def ensure(self) -> SnapshotTable:
        """Create the empty table unless it exists."""
        if not list_names(self.spark, f"{self.path}/_log"):
            self._commit({**self._snapshot(), "version": 1})
        return self

    def has_stream(self, stream: str) -> bool:
        """Whether a batch of this stream has been taken up before."""
        return stream in self._snapshot()["batches"]

    # -- reading -----------------------------------------------------------
    def _load(self, buckets: Sequence[dict]) -> DataFrame:
        folders = [b["folder"] for b in buckets if b["folder"]]
        loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in self.schema])
        if not folders:
            return self.spark.createDataFrame([], loose)
        return self.spark.read.schema(loose).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self) -> DataFrame:
        return self._load(self._snapshot()["buckets"])

    # -- writing -----------------------------------------------------------
    def upsert(
        self, updates: DataFrame, keep: Sequence[str] = ("created_at",),
        order: Sequence[str] = ("updated_at",), stream: str | None = None, batch_id: int | None = None,
        newest_wins: bool = False,
    ) -> UpsertResult:
        """Insert new keys, overwrite known ones row-wise (nulls too), but keep ``keep``.

        Several rows of one key in a batch count once: the newest by ``order`` wins.
        Across batches the later arrival wins, or with ``newest_wins`` the later by all
        of ``order`` (nulls first), so that late files cannot undo newer ones and the
        order of arrival does not matter, on equal times either.
        With ``stream`` and ``batch_id`` a repeated batch is recognised and skipped.
        """
        before = self._snapshot()
        last = before["batches"].get(stream) if stream else None
        if last is not None and batch_id is not None and batch_id <= last:
            return UpsertResult(0, 0, before["version"], skipped=True)
        buckets, key = before["buckets"], F.col(self.keys[0])
        stored_order = [c for c in order if c in self.schema.names]
        newest = latest_version(updates, self.keys, order).drop(*[c for c in order if c not in stored_order])
        place = range_of(key, [b["from"] for b in buckets[1:]])
        new = settle(conform(newest, self.schema).withColumn("_bucket", place), "updates")
        # One row a bucket: their number follows the rows stored, not the spread of the keys.
        touched = {r[0] for r in new.select("_bucket").distinct().collect()}
        if not touched:
            return UpsertResult(0, 0, before["version"])
        old = self._load([b for i, b in enumerate(buckets) if i in touched])

        keys = list(self.keys)
        known = old.select(*keys).withColumn("_known", F.lit(True))
        counts = new.select("_bucket", *keys).join(known, keys, "left").groupBy("_bucket").agg(
            F.count_if(F.col("_known").isNull()).alias("inserted"), F.count("_known").alias("updated")
        ).collect()
        rows = {r["_bucket"]: buckets[r["_bucket"]]["rows"] + r["inserted"] for r in counts}
        after, at = self._split(buckets, rows, new, old, place)

        n, o = new.drop("_bucket").withColumn("_new", F.lit(True)).alias("n"), old.withColumn("_old", F.lit(True)).alias("o")
        joined = n.join(o, [F.col(f"n.{k}") == F.col(f"o.{k}") for k in keys], "full_outer")
        is_new = F.col("n._new").isNotNull()
        if newest_wins and stored_order:
            mine, theirs = (F.struct(*[F.col(f"{side}.{c}") for c in stored_order]) for side in "no")
            is_new = is_new & (F.col("o._old").isNull() | (mine >= theirs))

        def pick(name: str) -> F.Column:
            fresh, stored = F.col(f"n.{name}"), F.col(f"o.{name}")
            if name in keep:
                return F.when(F.col("o._old").isNotNull(), stored).otherwise(fresh)
            return F.when(is_new, fresh).otherwise(stored)

        merged = joined.select(*[pick(c).alias(c) for c in self.schema.names])
        version = before["version"] + 1
        folder = f"data/{version:012d}-{uuid.uuid4().hex[:8]}"
        # The ranges are known, so nothing is sampled and the join runs once.
        placed = merged.withColumn("_bucket", range_of(key, [b["from"] for b in after[1:]]))
        placed.repartition("_bucket", F.pmod(F.hash(*keys), F.lit(BUCKET_FILES))).sortWithinPartitions(
            "_bucket", *keys
        ).write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        made = set(list_names(self.spark, f"{self.path}/{folder}"))
        for i in at:
            after[i]["folder"] = f"{folder}/_bucket={i}" if f"_bucket={i}" in made else None
        self._commit({
            "version": version, "buckets": after,
            "batches": {**before["batches"], **({stream: batch_id} if stream else {})},
        })
        return UpsertResult(sum(r["inserted"] for r in counts), sum(r["updated"] for r in counts), version)

    def _split(
        self, buckets: list[dict], rows: dict[int, int], new: DataFrame, old: DataFrame, place: Column
    ) -> tuple[list[dict], list[int]]:
        """The buckets after a batch that leaves ``rows`` in each it touches, and the places of those written."""
        pieces = {i: -(-n // self.bucket_rows) for i, n in rows.items() if n > 2 * self.bucket_rows}
        cuts: dict[int, list[int]] = {}
        if pieces:
            most = max(pieces.values())
            key = self.keys[0]
            every = new.select("_bucket", key).union(old.select(place.alias("_bucket"), key))
            for r in every.filter(F.col("_bucket").isin(*pieces)).groupBy("_bucket").agg(
                F.percentile_approx(key, [k / most for k in range(1, most)], 10_000).alias("q")
            ).collect():
                m = pieces[r["_bucket"]]
                low = buckets[r["_bucket"]]["from"]
                chosen = {r["q"][min(most - 2, round(k * most / m) - 1)] for k in range(1, m)}
                cuts[r["_bucket"]] = sorted(c for c in chosen if low is None or c > low)
        after, written = [], []
        for i, b in enumerate(buckets):
            if i not in rows:
                after.append(dict(b))
                continue
            parts = [b["from"], *cuts.get(i, [])]
            for lower in parts:
                written.append(len(after))
                # An even share; the true number only matters for the next split.
                after.append({"from": lower, "rows": -(-rows[i] // len(parts)), "folder": None})
        return after, written


# What identifies a row of each table.
KEYS: dict[str, tuple[str, ...]] = {
    "raw.tickets": ("ticket_id",),
    "raw.quarantine": ("ticket_id",),
    "clean.tickets": ("ticket_id",),
    "features.embeddings": ("ticket_id",),
    "features.clusters": ("ticket_id",),
    "features.intents": ("cluster_id",),
    "features.suggestions": ("ticket_id", "suggestion_id"),
    "features.feedback": ("ticket_id", "feedback_id"),
}


def table(spark: SparkSession, root: str, name: str, bucket_rows: int = BUCKET_ROWS) -> SnapshotTable:
    return SnapshotTable(spark, f"{root}/{name}", TABLES[name], KEYS[name], bucket_rows)


def ensure_tables(spark: SparkSession, root: str, bucket_rows: int = BUCKET_ROWS) -> dict[str, SnapshotTable]:
    """Every table of the model, created where absent."""
    return {name: table(spark, root, name, bucket_rows).ensure() for name in TABLES}


def append(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Accumulating append (UNION ALL); batching is Spark's business."""
    conform(df, schema).write.mode("append").parquet(path)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str] = ("ticket_id",),
           keep: Sequence[str] = ("created_at",), order: Sequence[str] = ("updated_at",)) -> DataFrame:
    """The same merge as a pure DataFrame expression, for in-memory targets."""
    names, keys = target.columns, list(keys)
    n = latest_version(updates, keys, order).select(*names).withColumn("_new", F.lit(True)).alias("n")
    o = target.withColumn("_old", F.lit(True)).alias("o")
    joined = n.join(o, [F.col(f"n.{k}") == F.col(f"o.{k}") for k in keys], "full_outer")
    out = []
    for c in names:
        fresh, stored = F.col(f"n.{c}"), F.col(f"o.{c}")
        rule = F.when(F.col("o._old").isNotNull(), stored).otherwise(fresh) if c in keep else \
            F.when(F.col("n._new").isNotNull(), fresh).otherwise(stored)
        out.append(rule.alias(c))
    return joined.select(*out)


def upsert_counts(target: DataFrame, updates: DataFrame, keys: Sequence[str] = ("ticket_id",)) -> DataFrame:
    """inserted and updated key counts; only key columns are read."""
    keys = list(keys)
    known = target.select(*keys).withColumn("_known", F.lit(True))
    return updates.select(*keys).distinct().join(known, keys, "left").agg(
        F.count_if(F.col("_known").isNull()).alias("inserted"), F.count("_known").alias("updated")
    )


def load_embeddings(df: DataFrame, limit: int | None = None) -> DataFrame:
    out = df.select("ticket_id", "embedding_vector").orderBy("ticket_id")
    return out if limit is None else out.limit(limit)

"""Incremental and backfill ingestion from landing files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.operators.tickets import first_n, time_range
from ticketmill.sources.landing import (
    TICKET_JSON,
    bad_comments,
    bad_lines,
    comment_lines,
    landing_lines,
    parse_tickets,
    read_tickets,
    to_raw_rows,
)
from ticketmill.session import settle
from ticketmill.sources.tables import SnapshotTable

FIRST_RUN_HOURS = 24


@dataclass
class IngestStats:
    inserted: int = 0
    updated: int = 0
    bad_records: int = 0
    batches: int = 0


def stream_upsert(
    source: DataFrame, target: SnapshotTable, checkpoint: str, *, stream: str = "incremental",
    keep: tuple[str, ...] = ("created_at",), order: tuple[str, ...] = ("updated_at",), prepare=None,
) -> IngestStats:
    """Drain ``source`` into ``target`` and stop.

    Late files never undo newer rows: the greater by all of ``order`` wins, also across
    batches. The checkpoint holds the position; the target remembers the last batch of this
    stream, so a batch replayed after a crash changes nothing.
    """
    stats = IngestStats()

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch, batch_id, stats) if prepare else batch
        result = target.upsert(rows, keep, order, stream=stream, batch_id=batch_id, newest_wins=True)
        stats.inserted += result.inserted
        stats.updated += result.updated
        stats.batches += 1

    query = (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stats


def run_incremental(
    spark: SparkSession, landing: str, target: SnapshotTable, checkpoint: str, quarantine: str,
    start: Column | None = None, max_files: int | None = None, stream: str = "incremental",
) -> IngestStats:
    """Pick up landing files not seen before, upsert their tickets, set bad lines aside.

    ``start`` filters by ``updated_at``, by default to the last 24 hours, and holds for the
    first run only: once the target has taken a batch of this stream, the saved position
    decides. Quarantine files are named by batch, so a replay overwrites rather than
    doubles them.
    """
    reader = spark.readStream.schema(TICKET_JSON)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    resumed = target.has_stream(stream)
    if start is None:
        start = F.current_timestamp() - F.make_interval(hours=F.lit(FIRST_RUN_HOURS))

    def prepare(lines: DataFrame, batch_id: int, stats: IngestStats) -> DataFrame:
        # The files are parsed once; what follows reads the parsed lines.
        parsed = settle(lines.withColumn("requester", F.to_json("requester")).withColumn(
            "comments", F.transform("comments", lambda c: F.to_json(c))), "lines")
        parsed = parsed.withColumn("requester", F.try_parse_json("requester")).withColumn(
            "comments", F.transform("comments", lambda c: F.try_parse_json(c)))
        where = f"{quarantine}/batch={batch_id}"
        bad_lines(parsed).write.mode("overwrite").text(where)
        stats.bad_records += spark.read.text(where).count()
        tickets = to_raw_rows(parse_tickets(parsed))
        return tickets if resumed else time_range(tickets, start)

    return stream_upsert(reader.json(landing), target, checkpoint, stream=stream, prepare=prepare)


def run_backfill(
    spark: SparkSession, landing: str, target: SnapshotTable, *, comments: str | None = None,
    start: Column | None = None, limit: int | None = None, quarantine: str | None = None,
) -> dict[str, int]:
    """Load a whole landing folder in one batch, by default the last 365 days; the limit is exact.

    Unreadable ticket and comment lines are counted and, with ``quarantine``, stored there.
    """
    tickets = time_range(read_tickets(spark, landing, comments), start)
    result = target.upsert(first_n(tickets, limit))
    bad = bad_lines(landing_lines(spark, landing))
    if comments is not None:
        bad = bad.union(bad_comments(comment_lines(spark, comments)))
    bad = settle(bad, "bad")
    if quarantine is not None:
        bad.write.mode("append").text(quarantine)
    return {"inserted": result.inserted, "updated": result.updated, "bad_records": bad.count()}

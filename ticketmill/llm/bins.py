"""Best-fit packing of documents into training sequences of several permitted lengths.

Documents longer than the longest sequence are cut into pieces of that length and a rest.
Pieces are dealt evenly over shards of about ``SHARD_PIECES``; each shard is packed on its
own, largest piece first. A piece goes to the open bin that it fills best. If none has room,
a bin is opened in the size of least expected cost: its length plus a fixed price a sequence,
over the tokens that it would hold once the still unplaced pieces fill it greedily. In the
end each bin shrinks to the smallest permitted length that holds its contents.

No token is lost or doubled. Empty documents of length 0 take no place and give no row; with
the end id counted every document has at least one token. Repeated rows are pieces of their
own; ties are placed by doc_id. A null length counts as 0.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import settle
from ticketmill.llm.encoding import encoder

CAPACITIES = (512, 1024, 2048, 4096, 8192)
SHARD_PIECES = 20_000
SEQUENCE_PRICE = 16


def open_cost(capacity: int, first: int, lengths: list[int], upto: int) -> float:
    """Price of a sequence over the tokens in it, if ``lengths[:upto]`` (ascending) fill it greedily."""
    room = capacity - first
    at = upto
    while room > 0 and (at := bisect_right(lengths, room, 0, at) - 1) >= 0:
        room -= lengths[at]
    return (capacity + SEQUENCE_PRICE) / (capacity - room)


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES) -> list[tuple[int, int]]:
    """(bin, offset) of each length; none exceeds the largest capacity or is below 1."""
    caps = sorted(capacities)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    ascending = sorted(lengths)
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    rooms: list[int] = []  # different free rooms of open bins, ascending
    open_bins: dict[int, list[int]] = {}
    sizes: list[int] = []
    for rank, i in enumerate(order):
        need = lengths[i]
        k = bisect_left(rooms, need)
        if k < len(rooms):
            room = rooms[k]
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[k]
        else:
            left = len(order) - rank - 1
            room = min((c for c in caps if c >= need), key=lambda c: (open_cost(c, need, ascending, left), c))
            chosen = len(sizes)
            sizes.append(room)
        placed[i] = (chosen, sizes[chosen] - room)
        if room > need:
            if room - need not in open_bins:
                insort(rooms, room - need)
                open_bins[room - need] = []
            open_bins[room - need].append(chosen)
    return placed


def token_lengths(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and n_tokens, the ids of the whole text and the end id; a null text has the end id only."""
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encode = encoder(vocabulary).encode
        for batch in batches:
            n = []
            for at in range(0, batch.num_rows, 100):
                n += [len(ids) // 4 + 1 for ids in encode(batch.column(1).slice(at, 100).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "doc_id long, n_tokens long")


def pack_documents(lengths: DataFrame, capacities: tuple[int, ...] = CAPACITIES, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Place every token of ``lengths`` (doc_id, n_tokens).

    Rows: doc_id, piece, start (in the document), length, shard, bin, capacity, offset (in the bin).
    """
    longest, n = max(capacities), F.coalesce("n_tokens", F.lit(0))
    begins = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1, F.lit(longest).cast("long"))).otherwise(
        F.array().cast("array<bigint>"))
    pieces = settle(lengths.select("doc_id", n.alias("n"), F.posexplode(begins).alias("piece", "start")).select(
        "doc_id", "piece", "start", F.least(F.lit(longest).cast("long"), F.col("n") - F.col("start")).alias("length")), "pieces")
    shards = max(1, -(-pieces.count() // shard_pieces))

    def place(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None  # one bounded shard
        if rows is None or not rows.num_rows:
            return
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        length = rows["length"].to_numpy()
        where = np.array(pack(length.tolist(), capacities))
        contents = np.bincount(where[:, 0], length).astype(np.int64)
        caps = np.sort(np.array(capacities))
        sizes = caps[np.searchsorted(caps, contents)]
        shard = np.full(len(length), TaskContext.get().partitionId())
        yield pa.RecordBatch.from_arrays(
            [*(rows[c].combine_chunks() for c in ("doc_id", "piece", "start", "length")), pa.array(shard),
             pa.array(where[:, 0]), pa.array(sizes[where[:, 0]]), pa.array(where[:, 1])],
            names=["doc_id", "piece", "start", "length", "shard", "bin", "capacity", "offset"])

    return pieces.repartition(shards).mapInArrow(
        place, "doc_id long, piece int, start long, length long, shard long, bin long, capacity long, offset long")

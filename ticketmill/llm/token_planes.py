"""Token ids in bit planes: documents to a compressed id file and back.

Documents lie in ascending ``doc_id`` order over shards. A shard is a run of chunks, each
holding the ids of whole documents; a chunk cuts its ids into blocks of a fixed number, turns
every block into bit planes (all lowest bits, all second bits, ...), and compresses each
plane with zstandard. Planes above the highest bit of a block are not stored. A chunk is one
row of a Parquet folder (written uncompressed, since planes are already compressed): the
columns beside ``payload`` are the chunk index, which readers scan without the payload.

Null texts count as empty: only the end id is written. Equal ids are ordered by text. An
empty table gives an empty folder with the schema. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketmill.llm.common import join_checked, shuffle_width
from ticketmill.llm.encoding import encoder

BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 18
LEVEL = 1
SCHEMA = (
    "shard int, chunk int, start long, n_ids long, doc_ids array<bigint>, doc_tokens array<bigint>, "
    "block_ids int, plane_bytes array<array<int>>, payload binary"
)


def pack(ids, block_ids: int = BLOCK_IDS) -> tuple[list[list[int]], bytes]:
    """Compressed bit planes of unsigned 32-bit ids, and the bytes of each plane by block."""
    import numpy as np
    import zstandard

    press, sizes, parts = zstandard.ZstdCompressor(level=LEVEL), [], []
    for at in range(0, len(ids), block_ids):
        block = np.ascontiguousarray(ids[at:at + block_ids], dtype="<u4")
        width = int(block.max()).bit_length()
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 4)[:, :(width + 7) // 8], axis=1, bitorder="little")
        planes = np.packbits(np.ascontiguousarray(bits.T[:width]), axis=1)
        done = [press.compress(p.tobytes()) for p in planes]
        sizes.append([len(d) for d in done])
        parts.extend(done)
    return sizes, b"".join(parts)


def unpack(n_ids: int, block_ids: int, plane_bytes: list[list[int]], payload: bytes):
    """The ids of one chunk."""
    import numpy as np
    import zstandard

    expand, ids, at = zstandard.ZstdDecompressor(), np.zeros(n_ids, "<u4"), 0
    for k, sizes in enumerate(plane_bytes):
        n = min(block_ids, n_ids - k * block_ids)
        out = np.zeros((n, 4), np.uint8)
        for bit, size in enumerate(sizes):
            plane = np.frombuffer(expand.decompress(payload[at:at + size]), np.uint8)
            out[:, bit >> 3] |= np.unpackbits(plane, count=n) << (bit & 7)
            at += size
        ids[k * block_ids:k * block_ids + n] = out.view("<u4").ravel()
    return ids


def write_ids(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, block_ids: int = BLOCK_IDS, chunk_ids: int = CHUNK_IDS
) -> None:
    """Encode ``docs`` (doc_id, text), append ``end_id`` to each, and write the id file."""

    def shards(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode, shard = encoder(vocabulary).encode, TaskContext.get().partitionId()
        end, chunk, start = np.array([end_id], "<u4").tobytes(), 0, 0
        names, tokens, parts, held = [], [], [], 0
        schema = pa.schema([
            ("shard", pa.int32()), ("chunk", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("block_ids", pa.int32()),
            ("plane_bytes", pa.list_(pa.list_(pa.int32()))), ("payload", pa.binary()),
        ])

        def close():
            nonlocal chunk, start, names, tokens, parts, held
            sizes, payload = pack(np.frombuffer(b"".join(parts), "<u4"), block_ids)
            row = [[shard], [chunk], [start], [held], [names], [tokens], [block_ids], [sizes], [payload]]
            chunk, start = chunk + 1, start + held
            names, tokens, parts, held = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                some = batch.slice(at, 100)
                for name, ids in zip(some.column(0).to_pylist(), encode(some.column(1).to_pylist())):
                    names.append(name)
                    tokens.append(len(ids) // 4 + 1)
                    parts += (ids, end)
                    held += tokens[-1]
                    if held >= chunk_ids:
                        yield close()
        if names:
            yield close()

    spark = docs.sparkSession
    dealt = docs.select("doc_id", "text").repartitionByRange(shuffle_width(spark), "doc_id")
    ordered = dealt.sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(shards, SCHEMA).write.option("compression", "uncompressed").parquet(path)


def read_documents(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Documents of an id file: doc_id, start, n_tokens, and their ids.

    With ``digest`` the ids stay in the task and ``ids_crc32`` takes their place: the unsigned
    crc32 of the ids as little-endian unsigned 32-bit integers.
    """
    last = "ids_crc32 long" if digest else "ids array<bigint>"
    chunks = spark.read.schema(SCHEMA).parquet(path)

    def decode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                c = batch.slice(row, 1).to_pylist()[0]
                ids = unpack(c["n_ids"], c["block_ids"], c["plane_bytes"], c["payload"])
                ends = np.cumsum(c["doc_tokens"])
                starts = ends - c["doc_tokens"]
                cut = [ids[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                held = [zlib.crc32(x) for x in cut] if digest else [x.tolist() for x in cut]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c["doc_ids"], pa.int64()), pa.array([c["shard"]] * len(cut), pa.int32()),
                     pa.array(starts + c["start"]), pa.array(c["doc_tokens"], pa.int64()),
                     pa.array(held, pa.int64() if digest else pa.list_(pa.int64()))],
                    names=["doc_id", "shard", "within", "n_tokens", last.split()[0]],
                )

    read = chunks.mapInArrow(decode, f"doc_id long, shard int, within long, n_tokens long, {last}")
    # One row a shard: shards are as many as the writer's partitions.
    sizes = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = sizes.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    joined = join_checked(read, before, "shard", "inner", 16)
    return joined.select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", last.split()[0])

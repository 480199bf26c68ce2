"""Importance resampling towards a target distribution, with CRCs of hashed n-grams by columns.

Words are runs of letters a-z (A-Z in lower case), digits and non-ASCII characters; features are
all runs of 1 to ``ORDER`` consecutive words, joined by one space; a feature's bucket is the CRC-32
of its UTF-8 bytes modulo ``BUCKETS``. Each task gathers the different features of a stretch of text,
groups them by byte length into matrices of one byte a cell, one feature a column, and moves all
CRCs of a matrix forward by one byte position at a time; the buckets are then scattered back
to every place where their feature stands.

The buckets of all documents are written once, two bytes a feature. Their counts in the raw and
the target texts (10,000 sums, whatever the number of rows) give each bucket a gain, a document's
weight is the sum over its features, and a seeded Gumbel draw turns weights into a sample without
replacement: the highest ``PERCENT`` per cent of the documents with ``MIN_WORDS`` words or more. The
order of scores comes from a range sort over all tasks.

Null texts have no words, weight 0 and are never drawn; a row without doc_id counts for the
buckets but has a null score and is not drawn; rows that repeat a doc_id are drawn each by its
own score, ties by the smaller doc_id, then by the larger weight. An empty table gives no rows, an
empty target gives gains of the smoothing alone; extra columns are ignored, whatever their names;
long texts are read whole, in a task's memory.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import settle
from ticketmill.operators.ranking import running_total

ORDER = 3
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = 42
STRETCH = 1 << 17
CELLS = 1 << 22
POLYNOMIAL = 0xEDB88320
# Whatever is no letter a-z, digit or byte of a non-ASCII character becomes a space.
TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def crc_table():
    import numpy as np

    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


def crcs(text, starts, lengths):
    """CRC-32 of the slices text[start:start + length] (uint8 array), all slices of one length together."""
    import numpy as np

    table, out = crc_table(), np.zeros(len(starts), np.uint32)
    by_length = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[by_length])) + 1
    for group in np.split(by_length, cuts):
        if not len(group):
            continue
        length = int(lengths[group[0]])
        at_once = max(1, CELLS // max(1, length))
        for k in range(0, len(group), at_once):
            some = group[k:k + at_once]
            matrix = text[starts[some][None, :] + np.arange(length)[:, None]]
            crc = np.full(len(some), 0xFFFFFFFF, np.uint32)
            for column in matrix:
                crc = table[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
            out[some] = ~crc
    return out


def feature_buckets(words: list[bytes], owners, order: int = ORDER, buckets: int = BUCKETS):
    """(owner, bucket) of all runs of 1 to ``order`` words that lie within one owner; owners ascend."""
    import numpy as np

    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.uint16)
    text = np.frombuffer(b" ".join(words), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    runs, owner_parts, bucket_parts = ids, [], []
    for n in range(1, order + 1):
        if n > 1:  # a run is its first n - 1 words and its last word; both have exact numbers
            runs = runs[:-1] * len(known) + ids[n - 1:]
            if not len(runs):
                break
        _, first, runs = np.unique(runs, return_index=True, return_inverse=True)
        within = owners[:len(runs)] == owners[n - 1:]
        found = np.zeros(len(first), np.uint16)
        wanted = np.zeros(len(first), bool)
        wanted[runs[within]] = True
        # Runs across owners share numbers with equal runs inside one; bytes are the same either way.
        at = first[wanted]
        found[wanted] = (crcs(text, starts[at], ends[at + n - 1] - starts[at]) % np.uint32(buckets)).astype(np.uint16)
        owner_parts.append(owners[:len(runs)][within])
        bucket_parts.append(found[runs[within]])
    return np.concatenate(owner_parts), np.concatenate(bucket_parts)


def hashed(docs: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, buckets: the buckets of all features of a row as little-endian 16-bit numbers, in no set order."""
    if buckets > 1 << 16:
        raise ValueError("a bucket number has 16 bits")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            counts = np.zeros(batch.num_rows, np.int64)
            words, owners, parts = [], [], []

            def flush():
                who = np.repeat(np.array([o for o, _ in owners], np.int64), [n for _, n in owners])
                parts.append(feature_buckets(words, who, order, buckets))

            for row, text in enumerate(batch.column(1)):
                mine = (text.as_py() or "").encode().translate(TO_WORDS).split()
                counts[row] = len(mine)
                words += mine
                owners.append((row, len(mine)))
                if len(words) >= STRETCH:
                    flush()
                    words, owners = [], []
            flush()
            who = np.concatenate([p[0] for p in parts])
            what = np.concatenate([p[1] for p in parts])[np.argsort(who, kind="stable")]
            cuts = np.r_[0, np.cumsum(np.bincount(who, minlength=batch.num_rows))] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts),
                 pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(cuts.astype("<i8")), pa.py_buffer(what.astype("<u2"))]).cast(pa.binary())],
                names=["doc_id", "n_words", "buckets"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, buckets binary")


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS):
    """int64 array: how often each bucket stands in ``rows`` (buckets binary). Tasks send one sum a bucket."""
    import numpy as np

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer(), "<u2"), minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(total)], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(raw, target):
    """floor(1000 ln(p / q)) by bucket, each count with one added: how much likelier the target makes a feature."""
    import numpy as np

    ratio = (target + 1.0) * (raw.sum() + float(len(raw))) / ((raw + 1.0) * (target.sum() + float(len(raw))))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(rows: DataFrame, gain) -> DataFrame:
    """``rows`` (doc_id, n_words, buckets) as doc_id, n_words, n_features, weight."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            found = [np.frombuffer(v.as_buffer(), "<u2") for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(f) for f in found], pa.int64()),
                 pa.array([int(gain[f].sum()) for f in found], pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return rows.select("doc_id", "n_words", "buckets").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 times a Gumbel variate) from a hash of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS, min_words: int = MIN_WORDS,
    percent: float = PERCENT, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank (1 for the first drawn; null if not drawn)."""
    rows = settle(hashed(docs, order, buckets), "features")
    wanted = hashed(target.select(F.lit(0).cast("long").alias("doc_id"), "text"), order, buckets)
    gain = gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets))
    scored = weigh(rows, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)).withColumn(
        "turn", F.when((F.col("n_words") >= min_words) & F.col("score").isNotNull(), "0").otherwise("1"))
    scored = settle(scored, "scored")
    drawn = scored.filter("turn = '0'").agg(F.floor(F.count(F.lit(1)) * percent / 100)).first()[0]
    placed = running_total(scored, "turn", [F.col("score").desc(), F.col("doc_id"), F.col("weight").desc()], name="place")
    return placed.select(
        "doc_id", "n_words", "n_features", "weight", "score",
        F.when((F.col("turn") == "0") & (F.col("place") < drawn), F.col("place") + 1).alias("rank"))

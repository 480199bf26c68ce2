"""SimHash near-duplicates: fingerprints, all links within a radius, connected groups.

Words are runs of anything but ASCII white space, A-Z in lower case; features are three
consecutive words (fewer words: the whole sequence), repeats included, hashed by XXH64 with
seed 42. A bit is 1 if it is set in more than half of the hashes. Texts without words, null
and empty ones included, get fingerprint 0 and are linked like any other. Rows with the same
fingerprint meet before anything is compared, so copies cost one row of an aggregate. Rows that repeat a
doc_id keep a row each, by their own texts. Extra columns are ignored, whatever their names; very long texts are
hashed whole, in stretches of features.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import join_checked, settle
from ticketmill.llm.components import connected_components
from ticketmill.llm.hamming import near_links

RADIUS = 2
BLOCKS = 4
SHINGLE = 3
SEED = 42
FEATURES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of one text."""
    import numpy as np
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.r_[0, ends[:-1]].tolist()
    ends = (ends - 1).tolist()
    m = min(n, len(words))
    set_bits, total = np.zeros(64, np.int64), len(words) - m + 1
    for at in range(0, total, FEATURES_AT_ONCE):  # bounds memory on very long texts
        upto = min(total, at + FEATURES_AT_ONCE)
        hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts[at:upto], ends[at + m - 1:upto + m - 1])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            prints = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def groups(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id reachable over links within ``radius``.

    A null doc_id counts as the largest; repeated rows stay repeated.
    """
    prints = settle(fingerprints(docs), "prints")
    first = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "first")
    found = connected_components(near_links(first.select("fp"), radius, blocks))
    roots = settle(first.join(found, first.fp == found.node, "left").select(
        "fp", F.coalesce("component", "fp").alias("root"), "first"), "roots")
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = settle(roots.join(least, "root").select("fp", "component_id"), "named")
    return join_checked(prints, named, "fp", "inner", 16).select("doc_id", "fp", "component_id")


def as_hex(fp):
    """A signed fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

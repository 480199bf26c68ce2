"""Links between 64-bit fingerprints at a small Hamming distance, compared bit-sliced.

Two fingerprints within radius r agree on at least ``blocks - r`` of ``blocks`` bit blocks,
so each is sent to one bucket for every choice of that many blocks. Inside a bucket the bit
planes lie vertically: one machine word holds one bit of 64 fingerprints. Shifting the
planes by s lines up every member with the one s places on; differing bits are summed for
all lanes at once by carry-save counters, and words whose lanes all exceed the radius are
abandoned. Members already connected are not reported again, so a bucket of n members
yields fewer than n links, enough to span its connected groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import settle, shuffle_width

# Members of a bucket that meet in one task; larger buckets are cut into chunks, and every
# pair of chunks is a unit of its own, so no pair of members is left out.
CHUNK = 2048
CHECK_EVERY = 8


def slices(values):
    """Vertical bit planes: row k holds bit k of all values, 64 lanes to a word."""
    import numpy as np

    n = len(values)
    lanes = np.zeros(-(-n // 64) * 64, "<u8")
    lanes[:n] = values
    bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def shifted(planes, s: int):
    """Planes with lane i holding what lane i + s held."""
    import numpy as np

    words, bits = divmod(s, 64)
    out = np.zeros_like(planes)
    width = planes.shape[1] - words
    if width <= 0:
        return out
    out[:, :width] = planes[:, words:] >> np.uint64(bits)
    if bits and width > 1:
        out[:, :width - 1] |= planes[:, words + 1:] << np.uint64(64 - bits)
    return out


def within(planes, s: int, lanes, radius: int):
    """Lanes i of ``lanes`` (words of allowed lanes) where fingerprints i and i + s are within the radius."""
    import numpy as np

    words = np.flatnonzero(lanes)
    if not len(words):
        return words
    first, second = planes[:, words], None
    far = shifted(planes, s)[:, words]
    depth = radius.bit_length() + 1
    over = ~lanes[words]
    counters = [np.zeros(len(words), np.uint64) for _ in range(depth)]
    for k in range(64):
        carry = first[k] ^ far[k]
        for d in range(depth):  # carry-save: add one bit to every lane's counter
            counters[d], carry = counters[d] ^ carry, counters[d] & carry
        over |= carry
        if k % CHECK_EVERY == CHECK_EVERY - 1:
            above = over | _exceeds(counters, radius)
            keep = np.flatnonzero(~above)
            if not len(keep):
                return keep
            if len(keep) < len(words) // 2:
                words, first, far, over = words[keep], first[:, keep], far[:, keep], above[keep]
                counters = [c[keep] for c in counters]
    near = np.zeros(planes.shape[1], np.uint64)
    near[words] = ~(over | _exceeds(counters, radius))
    return np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little"))


def _exceeds(counters, radius: int):
    """Lanes whose counter is above the radius, compared bit by bit from the top."""
    import numpy as np

    above, equal = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for d in reversed(range(len(counters))):
        if radius >> d & 1:
            equal = equal & counters[d]
        else:
            above |= equal & counters[d]
            equal = equal & ~counters[d]
    return above


def span(values, groups, radius: int):
    """Spanning links inside each group of consecutive members: index pairs (i, root)."""
    import numpy as np

    n = len(values)
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[starts, n])
    order = np.argsort(-sizes, kind="stable")  # large groups first: shrinking is cutting the tail
    index = np.concatenate([np.arange(starts[g], starts[g] + sizes[g]) for g in order]) if n else np.arange(0)
    sizes = sizes[order]
    remaining = np.repeat(sizes, sizes) - np.concatenate([np.arange(s) for s in sizes]) if n else index
    group_ends = np.cumsum(sizes)
    root = np.arange(n)
    planes = slices(values[index])
    s, live = 1, n
    while n and sizes[0] > s:
        active = int(group_ends[np.searchsorted(-sizes, -s, side="left") - 1])
        if active <= live // 2 or s == 1:
            live = active
            planes = planes[:, :-(-live // 64)]
        mask = np.zeros(planes.shape[1] * 64, np.uint8)
        mask[:active] = remaining[:active] > s
        allowed = np.packbits(mask, bitorder="little").view("<u8")
        i = within(planes, s, allowed, radius)
        if len(i):
            a, b = root[i], root[i + s]
            for x, y in zip(a[a != b].tolist(), b[a != b].tolist()):
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                if x != y:
                    root[max(x, y)] = min(x, y)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
        s += 1
    member = np.flatnonzero(root != np.arange(n))
    return index[member], index[root[member]]


def near_links(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """Links (a, b) that span the groups of distinct ``prints`` (fp long) within ``radius``.

    Two prints are in one connected group of the links exactly if a chain of prints, each
    within the radius of the next, connects them.
    """
    if not radius < blocks:
        raise ValueError("more blocks than the radius are needed")
    return bucket_links(block_buckets(prints, radius, blocks), radius)


def block_masks(radius: int, blocks: int) -> list[int]:
    """The bits of every choice of ``blocks - radius`` blocks."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    return [sum(((1 << edges[b + 1] - edges[b]) - 1) << edges[b] for b in kept) for kept in combinations(range(blocks), blocks - radius)]


def block_buckets(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """fp and bucket: every two prints within ``radius`` share a bucket."""
    keys = []
    for n, mask in enumerate(block_masks(radius, blocks)):
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(signed))))
    return prints.select("fp", F.explode(F.array(*keys)).alias("bucket"))


def bucket_links(spread: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that span, in every bucket of ``spread`` (fp, bucket), the groups within ``radius``."""
    width = shuffle_width(spread.sparkSession)

    def links(values, groups):
        i, j = span(values.view("<u8"), groups, radius)
        return values[i], values[j]

    def meet(batches: Iterator) -> Iterator:
        """Links of small buckets; members of large ones are handed on (bucket, fp)."""
        import numpy as np

        for values, groups, whole in runs(batches):
            if not whole:
                yield record(groups, values, True)
                continue
            starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
            size = np.repeat(np.diff(np.r_[starts, len(groups)]), np.diff(np.r_[starts, len(groups)]))
            few, many = (size > 1) & (size <= CHUNK), size > CHUNK
            if few.any():
                yield record(*links(values[few], groups[few]), False)
            if many.any():
                yield record(groups[many], values[many], True)

    def compare(batches: Iterator) -> Iterator:
        for values, groups, _ in runs(batches, limit=None):
            yield record(*links(values, groups), False)

    met = settle(spread.repartition(width, "bucket").sortWithinPartitions("bucket", "fp").mapInArrow(
        meet, "a long, b long, large boolean"), "met")
    large = met.filter("large").select(F.col("a").alias("bucket"), F.col("b").alias("fp"))
    counts = large.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.hash("fp"), parts)
    units = F.transform(
        F.filter(F.sequence(F.lit(0), parts - 1), lambda c: c != own),
        lambda c: F.struct(F.least(c, own).alias("x"), F.greatest(c, own).alias("y")),
    )
    placed = large.join(counts, "bucket").select("fp", "bucket", F.explode(units).alias("u")).select(
        "fp", F.xxhash64("bucket", "u.x", "u.y").alias("unit"))
    rest = placed.repartition(width, "unit").sortWithinPartitions("unit", "fp").mapInArrow(
        compare, "a long, b long, large boolean")
    return met.filter("not large").union(rest).select("a", "b")


def record(a, b, large: bool):
    import numpy as np
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), large))], names=["a", "b", "large"])


def runs(batches: Iterator, limit: int | None = 200_000, rows: int = 50_000) -> Iterator:
    """(values, groups, whole) of a stream sorted by group: groups are never parted, unless one
    exceeds ``limit``; its pieces then come with ``whole`` false."""
    import numpy as np

    values, groups, long = np.zeros(0, np.int64), np.zeros(0, np.int64), None
    for batch in batches:
        values = np.concatenate([values, batch.column(0).to_numpy(zero_copy_only=False)])
        groups = np.concatenate([groups, batch.column(1).to_numpy(zero_copy_only=False)])
        if long is not None:
            cut = int(np.searchsorted(groups, long, side="right"))
            if cut:
                yield values[:cut], groups[:cut], False
                values, groups = values[cut:], groups[cut:]
            if len(groups):
                long = None
        if len(values) >= rows:
            cut = int(np.searchsorted(groups, groups[-1]))  # the last group may go on
            if cut:
                yield values[:cut], groups[:cut], True
                values, groups = values[cut:], groups[cut:]
            elif limit is not None and len(values) >= limit:
                long = groups[0]
                yield values, groups, False
                values, groups = values[:0], groups[:0]
    if len(values):
        yield values, groups, long is None

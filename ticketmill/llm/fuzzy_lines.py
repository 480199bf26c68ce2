"""Fuzzy line dedup: SimHash, pigeonhole blocks, edit similarity, one line of each group.

A line is what stands between newlines; it is normalised to its words (runs of anything but
ASCII white space, A-Z in lower case) joined by one space. Lines of fewer than ``least_words``
words are never judged and stay. Equal normalised lines are always linked. Different ones of
``min_words`` or more are linked if they meet in a bucket, their SimHashes (63 bits; different words,
and pairs of them, each once) differ in at most ``radius`` bits and their edit similarity,
1 - distance / longer length in characters, is at least ``similarity``. Buckets are the pigeonhole
blocks, sure up to ``SURE`` bits (up to ``radius`` if there are more blocks than that), and
``BANDS`` least hashes of a word and a pair of words with a class of length, which reach the pairs
further apart with a probability that grows with their common words. ``RADIUS`` lies above nearly all pairs at ``SIMILARITY``.
In a block's bucket a link reaches ``BLOCK_RADIUS`` bits: lines that agree in two blocks by chance, whose number grows with the
square of the lines, mostly differ in 13 to 25 of the other bits, while similar lines so far apart hardly ever agree in two blocks.
Of each connected group the occurrence with the smallest (doc_id, line number) stays.

Only different lines are compared, in two steps. First links that span a bucket's groups
within the radius are found; one for each line is verified. Where that connects all links of a family
of lines, nothing is left to ask. The members of other families then meet with their texts, once a
family, and pairs that are not connected yet are verified until they are, nearest first. Nothing depends
on how far groups within the radius chain from family to family; crowded buckets and families are cut
into chunks, every two of which meet.

Null texts stay null and empty tables give empty results. Rows without a doc_id are left as they
are. Rows that repeat a doc_id are each judged by their own text, and the line in the smallest
(doc_id, line number, text hash) stays; rows that repeat doc_id and text are one document met twice
and lose the same lines. Equal lines of one document are ties by line number. Extra columns are
kept under ``row``, whatever their names. Long texts are read whole, in stretches of lines.
"""

from __future__ import annotations

import os.path
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import join_checked, settle, shuffle_width
from ticketmill.llm.components import connected_components
from ticketmill.llm.edits import Texts, distance
from ticketmill.llm.hamming import CHUNK, block_masks, runs
from ticketmill.llm.substrings import _ODD, mix, stretches

MIN_WORDS = 5
RADIUS = 20
SURE = 3
BLOCK_RADIUS = 10
BLOCKS = 5
BANDS = 12
SIMILARITY = 0.8
BYTES_AT_ONCE = 1 << 20
SEGMENTS = 1024
STRETCH = 120
WALK = 200  # characters of a line from which on its words are walked over first
BEGINNING = 0.45  # of lines, compared before all of them
ALONE = 2  # rounds in which connected lines ask for one comparison, before they do for many at once
AT_ONCE = 1 << 14  # characters of those, more in each further round
PART = 1 << 18  # members of buckets, in all, that a part is meant to have
PART_MOST = 1 << 21  # of a part, before its crowded buckets are sought
PACK, PACKED = 1 << 19, 1 << 10  # that are dealt out together, and that a row holds at most
PAIRS = 1 << 20  # of members of units, looked at together
TEXT_BYTES = 1 << 22  # of lines that are verified together


def _powers(n: int):
    """Powers of the odd multiplier and their inverses, kept for the next call."""
    import numpy as np

    if n > len(_POWERS[0]):
        for k, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            _POWERS[k] = np.cumprod(np.r_[np.uint64(1), np.full(2 * n, base, np.uint64)], dtype=np.uint64)
    return _POWERS


_POWERS: list = [(), ()]


def prints_of(text: bytes, bands: int = BANDS):
    """Lines of a lowered text (each ended by a newline) that hold a word: number, words, digest, SimHash, band keys.

    All words of all lines are cut, hashed and summed as arrays; nothing runs word by word.
    """
    import numpy as np

    data = np.frombuffer(text, np.uint8)
    is_word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    turns = np.flatnonzero(np.diff(np.r_[False, is_word].view(np.int8)))
    begin, end = turns[::2], turns[1::2]
    if not len(begin):
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros((0, bands), np.int32)
    # A word's hash is its bytes as digits, by differences of a running sum.
    powers, back = _powers(len(data))
    sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:len(data)], dtype=np.uint64)
    h = mix((sums[end - 1] - np.where(begin > 0, sums[begin - 1], np.uint64(0))) * back[begin])
    line = np.searchsorted(np.flatnonzero(data == 10), begin)
    first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
    words = np.diff(np.r_[first, len(line)])
    digest = stretches(h, first, first + words).view(np.int64)
    length = np.add.reduceat(end - begin, first) + words
    # Each word once, in order of appearance, so that pairs of neighbours are different too.
    once = _first_places(mix(h + line.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    h, line_once = h[once], line[once]
    starts = np.flatnonzero(np.r_[True, line_once[1:] != line_once[:-1]])
    sizes = np.diff(np.r_[starts, len(h)])
    pairs = np.r_[mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]), np.uint64(0)]
    ends = starts + sizes - 1  # where a pair would reach into the next line
    prints = _majority(h, pairs, starts, sizes, ends)
    keys = np.empty((len(first), bands), np.uint32)
    # Classes of length, in two grids half a class apart: what may be similar is parted in one of them at most.
    steps = np.log(length) / (2 * np.log(1 / SIMILARITY))
    mixed, spare = np.empty((2, len(h)), np.uint64)
    for k in range(bands):
        odd = np.uint64(0xD6E8FEB86659FD93 + 2 * k)
        _mix_into(pairs, odd, mixed, spare)
        mixed[ends] = np.uint64(0xFFFFFFFFFFFFFFFF)
        least_pair = np.minimum.reduceat(mixed, starts)
        _mix_into(h, odd, mixed, spare)
        keys[:, k] = mix(least_pair * np.uint64(_ODD) + np.minimum.reduceat(mixed, starts)
                         + (steps + k % 2 / 2).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return line[first], words, digest, prints, keys.view(np.int32)


def _mix_into(values, odd, out, spare):
    """``mix(values * odd)`` without new arrays."""
    import numpy as np

    np.multiply(values, odd, out=out)
    np.right_shift(out, np.uint64(31), out=spare)
    np.bitwise_xor(out, spare, out=out)
    np.multiply(out, np.uint64(0xBF58476D1CE4E5B9), out=out)
    np.right_shift(out, np.uint64(29), out=spare)
    np.bitwise_xor(out, spare, out=out)


def _first_places(values):
    """Ascending places of the first of each different value."""
    import numpy as np

    # Sorted with their places in the low bits, which is much faster than a sort of places.
    bits = np.uint64(max(1, len(values).bit_length()))
    keyed = np.sort(values >> bits << bits | np.arange(len(values), dtype=np.uint64))
    places = (keyed & (np.uint64(1) << bits) - np.uint64(1)).astype(np.int64)
    again = np.flatnonzero(keyed[1:] >> bits == keyed[:-1] >> bits)
    if (values[places[again]] != values[places[again + 1]]).any():  # values that differ in those bits alone
        return np.sort(np.unique(values, return_index=True)[1])
    first = np.ones(len(values), bool)
    first[places[again + 1]] = False
    return np.flatnonzero(first)


def _majority(h, pairs, starts, sizes, ends):
    """SimHashes: the bits that over half of a line's word and pair hashes have."""
    import numpy as np

    # Eight one-byte counters are added at a time, over segments too short to overflow them.
    segments = -(-sizes // STRETCH)
    first = np.cumsum(segments) - segments
    begins = np.repeat(starts, segments) + STRETCH * (np.arange(segments.sum()) - np.repeat(first, segments))
    across = np.zeros(len(h), bool)
    across[ends] = True
    partial = []
    for k in range(0, len(begins), SEGMENTS):
        low, high = begins[k], begins[k + SEGMENTS] if k + SEGMENTS < len(begins) else len(h)
        bits, more = (np.unpackbits(x[low:high].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") for x in (h, pairs))
        more[across[low:high]] = 0
        bits += more
        partial.append(np.add.reduceat(bits.view("<u8"), begins[k:k + SEGMENTS] - low, axis=0).view(np.uint8))
    total = np.add.reduceat(np.concatenate(partial), first, axis=0, dtype=np.int32)
    prints = np.packbits(total * 2 > (2 * sizes - 1)[:, None], axis=1, bitorder="little").view("<i8").ravel()
    return prints & np.int64(0x7FFFFFFFFFFFFFFF)  # 63 bits: numpy counts the bits of a signed number's absolute value


def occurrences(docs: DataFrame, least_words: int = MIN_WORDS, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, rid, line, digest, fp and bands of every judged line; bands are null below ``min_words``. ``rid`` tells texts apart."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def emit(ids, rids, texts):
            number, words, digest, prints, keys = prints_of(b"\n".join(texts) + b"\n")
            offset = np.cumsum([0] + [t.count(b"\n") + 1 for t in texts])
            judged = words >= max(1, least_words)
            number, words, digest, prints, keys = (x[judged] for x in (number, words, digest, prints, keys))
            row = np.searchsorted(offset, number, side="right") - 1
            long = words >= min_words
            ends = np.r_[0, np.cumsum(long * (4 * BANDS))].astype(np.int32)
            bands = pa.Array.from_buffers(pa.binary(), len(long), [
                pa.py_buffer(np.packbits(long, bitorder="little")), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(keys[long]))])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(ids, np.int64)[row]), pa.array(np.array(rids, np.int64)[row]),
                 pa.array((number - offset[row]).astype(np.int32)), pa.array(digest), pa.array(prints), bands],
                names=["doc_id", "rid", "line", "digest", "fp", "bands"])

        for batch in batches:
            ids, rids, texts, held = [], [], [], 0
            for doc_id, rid, text in zip(*batch.columns):
                text = text.as_py()
                if not text:
                    continue
                ids.append(doc_id.as_py())
                rids.append(rid.as_py())
                texts.append(text.encode().lower())
                held += len(texts[-1])
                if held >= BYTES_AT_ONCE:
                    yield emit(ids, rids, texts)
                    ids, rids, texts, held = [], [], [], 0
            if texts:
                yield emit(ids, rids, texts)

    return docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), row_id(), "text").mapInArrow(
        run, "doc_id long, rid long, line int, digest long, fp long, bands binary")


def row_id():
    return F.xxhash64("text").alias("rid")


def edit_similar(a: str, b: str, similarity: float) -> bool:
    """Whether 1 - Levenshtein distance / longer length reaches ``similarity``."""
    limit = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
    if abs(len(a) - len(b)) > limit:
        return False
    if closely_worded(a, b, limit):
        return True
    i = len(os.path.commonprefix([a, b]))
    a, b = a[i:], b[i:]
    i = len(os.path.commonprefix([a[::-1], b[::-1]]))
    a, b = a[:len(a) - i], b[:len(b) - i]
    if max(len(a), len(b)) <= limit:
        return True
    if not a or not b:
        return False
    return distance(a, b, limit) <= limit


def distances(text: str, others: list[str]) -> list[int]:
    """Edit distances of ``text`` to each of the ``others``."""
    import numpy as np

    right = np.arange(1, len(others) + 1)
    both = Texts([text, *others])
    return both.distances(right * 0, right, both.sizes.max() + right * 0).tolist()


def similar_pairs(texts: Texts, left, right, similarity: float):
    """Whether pairs of ``texts`` (indices) are similar, all worked out side by side."""
    import numpy as np

    limits = texts.limits(left, right, similarity)
    similar = np.zeros(len(left), bool)
    asked = texts.possible(left, right, limits)
    # Their beginnings part most of the others. A walk over the words shows most of the similar pairs; of short ones a distance costs no more.
    asked = asked[texts.distances(left[asked], right[asked], limits[asked], BEGINNING) <= limits[asked]]
    long = asked[texts.sizes[left[asked]] > WALK]
    similar[long] = [closely_worded(texts.texts[i], texts.texts[j], k)
                     for i, j, k in zip(left[long].tolist(), right[long].tolist(), limits[long].tolist())]
    asked = asked[~similar[asked]]
    similar[asked] = texts.distances(left[asked], right[asked], limits[asked]) <= limits[asked]
    return similar


def near_trees(values, groups, radius):
    """For every member of a group of consecutive members: the one it was found near, and its root (indices).

    ``radius`` is a number, or one for each member that is the same all over a group.
    Each connected group within the radius gets a tree whose links are near pairs themselves. All
    groups are searched at once, one member of each a round; a group ends when all its members are found.
    """
    import numpy as np

    n = len(values)
    parent, root, state = np.arange(n), np.arange(n), np.zeros(n, np.int8)  # 0 not found, 1 waiting, 2 searched from
    rows, radius = np.arange(n), np.broadcast_to(radius, n)
    while len(rows):
        g = groups[rows]
        starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        sizes = np.diff(np.r_[starts, len(rows)])
        # Waiting members first, then the first that is not found yet, which is a root.
        turn = np.where(state[rows] == 1, 0, n) + np.arange(len(rows))
        seeds = rows[np.minimum.reduceat(turn, starts) % n]
        state[seeds] = 2
        seed = np.repeat(seeds, sizes)
        found = rows[(state[rows] == 0) & (np.bitwise_count(values[rows] ^ values[seed]) <= radius[rows])]
        by = seed[np.searchsorted(rows, found)]
        parent[found], root[found], state[found] = by, root[by], 1
        open_ = np.add.reduceat(state[rows] == 0, starts, dtype=np.int64)
        waiting = np.add.reduceat(state[rows] == 1, starts, dtype=np.int64)
        going = np.repeat((open_ > 1) | ((open_ == 1) & (waiting > 0)), sizes)
        rows = rows[going & (state[rows] < 2)]
    return parent, root


def of_kind(bucket, kind):
    """``bucket`` with its lowest bit set to ``kind``: 1 for the bands, 0 for the blocks."""
    return bucket.bitwiseAND(F.lit(-2)).bitwiseOR(kind)


def line_buckets(sure: int, blocks: int):
    """What gives the buckets of a batch (fp, bands) of lines, as (prints, buckets): all its blocks and bands."""
    masks = block_masks(sure, blocks)

    def buckets(batch):
        import numpy as np

        fp = batch.column(0).to_numpy().view(np.uint64)
        bands = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(-1, BANDS).astype(np.uint64)
        found = np.empty((len(masks) + BANDS, len(fp)), np.uint64)
        for k, mask in enumerate(masks):
            found[k] = mix(mix(fp & np.uint64(mask)) + np.uint64(k)) & ~np.uint64(1)
        for k in range(BANDS):
            found[len(masks) + k] = mix(mix(bands[:, k] | np.uint64(k << 32))) | np.uint64(1)
        return np.tile(fp.view(np.int64), len(found)), found.view(np.int64).ravel()

    return buckets


def bucket_groups(spread: DataFrame, radius: int, block_radius: int) -> DataFrame:
    """``line_groups`` in the buckets of ``spread`` (fp, bucket)."""
    return line_groups(spread.select("fp", "bucket"), lambda batch: [c.to_numpy() for c in batch.columns], 1, radius, block_radius)


def line_groups(rows: DataFrame, buckets_of, each: int, radius: int, block_radius: int) -> DataFrame:
    """unit, fp, near: members of the groups of two or more in every bucket; ``buckets_of`` gives those of a batch of ``rows``, ``each`` of a row.

    Links reach ``radius`` bits in buckets with an odd number, ``block_radius`` in the others.
    A unit is named by the print its groups were searched from, mostly the smallest of a family of lines, so the groups
    that a family forms in many buckets are one unit. Each other member was found ``near`` a member, at most ``radius`` bits off.
    Buckets travel many to a row: each belongs to a part, and the parts of the members that a task sees are cut and packed there.
    Buckets beyond ``CHUNK`` are cut, and every two chunks meet in a task.
    """
    import numpy as np

    width = shuffle_width(rows.sparkSession)
    form = "unit long, fp long, near long, large boolean"
    parts = max(4 * width, -(-rows.count() * each // PART))

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def packed(held):
            values, buckets = (np.concatenate(x) for x in zip(*held))
            part = ((mix(buckets.view(np.uint64)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(
                np.uint16 if parts <= 1 << 16 else np.int64)
            order = np.argsort(part, kind="stable")
            part, pairs = part[order], np.stack([buckets[order], values[order]], axis=1)
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            sizes = np.diff(np.r_[cuts, len(part)])
            pieces = -(-sizes // PACKED)
            begin = np.repeat(cuts, pieces) + PACKED * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
            # Rows of a batch stay few enough for 32-bit offsets.
            for k in range(0, len(begin), 1 << 12):
                ends = begin[k:k + (1 << 12) + 1] if k + (1 << 12) < len(begin) else np.r_[begin[k:], len(part)]
                yield pa.RecordBatch.from_arrays([pa.array(part[ends[:-1]].astype(np.int32)), pa.Array.from_buffers(
                    pa.binary(), len(ends) - 1, [None, pa.py_buffer((16 * (ends - ends[0])).astype(np.int32)),
                                                 pa.py_buffer(pairs[ends[0]:ends[-1]])])], names=["part", "pairs"])

        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(buckets_of(batch))
                size += len(held[-1][0])
            if size >= PACK:
                yield from packed(held)
                held, size = [], 0
        if held:
            yield from packed(held)

    def close(values, groups):
        import pyarrow as pa

        parent, root = near_trees(values, groups, np.where(groups & 1, np.uint8(radius), np.uint8(block_radius)))
        together = np.zeros(len(values), bool)
        together[root[root != np.arange(len(values))]] = True
        together |= root != np.arange(len(values))
        return pa.RecordBatch.from_arrays(
            [pa.array(values[root][together]), pa.array(values[together]), pa.array(values[parent][together]), pa.array(np.zeros(together.sum(), bool))],
            names=["unit", "fp", "near", "large"])

    def hand_on(values, groups):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays(
            [pa.array(groups), pa.array(values), pa.array(values), pa.array(np.ones(len(values), bool))], names=["unit", "fp", "near", "large"])

    def merged(held, spared=None):
        """Different members by bucket, and how many their bucket has; with ``spared``, single ones of other buckets go."""
        pairs = np.concatenate(held)
        pairs = pairs[np.argsort(pairs[:, 0])]
        if spared is not None:
            same = pairs[1:, 0] == pairs[:-1, 0]
            pairs = pairs[np.r_[same, False] | np.r_[False, same] | np.isin(pairs[:, 0], spared)]
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        pairs = pairs[np.r_[True, (pairs[1:] != pairs[:-1]).any(axis=1)][:len(pairs)]]
        starts = np.flatnonzero(np.r_[True, pairs[1:, 0] != pairs[:-1, 0]][:len(pairs)])
        sizes = np.diff(np.r_[starts, len(pairs)])
        return pairs, np.repeat(sizes, sizes)

    def meet(batches: Iterator) -> Iterator:
        def end(held, long):
            pairs, size = merged(held, long)
            many = (size > CHUNK) | np.isin(pairs[:, 0], long)
            few = (size > 1) & ~many
            if few.any():
                yield close(pairs[few, 1], pairs[few, 0])
            if many.any():
                yield hand_on(pairs[many, 1], pairs[many, 0])

        current, held, size, most, long = None, [], 0, PART_MOST, np.zeros(0, np.int64)
        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != current:
                    if held:
                        yield from end(held, long)
                    current, held, size, most, long = part, [], 0, PART_MOST, long[:0]
                held.append(np.frombuffer(block, "<i8").reshape(-1, 2))
                size += len(held[-1])
                if size >= most:  # crowded buckets leave before the part has come to its end
                    pairs, crowd = merged(held)
                    long = np.union1d(long, pairs[crowd > CHUNK, 0])
                    leaving = np.isin(pairs[:, 0], long)
                    yield hand_on(pairs[leaving, 1], pairs[leaving, 0])
                    held = [pairs[~leaving]]
                    size = len(held[0])
                    most = max(PART_MOST, 2 * size)
        if held:
            yield from end(held, long)

    def compare(batches: Iterator) -> Iterator:
        for values, groups, _ in runs(batches, limit=None):
            yield close(values, groups)

    met = settle(rows.mapInArrow(pack, "part int, pairs binary").repartition(width, "part").sortWithinPartitions("part").mapInArrow(
        meet, form), "met")
    large = met.filter("large").select("fp", F.col("unit").alias("bucket")).distinct()
    rest = chunk_pairs(large, "bucket", "fp", CHUNK).select(
        "fp", of_kind(F.col("unit"), F.col("bucket").bitwiseAND(F.lit(1))).alias("unit")).repartition(width, "unit").sortWithinPartitions(
        "unit", "fp").mapInArrow(compare, form)
    return met.filter("not large").union(rest).drop("large")


def chunk_pairs(members: DataFrame, group: str, member: str, chunk: int) -> DataFrame:
    """``members`` with ``unit``: each group larger than ``chunk`` is cut, and every two chunks of it meet in a unit."""
    counts = members.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.ceil(F.col("_n") / chunk).cast("int")
    own = F.pmod(F.hash(member), parts)
    units = F.when(parts == 1, F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))).otherwise(F.transform(
        F.filter(F.sequence(F.lit(0), parts - 1), lambda c: c != own),
        lambda c: F.struct(F.least(c, own).alias("x"), F.greatest(c, own).alias("y"))))
    return members.join(counts, group).select(*members.columns, F.explode(units).alias("_u")).select(
        *members.columns, F.xxhash64(group, "_u.x", "_u.y").alias("unit"))


def closely_worded(a: str, b: str, limit: int) -> bool:
    """Whether an edit script of whole words, found in one walk over both, needs at most ``limit`` edits."""
    x, y, i, j, cost = a.split(" "), b.split(" "), 0, 0, 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            i, j = i + 1, j + 1
            continue
        if i + 1 < len(x) and x[i + 1] == y[j]:
            cost, i = cost + len(x[i]) + 1, i + 1
        elif j + 1 < len(y) and x[i] == y[j + 1]:
            cost, j = cost + len(y[j]) + 1, j + 1
        else:
            cost, i, j = cost + max(len(x[i]), len(y[j])), i + 1, j + 1
        if cost > limit:
            return False
    return cost + sum(len(w) + 1 for w in x[i:]) + sum(len(w) + 1 for w in y[j:]) <= limit


def verified(prints, texts: list[str], labels: list[int], radius: int, similarity: float) -> list[tuple[int, int]]:
    """Spanning links among members of a unit; members already connected, as equal labels are, are not compared again."""
    import numpy as np

    return verified_units(np.zeros(len(texts), np.int64), np.asarray(prints), texts, labels, radius, similarity)


def verified_units(units, prints, texts: list[str], labels, radius: int, similarity: float) -> list[tuple[int, int]]:
    """``verified`` for the members of several units, which come unit by unit, all side by side."""
    import numpy as np

    n, held = len(texts), Texts(texts)
    begin = np.searchsorted(units, units)
    first: dict[tuple[int, int], int] = {}
    root = np.array([first.setdefault(x, i) for i, x in enumerate(zip(begin.tolist(), labels))])
    earlier = np.arange(n) - begin  # members of the unit before
    total, links, low = np.cumsum(np.r_[0, earlier]), [], 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(total, total[low] + PAIRS, side="right")) - 1)
        i = np.repeat(np.arange(low, high), earlier[low:high])
        j = begin[i] + np.arange(len(i)) - (total[i] - total[low])
        low = high
        off = np.bitwise_count(prints[i] ^ prints[j])
        near = np.flatnonzero((root[i] != root[j]) & (off <= radius))
        i, j, off, tried = i[near], j[near], off[near], 0
        near = held.possible(i, j, held.limits(i, j, similarity))
        i, j, off = i[near], j[near], off[near]
        while len(i):
            # The nearest pair of each later group; after some rounds, more and more of a group at once.
            order = np.lexsort((off, root[i]))
            i, j, off = i[order], j[order], off[order]
            asked = np.r_[True, root[i][1:] != root[i][:-1]]
            if tried >= ALONE:
                starts, before = np.flatnonzero(asked), np.cumsum(held.sizes[j]) - held.sizes[j]
                before -= np.repeat(before[starts], np.diff(np.r_[starts, len(i)]))
                asked |= before + held.sizes[j] <= AT_ONCE << min(2 * (tried - ALONE), 40)
            tried += 1
            similar = similar_pairs(held, i[asked], j[asked], similarity)
            for x, y in zip(i[asked][similar].tolist(), j[asked][similar].tolist()):
                up, down = x, y
                while root[up] != up:
                    up = root[up]
                while root[down] != down:
                    down = root[down]
                if up != down:
                    links.append((x, y))
                    root[max(up, down)] = min(up, down)
            while (root[root] != root).any():
                root = root[root]
            left = ~asked & (root[i] != root[j])
            i, j, off = i[left], j[left], off[left]
    return links


def line_texts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` (doc_id, rid, line) as digest, fp, text: each line fetched from its document, once.

    Only line numbers travel to the documents; digests and prints are worked out again there.
    """
    per_doc = settle(asked.groupBy("doc_id", "rid").agg(F.collect_list("line").alias("asked")), "per-doc")

    def fetch(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found: list[bytes] = []
            for text, numbers in zip(*batch.columns):
                parts = text.as_py().encode().lower().split(b"\n")
                found += [b" ".join(parts[k].split()) for k in numbers.as_py()]
            if found:
                _, _, digest, prints, _ = prints_of(b"\n".join(found) + b"\n", bands=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest), pa.array(prints), pa.array([x.decode() for x in found])], names=["digest", "fp", "text"])

    texts = join_checked(docs.select(F.col("doc_id").cast("long"), row_id(), "text"), per_doc, ["doc_id", "rid"], "inner",
                         "32 + 4 * cast(size(asked) as bigint)")
    # Rows that repeat doc_id and text answer alike.
    return texts.select("text", "asked").mapInArrow(fetch, "digest long, fp long, text string")


def _check_pairs(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those ``pairs`` (a, b: prints) whose first lines, in ``texts`` (fp, text), are similar."""
    def check(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def close(batches):
            found = pa.Table.from_batches(batches).combine_chunks()
            texts = found.column(2).to_pylist() + found.column(3).to_pylist()
            left = np.arange(found.num_rows)
            held = similar_pairs(Texts(texts), left, left + found.num_rows, similarity)
            return found.select([0, 1]).filter(pa.array(held)).to_batches()

        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.nbytes
            if size >= TEXT_BYTES:
                yield from close(waiting)
                waiting, size = [], 0
        if waiting:
            yield from close(waiting)

    left = texts.select(F.col("fp").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("fp").alias("b"), F.col("text").alias("tb"))
    return settle(pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long"), "held")


def _apart(links: DataFrame, labels: DataFrame) -> DataFrame:
    """``links`` (a, b, ...) whose ends have different labels; a print without a row in ``labels`` is its own."""
    la, lb = (labels.select(F.col("node").alias(e), F.col("component").alias(f"l{e}")) for e in "ab")
    return links.join(la, "a", "left").join(lb, "b", "left").filter(
        F.coalesce("la", "a") != F.coalesce("lb", "b")).drop("la", "lb")


def _ask_again(members: DataFrame, texts: DataFrame, labelled: DataFrame, radius: int, similarity: float) -> DataFrame:
    """Links (a, b: digests) among the members (unit, fp) of units, by texts (digest, text) and their labels (digest, fp, label)."""
    held = settle(members.join(labelled, "fp").select("unit", "digest", "label"), "held-members")
    split = held.groupBy("unit").agg(
        (F.min("label") < F.max("label")).alias("apart"), F.bit_xor(F.xxhash64("digest")).alias("x"), F.count(F.lit(1)).alias("n"))
    # Units with the same members are asked once.
    units = settle(split.filter("apart").groupBy("x", "n").agg(F.min("unit").alias("unit")).select("unit"), "units")
    named = settle(join_checked(held, units, "unit", "left_semi", 16).select(F.col("unit").alias("place"), "digest"), "open-members")
    placed = chunk_pairs(named, "place", "digest", CHUNK).select("unit", "digest").join(
        labelled, "digest").join(texts, "digest")

    def verify(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def close(members):
            units, digests, prints, texts, labels = zip(*members)
            places = np.cumsum([0, *(x != y for x, y in zip(units, units[1:]))])
            links = verified_units(places, np.array(prints), list(texts), labels, radius, similarity)
            return pa.RecordBatch.from_arrays(
                [pa.array([digests[i] for i, _ in links], pa.int64()), pa.array([digests[j] for _, j in links], pa.int64())],
                names=["a", "b"])

        # Units are verified many at a time; one that goes on stays whole.
        members, size = [], 0
        for batch in batches:
            for member in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= TEXT_BYTES and member[0] != members[-1][0]:
                    yield close(members)
                    members, size = [], 0
                members.append(member)
                size += len(member[3])
        if members:
            yield close(members)

    width = shuffle_width(texts.sparkSession)
    return placed.select("unit", "digest", "fp", "text", "label").repartition(width, "unit").sortWithinPartitions(
        "unit", "digest").mapInArrow(verify, "a long, b long")


def removals(
    docs: DataFrame, min_words: int = MIN_WORDS, radius: int = RADIUS, blocks: int = BLOCKS, similarity: float = SIMILARITY,
    least_words: int = MIN_WORDS,
) -> DataFrame:
    """doc_id, rid, removed: the line numbers (from 0) that go, for documents that lose any."""
    lines = settle(occurrences(docs, least_words, min_words), "lines")
    distinct = settle(lines.groupBy("digest").agg(
        F.min(F.struct("doc_id", "line", "rid")).alias("first"), F.first("fp").alias("fp"), F.first("bands").alias("bands"),
        F.count(F.lit(1)).alias("n")), "distinct")
    fuzzy = distinct.filter(F.col("bands").isNotNull())
    # A print stands for the line with its smallest digest; lines that share one are asked again below.
    prints = settle(fuzzy.groupBy("fp").agg(F.count(F.lit(1)).alias("sharers"), F.min("digest").alias("lead")), "prints")
    sure = radius if radius < blocks else min(SURE, blocks - 1)
    members = settle(line_groups(
        fuzzy.select("fp", "bands"), line_buckets(sure, blocks), len(block_masks(sure, blocks)) + BANDS, radius,
        min(radius, max(sure, BLOCK_RADIUS))), "members")
    found = members.filter("fp <> near").select("unit", F.col("fp").alias("a"), F.col("near").alias("b"))
    # One link of each print, the nearest, is verified by itself.
    off = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    parents = settle(found.groupBy("a").agg(F.min(F.struct(off, "b"))["b"].alias("b")), "parents")

    linked = parents.select(F.col("a").alias("fp")).union(parents.select("b")).distinct().withColumn("linked", F.lit(True))
    wanted = settle(prints.join(linked, "fp", "left").filter("linked OR sharers > 1").select("fp", "sharers", "lead"), "wanted")
    asked = join_checked(fuzzy.select("digest", "fp", "first"), wanted.select("fp"), "fp", "inner", 16)
    texts = settle(line_texts(docs, asked.select("first.*")).dropDuplicates(["digest"]).join(
        wanted.select(F.col("lead").alias("digest"), F.lit(True).alias("is_lead")), "digest", "left").select(
        "digest", "fp", "text", F.coalesce("is_lead", F.lit(False)).alias("lead")), "texts")
    leads = texts.filter("lead").select("fp", "text")
    held = _check_pairs(parents, leads, similarity)
    labels = settle(connected_components(held), "labels")

    # Asked again: units with a link whose ends are still apart, and those with a print that several lines share.
    shared = settle(wanted.filter("sharers > 1").select("fp"), "shared")
    open_units = settle(_apart(found, labels).select("unit").union(
        join_checked(members, shared, "fp", "left_semi", 16).select("unit")).distinct(), "open-units")
    again = join_checked(members.select("unit", "fp"), open_units, "unit", "left_semi", 16).union(
        shared.select(F.col("fp").alias("unit"), "fp")).distinct()
    digest_of = wanted.select(F.col("fp"), "lead")
    checked = held.join(digest_of.toDF("a", "da"), "a").join(digest_of.toDF("b", "db"), "b").select(
        F.col("da").alias("a"), F.col("db").alias("b"))
    labelled = settle(texts.join(labels, texts.fp == labels.node, "left").select(
        "digest", "fp", F.when(F.col("lead"), F.coalesce("component", "fp")).otherwise(F.col("digest")).alias("label")), "labelled")
    links = checked.union(_ask_again(again, texts.select("digest", "text"), labelled, radius, similarity))
    groups = connected_components(links)

    grouped = settle(distinct.join(groups, distinct.digest == groups.node, "left").select(
        "digest", F.coalesce("component", "digest").alias("grp"), "first", "n"), "grouped")
    keep = grouped.groupBy("grp").agg(F.min("first").alias("keep"), F.sum("n").alias("total")).filter("total > 1")
    decided = settle(grouped.join(keep, "grp").select("digest", "keep"), "decided")
    gone = join_checked(lines, decided, "digest", "inner", 48).filter(F.struct("doc_id", "line", "rid") != F.col("keep"))
    return gone.groupBy("doc_id", "rid").agg(F.array_sort(F.collect_set("line")).alias("removed"))


def drop_lines(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` with removed lines cut from ``text``: doc_id, row (all columns), n_lines, n_removed, kept.

    ``row`` holds the input columns, so extra columns cannot clash. ``kept`` is the new text.
    """
    gone = settle(gone, "gone")
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_id(), F.struct("*").alias("row"))
    text = F.col("row.text")
    n = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    rest = F.array_except(F.sequence(F.lit(0), n - 1), F.col("removed"))
    # The lines are the one element of an array, so that they are cut once and not again for each line that stays.
    kept = F.transform(F.array(F.split(text, "\n", -1)), lambda lines: F.array_join(F.transform(rest, lambda i: F.get(lines, i)), "\n"))
    joined = join_checked(packed, gone, ["doc_id", "rid"], "left", "32 + 4 * cast(size(removed) as bigint)")
    return joined.select(
        "doc_id", "row",
        F.when(F.col("row.text").isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
        F.when(F.col("removed").isNull(), 0).otherwise(F.size("removed")).cast("long").alias("n_removed"),
        F.when(F.col("removed").isNull(), text).otherwise(F.get(kept, F.lit(0))).alias("kept"),
    )

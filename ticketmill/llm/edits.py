"""Edit distances of many pairs of texts at once.

Myers' bit-parallel columns (1999, in blocks of 64 as Hyyrö has them) run as arrays: one array
operation moves all blocks of all pairs of a batch by a column. Letter counts come first, which bound
the distance from below: an edit moves at most two of them. Pairs that can no longer end within
their limit are abandoned.
"""

from __future__ import annotations

LETTER_BINS = 64
SLICE = 1 << 17  # characters that are counted at once
BLOCKS = 4096  # that move at once
SYMBOLS = 150  # beyond that many different code points, each pair numbers its own
EVERY = 16  # columns from one look for ended and hopeless pairs to the next
SETUP, STEP = 60.0, 0.015  # microseconds of a column: fixed, and for each block
ALONE_STEP, ALONE_BLOCK = 2.0, 0.06  # of a column of one pair by itself: fixed, and for each block


def code_points(texts: list[str]):
    import numpy as np

    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


class Texts:
    """Texts, and how often code points of each of ``LETTER_BINS`` classes stand in each."""

    def __init__(self, texts: list[str]):
        import numpy as np

        self.texts, self.sizes = texts, np.array([len(x) for x in texts], np.int64)
        self.letters = np.empty((len(texts), LETTER_BINS), np.int32)
        total, low = np.cumsum(np.r_[0, self.sizes]), 0
        while low < len(texts):
            high = max(low + 1, int(np.searchsorted(total, total[low] + SLICE, side="right")) - 1)
            owner = np.repeat(np.arange(high - low) * LETTER_BINS, self.sizes[low:high])
            self.letters[low:high] = np.bincount(
                owner + code_points(texts[low:high]) % LETTER_BINS, minlength=(high - low) * LETTER_BINS).reshape(-1, LETTER_BINS)
            low = high

    def limits(self, left, right, similarity: float):
        """The most edits of pairs that are still similar."""
        import numpy as np

        return ((1 - similarity) * np.maximum(self.sizes[left], self.sizes[right]) + 1e-9).astype(np.int64)

    def possible(self, left, right, limits):
        """Indices of the pairs whose sizes and counts do not need more edits than their limit."""
        import numpy as np

        keep = np.flatnonzero(np.abs(self.sizes[left] - self.sizes[right]) <= limits)
        few = (1 << 18) // LETTER_BINS
        return np.concatenate([k[np.abs(self.letters[left[k]] - self.letters[right[k]]).sum(axis=1) <= 2 * limits[k]]
                               for k in (keep[x:x + few] for x in range(0, len(keep), few))] or [keep])

    def distances(self, left, right, limits, share: float = 1.0):
        """Edit distances of pairs (indices); where one exceeds its limit, some number above the limit.

        With a ``share`` of the longer text, the beginnings up to the same diagonal are compared, which no distance is below.
        """
        import numpy as np

        swap = self.sizes[left] > self.sizes[right]
        left, right = np.where(swap, right, left), np.where(swap, left, right)
        found = np.empty(len(left), np.int64)
        columns = np.ceil(share * self.sizes[right]).astype(np.int64)
        rows = np.maximum(columns - self.sizes[right] + self.sizes[left], 0)
        blocks = -(-rows // 64)
        order = np.argsort(-columns, kind="stable")
        order = order[blocks[order] > 0]
        found[blocks == 0] = columns[blocks == 0]
        total = np.cumsum(np.r_[0, blocks[order]])
        at = 0
        while at < len(order):
            n = int(columns[order[at]])
            end = max(at + 1, int(np.searchsorted(total, total[at] + BLOCKS, side="right")) - 1)
            end = min(end, at + int(np.searchsorted(-columns[order[at:]], -n // 2, side="right")))
            end = max(at + 1, end)
            batch = order[at:end]
            held = total[end] - total[at]
            if (n + blocks[batch[0]]) * (SETUP + STEP * held) > (columns[batch] * (ALONE_STEP + ALONE_BLOCK * blocks[batch])).sum():
                for k in batch.tolist():
                    found[k] = distance(self.texts[left[k]][:rows[k]], self.texts[right[k]][:columns[k]], int(limits[k]))
            else:
                found[batch] = self._batch(left[batch], right[batch], rows[batch], columns[batch], limits[batch], blocks[batch])
            at = end
        return found

    def _batch(self, left, right, m, n, limits, blocks):
        """Distances of the first ``m`` and ``n`` code points of pairs, m the less. All blocks of all pairs move at once: block k
        of a pair works on its column t - k at time t, so that it gets what block k - 1 carried over from that column."""
        import numpy as np

        lanes = len(left)
        down, across = (code_points([self.texts[k][:x] for k, x in zip(which.tolist(), size.tolist())])
                        for which, size in ((left, m), (right, n)))
        owner_down, row = _places(m)
        owner, place = _places(n)
        points = np.concatenate([down, across])
        held = np.zeros(int(points.max()) + 1, bool)
        held[points] = True
        number = (np.cumsum(held) - 1)[points]
        if held.sum() > SYMBOLS:
            own = np.concatenate([owner_down, owner]) << 32 | number
            held, number = np.unique(own, return_inverse=True)
            number -= np.searchsorted(held >> 32, np.arange(lanes))[np.concatenate([owner_down, owner])]
        width = int(number.max()) + 2  # the last one stands for no column: nothing is equal to it
        down, across = number[:len(down)], number[len(down):]
        # Texts of columns one after the other, with room for as many others as there are blocks around each.
        room = n + 2 * blocks
        begin = np.cumsum(room) - room + blocks
        text = np.full(int(room.sum()) + 1, width - 1)
        text[begin[owner] + place] = across
        first = np.cumsum(blocks) - blocks
        lane = np.repeat(np.arange(lanes), blocks)
        at = begin[lane] - (np.arange(len(lane)) - first[lane])
        where = np.zeros(len(lane) * width, np.uint64)
        np.add.at(where, (first[owner_down] + (row >> 6)) * width + down, np.uint64(1) << (row & 63).astype(np.uint64))
        return _columns(where, width, text, at, first, blocks, m, n, limits)


def _places(sizes):
    """The text that each code point belongs to, and its place there."""
    import numpy as np

    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]


def _columns(where, width: int, text, at, first, blocks, m, n, limits):
    import numpy as np

    one, top = np.uint64(1), np.uint64(63)
    found = limits + 1
    lane = np.arange(len(m))
    # The diagonal that ends in the distance never falls: D[j + m - n, j], from D[0, n - m] = n - m on.
    score, column, t = n - m, n - m, 0
    base = np.arange(len(at)) * width
    up, low = np.full(len(at), ~np.uint64(0)), np.zeros(len(at), np.uint64)
    more, less = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    e, a, b, c = (np.empty(len(at), np.uint64) for _ in range(4))
    place = np.empty(len(at), np.int64)
    while len(lane):
        np.add(at, t, out=place)
        np.take(text, place, out=place, mode="clip")
        np.add(place, base, out=place)
        np.take(where, place, out=e, mode="clip")
        more[first], less[first] = 1, 0  # the row above the first grows by one a column
        np.bitwise_or(e, low, out=a)  # vertical
        np.bitwise_or(e, less, out=e)
        np.bitwise_and(e, up, out=b)
        np.add(b, up, out=b)
        np.bitwise_xor(b, up, out=b)
        np.bitwise_or(b, e, out=b)  # horizontal
        row = column - n + m
        block = row >> 6
        due = (column + block == t) & (column < n)
        bit = ((b | low)[first + np.minimum(block, blocks - 1)] >> (row & 63).astype(np.uint64)) & one
        score = score + (due & (bit == 0))
        column = column + due
        np.bitwise_or(b, up, out=c)
        np.invert(c, out=c)
        np.bitwise_or(c, low, out=c)  # one more than to the left
        np.bitwise_and(b, up, out=b)  # one less
        np.bitwise_and(np.left_shift(c, one, out=e), ~one, out=e)
        np.bitwise_or(e, more, out=e)
        np.right_shift(c[:-1], top, out=more[1:])
        np.left_shift(b, one, out=c)
        np.bitwise_or(c, less, out=c)
        np.right_shift(b[:-1], top, out=less[1:])
        np.bitwise_and(e, a, out=low)
        np.bitwise_or(a, e, out=a)
        np.invert(a, out=a)
        np.bitwise_or(a, c, out=up)
        t += 1
        if t % EVERY == 0 or (column >= n).all():
            open_ = (column < n) & (score <= limits)
            if not open_.any() or open_.sum() < 0.85 * len(lane) or (column >= n).all():
                found[lane[~open_]] = score[~open_]
                kept = np.repeat(open_, blocks)
                lane, score, column, m, n, limits, blocks = (v[open_] for v in (lane, score, column, m, n, limits, blocks))
                first = np.cumsum(blocks) - blocks
                at, base, up, low, more, less = (v[kept] for v in (at, base, up, low, more, less))
                e, a, b, c, place = (v[:len(at)] for v in (e, a, b, c, place))
    return found


def distance(a: str, b: str, limit: int) -> int:
    """Edit distance of one pair by integers as wide as ``a``, or a number above ``limit``."""
    if not a or not b:
        return max(len(a), len(b))
    ones, high = (1 << len(a)) - 1, 1 << len(a) - 1
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    up, down, found, least, ahead = ones, 0, len(a), abs(len(a) - len(b)), len(a) - len(b) - 1
    for left, c in enumerate(b, 1):
        eq = where.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right_up, right_down = down | ~(diagonal | up) & ones, up & diagonal
        if right_up & high:
            found += 1
        elif right_down & high:
            found -= 1
        # The diagonal that ends in the distance never falls.
        if ahead + left >= 0 and not diagonal >> ahead + left & 1:
            least += 1
            if least > limit and ahead < 0:
                return limit + 1
        right_up, right_down = (right_up << 1 | 1) & ones, right_down << 1 & ones
        up, down = right_down | ~(diagonal | right_up) & ones, right_up & diagonal
    return found

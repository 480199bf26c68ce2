"""Nearest rows between matrices in memory, by small boxes whose distance bounds that of their rows.

Only pairs of boxes that may hold a wanted pair are multiplied out, in single precision with a bound on its
rounding; what passes is measured again in full, so results are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BOX_ROWS = 64
STEP_COLUMNS = 4096  # rows that a box is held against at a time
LAST = np.iinfo(np.int64).max
NOWHERE = 1e30  # squared distance of what only fills a box up


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A column of equal-length arrays as a matrix, without an object for each row."""
    widths = pc.unique(pc.list_value_length(column))
    if len(widths) > 1 or widths.null_count:
        raise ValueError(f"vectors of different widths: {widths.to_pylist()[:5]}")
    if not len(column):
        return np.empty((0, 0))
    parts = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks if len(c)]
    return (parts[0] if len(parts) == 1 else np.concatenate(parts)).reshape(len(column), -1)


def frame_of(*parts: np.ndarray) -> tuple[np.ndarray, float]:
    """A middle and a unit of length that keep the rows of all ``parts`` in the range of single precision."""
    low, high = np.min([x.min(0) for x in parts], axis=0), np.max([x.max(0) for x in parts], axis=0)
    return low / 2 + high / 2, float((high / 2 - low / 2).max()) or 1.0


class Boxes:
    """The rows of ``x`` halved along their widest column until a box has ``BOX_ROWS`` at most."""

    def __init__(self, x: np.ndarray, frame: tuple[np.ndarray, float]):
        todo, found = [np.arange(len(x))], []
        while todo:
            rows = todo.pop()
            if len(rows) <= BOX_ROWS:
                found.append(np.sort(rows))
                continue
            v = x[rows]
            at = np.argpartition(v[:, v.var(0).argmax()], len(rows) // 2)
            todo += [rows[at[len(rows) // 2:]], rows[at[:len(rows) // 2]]]
        self.x, self.sizes = x, np.array([len(rows) for rows in found])
        self.rows = np.array([np.r_[rows, np.full(self.sizes.max() - len(rows), rows[0])] for rows in found])
        self.filled = np.arange(self.rows.shape[1]) < self.sizes[:, None]
        held = x[self.rows]
        self.low, self.high = held.min(1), held.max(1)
        middle, self.unit = frame
        held -= middle
        held /= self.unit
        self.norm = np.einsum("brd,brd->br", held, held)
        self.radius = float(np.sqrt(self.norm.max()))
        # [-2y, 1, |y|^2] times [x, |x|^2, 1] is the squared distance, in units.
        self.right = np.ones((*self.rows.shape, x.shape[1] + 2), np.float32)
        self.right[:, :, :-2] = -2 * held
        self.right[:, :, -1] = np.where(self.filled, self.norm, NOWHERE)

    def left(self, box: int, less: np.ndarray | float = 0.0) -> np.ndarray:
        """[x, |x|^2 - less, 1] of the rows of one box."""
        n, d = self.sizes[box], self.low.shape[1]
        out = np.ones((n, d + 2), np.float32)
        out[:, :d] = self.right[box, :n, :d] / -2
        out[:, d] = self.norm[box, :n] - less
        return out

    def gaps(self, box: int, other: Boxes) -> np.ndarray:
        """What the rows of every box of ``other`` are at least away from those of one box."""
        gap = np.maximum(np.maximum(other.low - self.high[box], self.low[box] - other.high), 0.0)
        return np.maximum(np.sqrt((gap * gap).sum(1)) - 1e-9 * self.unit * (self.radius + other.radius), 0.0)

    def slack(self, other: Boxes) -> float:
        """A bound on what single precision can do to a squared distance, in units."""
        return (self.low.shape[1] + 8) * 2.0 ** -22 * (self.radius + other.radius) ** 2


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row; the same whichever side comes first."""
    gap = x - y
    return np.sqrt((gap * gap).sum(1))


def improve(a: Boxes, dist: np.ndarray, near: np.ndarray, b: Boxes, ids: np.ndarray) -> None:
    """Put the rows of ``b`` that belong there into the lists ``dist`` and ``near`` of the rows of ``a``, in place.

    A list is sorted by distance, then id. Until k rows are found it is filled with a bound, id ``LAST``.
    """
    k, slack, far_off = dist.shape[1], a.slack(b), 4 * (a.radius + b.radius) ** 2 + 1.0
    for box in range(len(a.rows)):
        mine = a.rows[box, :a.sizes[box]]
        d, i = dist[mine], near[mine]
        least = a.gaps(box, b)
        todo = np.flatnonzero(least <= d[:, -1].max())
        todo = todo[np.argsort(least[todo], kind="stable")]
        at, width = 0, -(-4 * k // b.rows.shape[1]) + 1
        while at < len(todo):
            some = todo[at:at + width]
            some = some[least[some] <= d[:, -1].max()]
            if not len(some):
                break
            right, rows = b.right[some].reshape(-1, b.right.shape[2]), b.rows[some].ravel()
            bound = d[:, -1]
            if at == 0 and np.isinf(bound).any() and b.sizes[some].sum() >= k:
                # k rows at hand bound the lists, so only what is nearer is measured in full.
                pick = np.argpartition(a.left(box) @ right.T, k - 1, axis=1)[:, :k]
                away = distances(np.repeat(a.x[mine], k, axis=0), b.x[rows[pick.ravel()]]).reshape(pick.shape)
                bound = np.minimum(bound, away.max(1))
            limit = np.minimum((bound / a.unit) ** 2 * (1 + 1e-6) + slack, far_off)
            row, col = np.divmod(np.flatnonzero(a.left(box, limit) @ right.T <= 0), len(rows))
            if len(row):
                hit = rows[col]
                away = distances(a.x[mine[row]], b.x[hit])
                keep = away <= bound[row]
                row, hit, away = row[keep], hit[keep], away[keep]
            if len(row):
                touched, lot = np.unique(row, return_inverse=True)
                owner = np.r_[np.repeat(np.arange(len(touched)), k), lot]
                far, who = np.r_[d[touched].ravel(), away], np.r_[i[touched].ravel(), ids[hit]]
                best = np.lexsort((who, far, owner))
                starts = np.searchsorted(owner[best], np.arange(len(touched)))
                best = best[starts[:, None] + np.arange(k)]
                d[touched], i[touched] = far[best], who[best]
            at, width = at + width, min(2 * width, max(1, STEP_COLUMNS // b.rows.shape[1]))
        dist[mine], near[mine] = d, i


class Lightest:
    """For each tree (by code) its lightest edge to another one so far: w, x, y with x below y, and the other tree.

    It starts from ``bound``, the weight of an edge that is known already (y is -1), which wins a tie; else the lower x, then y wins.
    """

    def __init__(self, bound: np.ndarray):
        self.w, self.other = bound.copy(), np.full(len(bound), -1)
        self.x, self.y = np.full(len(bound), -1), np.full(len(bound), -1)

    def offer(self, tree: np.ndarray, other: np.ndarray, w: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        order = np.lexsort((y, x, w, tree))
        order = order[np.r_[True, tree[order][1:] != tree[order][:-1]]]
        tree, other, w, x, y = (c[order] for c in (tree, other, w, x, y))
        better = (w < self.w[tree]) | ((w == self.w[tree]) & ((x < self.x[tree]) | ((x == self.x[tree]) & (y < self.y[tree]))))
        t = tree[better]
        self.w[t], self.x[t], self.y[t], self.other[t] = w[better], x[better], y[better], other[better]


@dataclass
class Rows:
    """What goes with the rows of a ``Boxes``: id, core distance, reach (no edge out of a row's tree, but known ones, is lighter), tree code."""

    ids: np.ndarray
    core: np.ndarray
    reach: np.ndarray
    tree: np.ndarray


def reach_out(a: Boxes, mine: Rows, b: Boxes, theirs: Rows, best: Lightest) -> None:
    """Offer ``best`` the lightest edges from rows of ``a`` to rows of ``b`` in other trees; an edge weighs its length or a core distance."""
    slack, far_off = a.slack(b), 4 * (a.radius + b.radius) ** 2 + 1.0
    trees = theirs.tree[b.rows]
    alone = np.where((trees == trees[:, :1]).all(1), trees[:, 0], -1)  # the tree of a box that holds no other
    floor = theirs.core[b.rows].min(1)
    for box in range(len(a.rows)):
        rows = a.rows[box, :a.sizes[box]]
        tree, reach = mine.tree[rows], mine.reach[rows]

        def limits() -> np.ndarray:
            return np.where(reach < best.w[tree], best.w[tree], -1.0)

        limit = limits()
        if limit.max() < 0:
            continue
        least = np.maximum(a.gaps(box, b), floor)
        todo = np.flatnonzero((least <= limit.max()) & ((alone < 0) | (alone != tree[0]) | (tree != tree[0]).any()))
        todo = todo[np.argsort(least[todo], kind="stable")]
        at, width = 0, 4
        while at < len(todo):
            limit = limits()
            some = todo[at:at + width]
            some = some[least[some] <= limit.max()]
            if not len(some):
                break
            right, held = b.right[some].reshape(-1, b.right.shape[2]), b.rows[some].ravel()
            less = np.where(limit < 0, -NOWHERE, np.minimum((np.maximum(limit, 0) / a.unit) ** 2 * (1 + 1e-6) + slack, far_off))
            near = (a.left(box, less) @ right.T <= 0) & (tree[:, None] != trees[some].ravel()[None])
            row, col = np.divmod(np.flatnonzero(near), len(held))
            if len(row):
                i, j = rows[row], held[col]
                w = np.maximum(distances(a.x[i], b.x[j]), np.maximum(mine.core[i], theirs.core[j]))
                keep = w <= limit[row]
                i, j, w = i[keep], j[keep], w[keep]
                if len(i):
                    one, two = mine.ids[i], theirs.ids[j]
                    x, y = np.minimum(one, two), np.maximum(one, two)
                    best.offer(mine.tree[i], theirs.tree[j], w, x, y)
                    best.offer(theirs.tree[j], mine.tree[i], w, x, y)
            at, width = at + width, min(2 * width, max(1, STEP_COLUMNS // b.rows.shape[1]))

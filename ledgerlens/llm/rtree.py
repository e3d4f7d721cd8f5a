"""R-tree over count vectors, searched for pairs whose overlap can reach a threshold.

A set's point has one coordinate per group: how many of its members the hash puts
there. Two sets share at most the sum of the smaller coordinates; a node keeps
the largest coordinate of its points, so the same sum bounds the overlap with
anything below it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF = 16
FAN = 8
#: Coordinates that one step compares.
STEP = 1 << 22


def group_counts(hashes: np.ndarray, groups: int) -> np.ndarray:
    """Count vector of one set of hashes."""
    return np.bincount((hashes % np.uint64(groups)).astype(np.int64), minlength=groups).astype(np.uint32)


def shared_at_most(points: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Sum of coordinate minima of every (point, box)."""
    out = np.empty((len(points), len(upper)), np.int64)
    step = max(1, STEP // max(1, upper.size))
    for i in range(0, len(points), step):
        out[i : i + step] = np.minimum(points[i : i + step, None, :], upper[None, :, :]).sum(2, dtype=np.int64)
    return out


def can_link(mine: np.ndarray, theirs: np.ndarray, shared: np.ndarray, percent: int) -> np.ndarray:
    """Whether overlap ``shared`` of sets of these sizes gives the similarity: 100 i >= percent (a + b - i)."""
    return (100 + percent) * shared >= percent * (mine + theirs)


class RTree:
    """Levels of boxes over points in order of size; ``levels[0]`` are the leaves."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        heaviest = points.argmax(1) if points.size else np.zeros(len(points), np.int64)
        self.order = np.lexsort([heaviest, sizes])
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = [self.boxes(self.points, self.sizes, LEAF)]
        while len(self.levels[-1][0]) > FAN:
            self.levels.append(self.boxes(*self.levels[-1], FAN))

    @staticmethod
    def boxes(points: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Upper corner and smallest size of each ``width`` consecutive entries."""
        edges = np.arange(0, len(points), width)
        return np.maximum.reduceat(points, edges, axis=0), np.minimum.reduceat(sizes, edges)

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays of (i, j), i before j in ``order``, whose bound allows a link."""
        if len(self.points) > 1:
            top = len(self.levels) - 1
            for box in range(len(self.levels[top][0])):
                yield from self.descend(top, box, np.arange(len(self.points)), percent)

    def descend(self, level: int, box: int, asking: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        width = LEAF * FAN**level
        asking = asking[asking < min(len(self.points), (box + 1) * width)]  # pairs count once, from the earlier
        upper, least = (x[box : box + 1] for x in self.levels[level])
        shared = shared_at_most(self.points[asking], upper)[:, 0]
        asking = asking[can_link(self.sizes[asking], np.maximum(least[0], self.sizes[asking]), shared, percent)]
        if not len(asking):
            return
        if level:
            for child in range(box * FAN, min((box + 1) * FAN, len(self.levels[level - 1][0]))):
                yield from self.descend(level - 1, child, asking, percent)
            return
        rows = np.arange(box * LEAF, min((box + 1) * LEAF, len(self.points)))
        shared = shared_at_most(self.points[asking], self.points[rows])
        good = can_link(self.sizes[asking][:, None], self.sizes[rows][None, :], shared, percent)
        good &= asking[:, None] < rows[None, :]
        i, j = np.nonzero(good)
        if len(i):
            yield asking[i], rows[j]

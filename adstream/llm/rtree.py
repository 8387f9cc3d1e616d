"""A count-vector R-tree over shingle sets, and the clustering of one cell by it."""

from __future__ import annotations

import numpy as np

_FAN_OUT = 16


def count_vector(shingles: np.ndarray, groups: int) -> np.ndarray:
    """How many of the set's hashes fall into each of ``groups`` groups."""
    return np.bincount((shingles >> np.uint64(40)) % np.uint64(groups), minlength=groups).astype(np.int32)


class CountVectorTree:
    """Points are group counts; every box keeps the largest count per group and its range of sizes.

    The overlap of two sets is at most the sum over groups of the smaller count, and
    for all sets of a box at most that sum with the box's largest counts.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int):
        self.percent = percent
        slab = np.argsort(sizes, kind="stable")
        tile = np.empty(len(sizes), np.int64)
        tile[slab] = np.arange(len(sizes)) // (_FAN_OUT * _FAN_OUT)
        self.order = np.lexsort((sizes, points[:, 1 % points.shape[1]], points[:, 0] // 2, tile))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.place = np.empty(len(sizes), np.int64)
        self.place[self.order] = np.arange(len(sizes))
        self.alive = np.ones(len(sizes), bool)
        self.levels = []
        tops, least, most = self.points, self.sizes, self.sizes
        while len(tops) > _FAN_OUT or not self.levels:
            cuts = np.arange(0, len(tops), _FAN_OUT)
            tops = np.maximum.reduceat(tops, cuts)
            least, most = np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts)
            self.levels.append((tops, least, most, _FAN_OUT ** (len(self.levels) + 1)))
        self.left = [np.add.reduceat(self.alive.astype(np.int64), np.arange(0, len(sizes), s)) for *_, s in self.levels]

    def remove(self, item: int) -> None:
        at = self.place[item]
        self.alive[at] = False
        for left, (*_, span) in zip(self.left, self.levels):
            left[at // span] -= 1

    def _fits(self, point, size, nodes, tops, least, most) -> np.ndarray:
        """Those of some boxes that may hold a set similar enough: by size, then by the summed minima."""
        p = self.percent
        nodes = nodes[(100 * most[nodes] >= p * size) & (100 * size >= p * least[nodes])]
        smallest = np.maximum(least[nodes], -(-p * size // 100))
        need = p * (size + smallest)
        # Groups that a small set has nothing in add nothing.
        some = np.flatnonzero(point)
        if 8 * len(some) < len(point):
            both = np.minimum(tops[np.ix_(nodes, some)], point[some])
        else:
            both = np.minimum(tops[nodes], point)
        return nodes[(100 + p) * both.sum(axis=1) >= need]

    def query(self, point: np.ndarray, size: int) -> np.ndarray:
        """The remaining items whose bound allows a link with the given set."""
        nodes = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            tops, least, most, _ = self.levels[depth]
            nodes = nodes[self.left[depth][nodes] > 0]
            nodes = self._fits(point, size, nodes, tops, least, most)
            below = len(self.levels[depth - 1][0]) if depth else len(self.points)
            nodes = (nodes[:, None] * _FAN_OUT + np.arange(_FAN_OUT)).ravel()
            nodes = nodes[nodes < below]
        nodes = nodes[self.alive[nodes]]
        return self.order[self._fits(point, size, nodes, self.points, self.sizes, self.sizes)]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |intersection| >= percent * |union|, exactly."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def cluster(
    points: np.ndarray, shingles: list[np.ndarray], classes: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Links that join the sets of a cell into its components, one per merged class.

    Sets of one entry of ``classes`` are known to be together. Each set asks the tree for those not
    reached yet; what it reaches leaves the tree, so a dense group costs a few queries
    per set, not all its pairs. No two sets of different result groups link.
    """
    n = len(shingles)
    sizes = np.array([len(s) for s in shingles], np.int64)
    tree = CountVectorTree(points, sizes, percent)
    members: dict[int, list[int]] = {}
    for i, c in enumerate(classes.tolist()):
        members.setdefault(c, []).append(i)
    found, reached = [], np.zeros(n, bool)
    for first in members.values():
        if reached[first[0]]:
            continue
        frontier = list(first)
        for i in first:
            reached[i] = True
            tree.remove(i)
        while frontier:
            x = frontier.pop()
            for y in tree.query(points[x], int(sizes[x])).tolist():
                if reached[y] or not linked(shingles[x], shingles[y], percent):
                    continue
                found.append((x, y))
                for z in members[classes[y]]:
                    reached[z] = True
                    tree.remove(z)
                    frontier.append(z)
    return found

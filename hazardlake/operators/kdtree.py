"""The nearest rows of many points, from a tree over all rows that fits into one process.

Positions are points of the unit sphere. The tree halves the rows by their widest axis; all nodes of a level hold the same
number of rows, within one. A batch of points goes down the levels together: of a level's nodes those are kept that are
within the distance that surely holds as many rows as a point wants.
"""

from __future__ import annotations

import numpy as np

LEAF_ROWS = 32
POINTS_AT_ONCE = 512
# Distances are compared along the chord, with room for rounding.
SLACK = 1 + 1e-9
TINY = 1e-12


def unit_vectors(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    lat, lon = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], 1)


class Tree:
    """Rows by position; `order` are their numbers, as they lie in the tree. All positions must be finite."""

    def __init__(self, at: np.ndarray):
        n = len(at)
        self.levels = max(0, (n // LEAF_ROWS).bit_length() - 1)
        self.order = np.arange(n)
        for level in range(self.levels):
            first = self._first(n, level)
            middle = self._first(n, level + 1)[1::2]
            for a, m, b in zip(first, middle, first[1:]):
                rows = self.order[a:b]
                places = at[rows]
                axis = np.argmax(np.ptp(places, axis=0))
                self.order[a:b] = rows[np.argpartition(places[:, axis], m - a)]
        self.at = at[self.order]
        self.first = [self._first(n, level) for level in range(self.levels + 1)]
        self.low, self.high = [], []
        for first in self.first if n else ():
            self.low.append(np.minimum.reduceat(self.at, first[:-1]))
            self.high.append(np.maximum.reduceat(self.at, first[:-1]))

    @staticmethod
    def _first(n: int, level: int) -> np.ndarray:
        return np.arange((1 << level) + 1, dtype=np.int64) * n >> level

    def nearest(self, at: np.ndarray, reach: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many rows each point has, and the numbers of these rows, point by point: all of the `limit` nearest within
        the chord `reach`, those as far as the last of them, and none that is farther."""
        parts = [self._nearest(at[a:a + POINTS_AT_ONCE], reach[a:a + POINTS_AT_ONCE], limit[a:a + POINTS_AT_ONCE])
                 for a in range(0, len(at), POINTS_AT_ONCE)] if len(self.at) else []
        if not parts:
            return np.zeros(len(at), np.int64), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _nearest(self, at, reach, limit):
        reach = reach.copy()
        point, node = np.arange(len(at)), np.zeros(len(at), np.int64)
        for level in range(self.levels + 1):
            if level:
                point, node = np.repeat(point, 2), (2 * node[:, None] + np.arange(2)).reshape(-1)
            low, high, here = self.low[level][node], self.high[level][node], at[point]
            near = np.sqrt((np.maximum(np.maximum(low - here, here - high), 0) ** 2).sum(1))
            kept = near <= reach[point] * SLACK + TINY
            point, node, near = point[kept], node[kept], near[kept]
            far = np.sqrt((np.maximum(np.abs(here - low), np.abs(here - high))[kept] ** 2).sum(1))
            # As far as the nodes that surely hold enough rows, taken in order of their far ends.
            by_far = np.lexsort((far, point))
            upto = np.cumsum((self.first[level][node + 1] - self.first[level][node])[by_far])
            mine = point[by_far]
            begins = np.searchsorted(mine, np.arange(len(at)))
            before = np.append(0, upto)[begins]
            enough = np.flatnonzero(upto - before[mine] >= limit[mine])
            full, which = np.unique(mine[enough], return_index=True)
            reach[full] = np.minimum(reach[full], far[by_far[enough[which]]])
            kept = near <= reach[point] * SLACK + TINY
            point, node = point[kept], node[kept]
        first, sizes = self.first[-1][node], np.diff(self.first[-1])[node]
        before = np.cumsum(sizes) - sizes
        rows = np.repeat(first - before, sizes) + np.arange(int(sizes.sum()))
        point = np.repeat(point, sizes)
        chord = np.sqrt(((self.at[rows] - at[point]) ** 2).sum(1))
        # Pairs are in order of their points from level to level.
        bounds = np.searchsorted(point, np.arange(len(at) + 1)).tolist()
        for i, (a, b, k) in enumerate(zip(bounds, bounds[1:], limit.tolist())):
            if b - a > k:
                reach[i] = min(reach[i], np.partition(chord[a:b], k - 1)[k - 1])
        kept = chord <= reach[point] * SLACK + TINY
        return np.bincount(point[kept], minlength=len(at)), self.order[rows[kept]]

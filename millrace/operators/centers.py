"""Which of many centers is nearest to each row: exact, with far centers ruled out group by group."""

from __future__ import annotations

import numpy as np

AT_ONCE = 1_000_000  # distances held at once
GROUPED_FROM = 256  # fewer centers are all compared


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return ((x - y) ** 2).sum(axis=-1)


def _near(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Which centers may be the nearest, as far as a matrix product around the centers' mean can tell (at least one per row)."""
    middle = centers.mean(axis=0)
    rows, own = x - middle, centers - middle
    distances = (rows * rows).sum(axis=1)[:, None] + (own * own).sum(axis=1)[None, :] - 2 * (rows @ own.T)
    size = np.abs(rows).max(axis=1, initial=0.0)[:, None] + np.abs(own).max(axis=1, initial=0.0)[None, :]
    rounding = np.finfo("float64").eps * (np.abs(x).max(axis=1, initial=0.0)[:, None] + np.abs(centers).max(initial=0.0))
    error = (x.shape[1] + 4) ** 2 * (16 * np.finfo("float64").eps * size * size + 8 * rounding * (size + rounding))
    least = (distances + error).min(axis=1, keepdims=True)
    return ~(distances - error > least)  # not-a-number stays in


class Centers:
    """Fixed centers, in groups of near ones if there are many.

    ``nearest`` gives for each row the center with the least squared distance
    as the differences give it, the smaller number of equal ones, however far
    rows and centers are from the origin.  With groups, a row is compared with the
    centers of a group only if the distance to the group's middle less
    the group's radius is not above the best so far: the result is that of all comparisons.
    """

    def __init__(self, centers: np.ndarray, grouped_from: int = GROUPED_FROM):
        self.centers = centers
        self.groups: list[np.ndarray] = [np.arange(len(centers))]
        if len(centers) >= grouped_from:
            self._group()

    def _group(self) -> None:
        count = int(len(self.centers) ** 0.5)
        middles = self.centers[np.linspace(0, len(self.centers) - 1, count).astype(int)].copy()
        for _ in range(4):  # any grouping is right; a good one rules out more
            own = Centers(middles, len(middles) + 1).nearest(self.centers)[0]
            for g in np.unique(own):
                middles[g] = self.centers[own == g].mean(axis=0)
        own = Centers(middles, len(middles) + 1).nearest(self.centers)[0]
        used = np.unique(own)
        self.groups = [np.flatnonzero(own == g) for g in used]
        self.middles = middles[used]
        self.radius = np.array([np.sqrt(squared(self.centers[g], m).max()) for g, m in zip(self.groups, self.middles, strict=True)])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest center of every row of ``x``."""
        own, d2 = np.zeros(len(x), np.int64), np.full(len(x), np.inf)
        width = len(self.centers) if len(self.groups) == 1 else max(len(self.groups), *map(len, self.groups))
        step = max(1, AT_ONCE // max(1, width))
        for start in range(0, len(x), step):
            part = slice(start, start + step)
            own[part], d2[part] = self._nearest(x[part])
        return own, d2

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own, d2 = np.full(len(x), len(self.centers)), np.full(len(x), np.inf)
        if len(self.groups) == 1:
            self._compare(x, np.arange(len(x)), self.groups[0], own, d2)
            return own, d2
        to_middles = np.sqrt(np.stack([squared(x, m) for m in self.middles], axis=1))
        slack = 1e-9 * (1.0 + to_middles.max(axis=1) + np.abs(x).max(axis=1, initial=0.0))  # rounding only ever adds comparisons
        order = np.argsort(to_middles, axis=1)
        for rank in range(len(self.groups)):
            asked = order[:, rank]
            least = to_middles[np.arange(len(x)), asked] - self.radius[asked] - slack
            open_ = np.flatnonzero((least <= 0) | ~(least * least > d2))
            for g in np.unique(asked[open_]):
                self._compare(x, open_[asked[open_] == g], self.groups[g], own, d2)
        return own, d2

    def _compare(self, x: np.ndarray, rows: np.ndarray, members: np.ndarray, own: np.ndarray, d2: np.ndarray) -> None:
        centers = self.centers[members]
        at, near = np.nonzero(_near(x[rows], centers))
        for start in range(0, len(at), AT_ONCE // 8):
            pairs = slice(start, start + AT_ONCE // 8)
            row, member = rows[at[pairs]], members[near[pairs]]
            exact = squared(x[row], self.centers[member])
            best = np.lexsort((member, exact, row))
            first = best[np.concatenate(([True], np.diff(row[best]) != 0))]
            better = (exact[first] < d2[row[first]]) | ((exact[first] == d2[row[first]]) & (member[first] < own[row[first]]))
            own[row[first[better]]], d2[row[first[better]]] = member[first[better]], exact[first[better]]

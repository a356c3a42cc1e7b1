"""Range minima over an array, for whole arrays of queries at once."""

from __future__ import annotations

import numpy as np


class Minima:
    """Range minima of an array, as a sparse table."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << len(self.levels) - 1 <= len(values):
            last, half = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def after(self, at: np.ndarray, less: np.ndarray) -> np.ndarray:
        """First place at or after ``at`` whose value is under ``less`` (there is one)."""
        out = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            go = out < len(level)
            go[go] = level[out[go]] >= less[go]
            out[go] += 1 << k
        return out

    def before(self, at: np.ndarray, less: np.ndarray) -> np.ndarray:
        """Last place at or before ``at`` whose value is under ``less`` (there is one)."""
        out = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            start = out - (1 << k) + 1
            go = start >= 0
            go[go] = self.levels[k][start[go]] >= less[go]
            out[go] -= 1 << k
        return out

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least value in each range, both ends included."""
        k = np.frexp(last - first + 1)[1] - 1  # the largest power of two that fits
        out = np.empty(len(first), self.levels[0].dtype)
        for j in np.unique(k):
            at = k == j
            out[at] = np.minimum(self.levels[j][first[at]], self.levels[j][last[at] - (1 << int(j)) + 1])
        return out

"""Shared parts of the block-wise matrix operators."""

from __future__ import annotations

import math

import numpy as np


def block_count(n: int, size: int, smallest: int, parallelism: int) -> int:
    """Blocks of at most about ``size``; more, down to ``smallest``, where that fills the cluster."""
    return max(1, math.ceil(n / size), min(math.ceil(n / smallest), math.ceil(math.sqrt(2 * parallelism))))


def best_of_rows(score: np.ndarray, k: int) -> np.ndarray:
    """Mask of the k highest finite scores of each row; of equal scores the leftmost."""
    finite = np.isfinite(score)
    columns = score.shape[1]
    if k >= columns:
        return finite
    low = np.where(finite, score, -np.inf)
    kth = np.partition(low, columns - k, axis=1)[:, columns - k, None]
    above, ties = low > kth, low == kth
    room = k - above.sum(axis=1, keepdims=True)
    return finite & (above | (ties & (np.cumsum(ties, axis=1) <= room)))


def about_best_of_rows(score: np.ndarray, k: int, near: float) -> np.ndarray:
    """As ``best_of_rows``, and what is within ``near`` of the k-th best of a row; of equal scores the k leftmost."""
    finite = np.isfinite(score)
    columns = score.shape[1]
    if k >= columns:
        return finite
    low = np.where(finite, score, -np.inf)
    kth = np.partition(low, columns - k, axis=1)[:, columns - k, None]
    close = np.where(np.isfinite(kth), kth - near, -np.inf)
    ties, below = low == kth, (low < kth) & (low >= close)
    return finite & ((low > kth) | (ties & (np.cumsum(ties, axis=1) <= k)) | (below & (np.cumsum(below, axis=1) <= k)))


class Best:
    """The k best partners of some rows among those added so far, ties by the smaller partner; ``least`` is the score that a
    further one needs. With ``near``, scores not rounded yet, those within it of the k-th best stay, as in ``about_best_of_rows``."""

    def __init__(self, n: int, k: int, near: float = 0.0, places: int = 12):
        self.n, self.k, self.near, self.places, self.pending, self.found = n, k, near, places, 0, []
        self.least = np.full(n, -np.inf)

    def add(self, rows: np.ndarray, others: np.ndarray, scores: np.ndarray) -> None:
        use = scores >= self.least[rows]
        n = int(np.count_nonzero(use))
        if n:
            self.found.append((rows[use].astype(np.int32), others[use], scores[use]))
            self.pending += n
        if self.pending > max(self.n * self.k // 2, 4096):
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.found:
            return np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0)
        rows, others, scores = (np.concatenate(c) for c in zip(*self.found))
        rank = np.round(scores, self.places)
        order = np.lexsort((others, -rank, rows))
        rows, others, scores, rank = rows[order], others[order], scores[order], rank[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kth = np.full(self.n, -np.inf)
        last = place == self.k - 1
        kth[rows[last]] = rank[last]
        keep = place < self.k
        if self.near:
            keep |= (rank >= kth[rows] - self.near) & (place < 3 * self.k)
        self.found, self.pending, self.least = [(rows[keep], others[keep], scores[keep])], 0, kth - 2 * self.near
        return self.found[0]

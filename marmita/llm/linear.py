"""Logistic regression on a bounded sample, by Newton steps with conjugate gradients."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Sparse:
    """Rows x columns as triplets."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], self.shape[0])

    def transposed_times(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * r[self.row], self.shape[1])


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: Sparse, y: np.ndarray, ridge: float, pairs: Sparse | None = None, pair_penalty: float = 0.0,
        weight: np.ndarray | None = None, steps: int = 30) -> tuple[np.ndarray, float]:
    """Weights and intercept of least (weighted) mean log loss + ridge * |w|^2 / 2 + pair_penalty * mean squared score change of ``pairs``.

    A row of ``pairs`` is the difference of the features of a text and of its altered copy.
    """
    n, m = x.shape
    w, b = np.zeros(m), 0.0
    share = np.full(n, 1 / n) if weight is None else weight / weight.sum()
    per_pair = 2 * pair_penalty / max(1, pairs.shape[0]) if pairs else 0.0

    def penalty(v):
        return per_pair * pairs.transposed_times(pairs.times(v)) if pairs else 0.0

    def loss(w, b):
        z = x.times(w) + b
        change = pair_penalty * np.square(pairs.times(w)).sum() / max(1, pairs.shape[0]) if pairs else 0.0
        return share @ (np.logaddexp(0, z) - y * z) + ridge * w @ w / 2 + change

    for _ in range(steps):
        p = sigmoid(x.times(w) + b)
        gw, gb = x.transposed_times(share * (p - y)) + ridge * w + penalty(w), float(share @ (p - y))
        if np.sqrt(gw @ gw + gb * gb) < 1e-7:
            break
        h = np.maximum(p * (1 - p), 1e-9) * share
        dw, db = np.zeros(m), 0.0
        rw, rb = -gw, -gb
        qw, qb, rr = rw.copy(), rb, rw @ rw + rb * rb
        first = rr
        for _ in range(60):
            s = h * (x.times(qw) + qb)
            aw, ab = x.transposed_times(s) + ridge * qw + penalty(qw), s.sum()
            alpha = rr / max(qw @ aw + qb * ab, 1e-300)
            dw, db, rw, rb = dw + alpha * qw, db + alpha * qb, rw - alpha * aw, rb - alpha * ab
            new = rw @ rw + rb * rb
            if new < 1e-8 * first:
                break
            qw, qb, rr = rw + new / rr * qw, rb + new / rr * qb, new
        size, now = 1.0, loss(w, b)
        while size > 1e-4 and loss(w + size * dw, b + size * db) > now:
            size /= 2
        w, b = w + size * dw, b + size * db
    return w, b

"""Small sparse linear classifiers, trained on the driver from bounded samples."""

from __future__ import annotations

import numpy as np


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def row_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` from ``ends[i]`` to ``ends[i + 1]``; empty ones are 0."""
    if values.dtype == np.float32:
        values = values.astype(np.float64)
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return total[ends[1:]] - total[ends[:-1]]


def fit_softmax(slots: np.ndarray, ends: np.ndarray, labels: np.ndarray, classes: int, width: int, steps: int = 80, rate: float = 0.15, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias from rows of distinct slots, each row scaled by the root of its size; Adam steps."""
    n = len(ends) - 1
    size = np.maximum(1, np.diff(ends))
    scale = np.repeat(1 / np.sqrt(size), np.diff(ends))
    w, b = np.zeros((width, classes)), np.zeros(classes)
    m, v = np.zeros_like(w), np.zeros_like(w)
    mb, vb = np.zeros_like(b), np.zeros_like(b)
    hot = np.eye(classes)[labels]
    balance = (n / classes / np.maximum(1, hot.sum(0)))[labels] ** 0.5
    for t in range(1, steps + 1):
        p = softmax(row_sums(w[slots] * scale[:, None], ends) + b)
        err = (p - hot) * balance[:, None] / n
        spread = np.repeat(err, np.diff(ends), axis=0) * scale[:, None]
        g = np.stack([np.bincount(slots, spread[:, k], width) for k in range(classes)], 1) + ridge * w / n
        for x, gx, mx, vx in ((w, g, m, v), (b, err.sum(0), mb, vb)):
            mx += 0.1 * (gx - mx)
            vx += 0.01 * (gx * gx - vx)
            x -= rate * (mx / (1 - 0.9**t)) / (np.sqrt(vx / (1 - 0.99**t)) + 1e-8)
    return w, b

"""Small estimators that are fitted on bounded samples and applied inside Spark tasks."""

from __future__ import annotations

import numpy as np


def softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=-1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=-1, keepdims=True)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, dims: int, alpha: float = 1.0,
         beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4, epochs: int = 2, seed: int = 0) -> np.ndarray:
    """Multinomial logistic regression by follow-the-regularised-leader with elastic-net penalties.

    ``rows``: (feature indices, values) per example.  Returns dims x classes weights;
    a weight whose leader does not exceed the l1 penalty is exactly zero.
    """
    z, n = np.zeros((dims, classes)), np.zeros((dims, classes))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            if not len(at):
                continue
            zi, ni = z[at], n[at]
            w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
            w[np.abs(zi) <= l1] = 0.0
            p = softmax(x @ w)
            p[y[i]] -= 1.0
            g = x[:, None] * p[None, :]
            n2 = ni + g * g
            z[at] = zi + g - (np.sqrt(n2) - np.sqrt(ni)) / alpha * w
            n[at] = n2
    w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
    w[np.abs(z) <= l1] = 0.0
    return w


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature that gives held-back examples their highest likelihood (golden-section on log T)."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))[np.arange(len(y)), y]
        return -float(np.log(np.maximum(p, 1e-12)).mean())

    lo, hi, g = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit: knots to interpolate between (np.interp)."""
    o = np.argsort(x, kind="stable")
    x, y = x[o], y[o].astype(float)
    w = np.ones(len(x)) if w is None else w[o].astype(float)
    pools: list[list[float]] = []  # mean, weight, first x, last x
    for a, b, c in zip(x, y, w):
        pools.append([b, c, a, a])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m, v, _, last = pools.pop()
            p = pools[-1]
            p[0] = (p[0] * p[1] + m * v) / (p[1] + v)
            p[1] += v
            p[3] = last
    xs, ys = [], []
    for m, _, a, b in pools:
        xs += [a] if a == b else [a, b]
        ys += [m] if a == b else [m, m]
    return np.array(xs), np.array(ys)


def platt(x: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """(a, b) with P(1) = sigmoid(a * x + b), by Newton steps on smoothed targets."""
    up, down = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (up + 1.0) / (up + 2.0), 1.0 / (down + 2.0))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * x + b)
        d, v = p - t, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(d * x).sum(), d.sum()])
        h = np.array([[(v * x * x).sum() + 1e-6, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-6]])
        s = np.linalg.solve(h, g)
        a, b = a - float(np.clip(s[0], -2, 2)), b - float(np.clip(s[1], -2, 2))
        if np.abs(s).max() < 1e-8:
            break
    return a, b

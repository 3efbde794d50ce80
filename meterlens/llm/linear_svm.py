"""Linear hinge-loss classifier by dual coordinate descent on sparse rows."""

from __future__ import annotations

import numpy as np


def fit(rows: list[np.ndarray], values: list[np.ndarray], sign: np.ndarray, n_features: int, cost: float = 1.0,
        epochs: int = 20, seed: int = 7, tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias minimising |w|^2 / 2 + cost * sum(max(0, 1 - s (w.x + b))).

    ``rows[i]`` holds the feature numbers of row i (no repeats), ``values[i]``
    their values, ``sign[i]`` is +1 or -1.  Each step solves one dual variable
    exactly; the bias is the weight of a constant feature."""
    w, bias = np.zeros(n_features), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            at, v, s = rows[i], values[i], sign[i]
            slope = s * (w[at] @ v + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), cost)
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[at] += step * s * v
                bias += step * s
                worst = max(worst, abs(step))
        if worst < tolerance * cost:
            break
    return w, bias


def calibrate(margin: np.ndarray, positive: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Scale and offset of a logistic curve from margins to probabilities
    (Newton steps on smoothed targets); the scale stays positive."""
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, c = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margin + c, -30, 30)))
        g = np.array([((p - target) * margin).sum() + 1e-3 * a, (p - target).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, c = max(a - step[0], 1e-2), c - step[1]
        if abs(step).max() < 1e-6:
            break
    return float(a), float(c)

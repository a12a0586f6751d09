"""Follow-the-regularised-leader (proximal) for sparse linear models with
elastic-net penalties. One example at a time, per-coordinate rates; weights whose
accumulated gradient stays under the L1 penalty are exactly zero."""

from __future__ import annotations

import numpy as np


class Ftrl:
    """``classes`` rows of weights over ``size`` features. One row is logistic
    regression, more are multinomial (softmax)."""

    def __init__(self, size: int, classes: int = 1, alpha: float = 0.1, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3):
        self.z, self.n = np.zeros((classes, size)), np.zeros((classes, size))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        return np.where(np.abs(z) > self.l1, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2), 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        """One step on the example with values ``x`` at the distinct features ``at``."""
        w = self.weights(at)
        p = probabilities(w @ x)
        target = np.zeros(len(p))
        if len(p) == 1:
            target[0] = y
        else:
            target[y] = 1
        g = np.outer(p - target, x)
        n = self.n[:, at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[:, at] += g - sigma * w
        self.n[:, at] = n + g * g


def probabilities(scores: np.ndarray) -> np.ndarray:
    """Softmax of the last axis; the sigmoid if there is one class only."""
    if scores.shape[-1] == 1:
        return 1 / (1 + np.exp(-np.clip(scores, -50, 50)))
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood (golden section on its logarithm)."""
    def loss(t):
        p = probabilities(scores / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()
    a, b, r = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))

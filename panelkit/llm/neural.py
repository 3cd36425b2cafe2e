"""Small pieces that both trained models use."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


def tanh(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 2 / (1 + np.exp(-2 * x)) - 1


class Adam:
    """Adam over a dictionary of arrays, changed in place."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.step = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, grads: dict[str, np.ndarray], clip: float = 5.0) -> None:
        self.step += 1
        norm = np.sqrt(sum(float((g ** 2).sum()) for g in grads.values()))
        scale = min(1.0, clip / (norm + 1e-9))
        for k, g in grads.items():
            g = g * scale
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g ** 2 - self.v[k])
            m, v = self.m[k] / (1 - 0.9 ** self.step), self.v[k] / (1 - 0.999 ** self.step)
            self.params[k] -= (self.rate * m / (np.sqrt(v) + 1e-8)).astype(self.params[k].dtype)

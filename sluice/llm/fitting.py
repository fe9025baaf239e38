"""Minimising a smooth function, for the models that are fitted here."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def minimised(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], w: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS from `w`; `loss` gives value and gradient."""
    value, slope = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, back = slope.copy(), []
        for s, t in reversed(past):
            a = s @ way / (s @ t)
            way -= a * t
            back.append(a)
        way *= past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.abs(slope).max())
        for (s, t), a in zip(past, reversed(back)):
            way += s * (a - t @ way / (s @ t))
        size = 1.0
        while True:
            new_value, new_slope = loss(w - size * way)
            if new_value <= value - 1e-4 * size * (slope @ way) or size < 1e-8:
                break
            size /= 2
        step, change = -size * way, new_slope - slope
        if step @ change > 1e-12:
            past = [*past[1 - memory :], (step, change)]
        w, done = w + step, value - new_value < 1e-6 * max(1.0, value)
        value, slope = new_value, new_slope
        if done:
            break
    return w

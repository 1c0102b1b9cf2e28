"""A two-parameter logistic curve from margins to probabilities."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of least log loss, both classes weighing the same; by Newton steps
    with a little ridge, so separable margins do not run away."""
    positive, negative = (labels == 1).sum(), (labels == 0).sum()
    if not positive or not negative:
        return 1.0, 0.0
    scale = max(float(np.std(margins)), 1e-9)
    x = np.stack([margins / scale, np.ones(len(margins))])
    weight = np.where(labels == 1, 0.5 / positive, 0.5 / negative) * len(margins)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(theta @ x)
        slope = x @ (weight * (p - labels)) + 1e-2 * theta
        curve = (x * (weight * p * (1 - p))) @ x.T + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        theta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 0.0) / scale), float(theta[1])

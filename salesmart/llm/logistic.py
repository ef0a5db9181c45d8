"""A small logistic regression, fitted on bounded samples of labelled rows."""

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0,
    rounds: int = 30,
) -> np.ndarray:
    """Weights, the first of them the constant, by Newton steps with a ridge penalty.

    ``x`` should have columns of about unit size. With one class only the constant moves.
    """
    rows = np.column_stack([np.ones(len(x)), x])
    weight = np.ones(len(x)) if weight is None else weight
    penalty = np.full(rows.shape[1], ridge)
    penalty[0] = 1e-3
    w = np.zeros(rows.shape[1])
    for _ in range(rounds):
        p = sigmoid(rows @ w)
        gradient = rows.T @ (weight * (p - y)) + penalty * w
        curve = weight * p * (1 - p)
        step = np.linalg.solve((rows * curve[:, None]).T @ rows + np.diag(penalty), gradient)
        size = np.abs(step).max()
        w -= step * min(1.0, 4.0 / max(size, 1e-12))
        if size < 1e-7:
            break
    return w

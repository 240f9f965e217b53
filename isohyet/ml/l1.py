"""L1-penalised logistic regression with a penalised intercept, solved on distributed sums.

The objective is that of the reference's solver: |w|_1 + |b| + C * sum(weight * log loss), where
the intercept b is the coefficient of a constant column and is penalised like the others. Spark's own
estimator leaves the intercept out of the penalty and averages the loss.

Proximal Newton steps: one pass over the rows gives loss, gradient and Hessian, which are feature-sized;
the penalised quadratic model is solved by coordinate descent on the driver; and the pass of the next
step also gives the losses of shorter steps along the same direction, for the line search. The
rows are read once a step, about ten steps in all, and no row reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from ..operators.gram import array_sum

#: Lengths that the line search chooses from.
STEPS = tuple(0.5 ** i for i in range(12))
#: Share of the model's predicted fall that a step has to reach.
ENOUGH = 1e-4


def _pass(rows: DataFrame, vector: str, label: str, weight: str, beta: np.ndarray, direction: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Losses after each of STEPS along ``direction``, and gradient and Hessian after the whole of it."""
    d, steps = len(beta), STEPS

    def fn(x, y, w):
        x1 = np.hstack([x, np.ones((len(x), 1))])
        sign = 2.0 * y - 1.0
        here, ahead = x1 @ beta, x1 @ direction
        losses = [float(w @ np.logaddexp(0.0, -sign * (here + s * ahead))) for s in steps]
        m = here + ahead
        p = 0.5 * (1.0 + np.tanh(0.5 * m))
        g = x1.T @ (w * (p - y))
        h = (x1 * (w * p * (1.0 - p))[:, None]).T @ x1
        return np.concatenate([losses, g, h.ravel()])

    k = len(steps)
    total = array_sum(rows, vector, [label, weight], k + d + d * d, fn)
    return total[:k], total[k:k + d], total[k + d:].reshape(d, d)


def _model_step(beta: np.ndarray, g: np.ndarray, h: np.ndarray, sweeps: int = 2_000, tol: float = 1e-12) -> np.ndarray:
    """The direction that minimises g d + d H d / 2 + |beta + d|_1, by coordinate descent."""
    d = np.zeros_like(beta)
    hd = np.zeros_like(beta)
    diag = np.maximum(np.diag(h), 1e-12)
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(beta)):
            z = beta[j] + d[j] - (g[j] + hd[j]) / diag[j]
            new = np.sign(z) * max(abs(z) - 1.0 / diag[j], 0.0)
            change = new - beta[j] - d[j]
            if change:
                d[j] += change
                hd += change * h[:, j]
                moved = max(moved, abs(change) * np.sqrt(diag[j]))
        if moved < tol:
            break
    return d


def fit_l1_logistic(rows: DataFrame, vector: str, label: str, weight: str, width: int, c: float = 1.0,
                    max_iter: int = 2000, tol: float = 1e-10) -> tuple[np.ndarray, float, float]:
    """(coefficients, intercept, objective) for rows of (array<double> of ``width``, 0/1 label, weight).

    Stops when the model predicts a relative fall below ``tol``. ``rows`` is read once a step, so
    give it a written table; an empty one gives zeros.
    """
    beta = np.zeros(width + 1)
    losses, g, h = _pass(rows, vector, label, weight, beta, np.zeros(width + 1))
    value = c * losses[0]
    for _ in range(max_iter):
        g, h = c * g, c * h
        d = _model_step(beta, g, h)
        fall = g @ d + np.abs(beta + d).sum() - np.abs(beta).sum()
        if -fall <= tol * max(1.0, value):
            break
        losses, g, h = _pass(rows, vector, label, weight, beta, d)
        values = np.array([c * l + np.abs(beta + s * d).sum() for s, l in zip(STEPS, losses)])
        fine = [i for i, s in enumerate(STEPS) if values[i] <= value + ENOUGH * s * fall]
        if not fine:
            break
        if fine[0] > 0:  # the pass was for the whole step: take the sums where the shorter one ends
            d = STEPS[fine[0]] * d
            _, g, h = _pass(rows, vector, label, weight, beta, d)
        beta, value = beta + d, values[fine[0]]
    return beta[:-1], float(beta[-1]), float(value)

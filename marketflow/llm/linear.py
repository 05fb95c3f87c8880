"""Small linear models in numpy, fitted on samples whose size the caller bounds."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def _adam(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Full-batch descent with per-coordinate steps that shrink to nothing."""
    x, mean, square = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for step in range(1, steps + 1):
        g = gradient(x)
        mean += 0.1 * (g - mean)
        square += 0.01 * (g * g - square)
        x -= rate * (1 - step / (steps + 1)) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return x


def _dot(at, columns, values, weights, rows):
    return np.bincount(at, weights[columns] * values, minlength=rows)


def fit_logistic(
    at: np.ndarray, columns: np.ndarray, values: np.ndarray, label: np.ndarray, size: int, l2: float = 1e-5, steps: int = 600
) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression over sparse entries (`at` row, column, value)."""
    rows = len(label)

    def gradient(x):
        error = sigmoid(_dot(at, columns, values, x, rows) + x[-1]) - label
        g = np.bincount(columns, error[at] * values, minlength=size + 1) / rows
        g[:size] += l2 * x[:size]
        g[-1] = error.mean()
        return g

    x = _adam(gradient, np.zeros(size + 1), steps, 0.1)
    return x[:size], float(x[-1])


class _Entries:
    """Sparse entries (row, column, value) in the order of rows and of columns: sums by either are sums of neighbours.

    Entries that come in the order of rows are not copied for it. `size`: beyond all columns.
    """

    def __init__(self, at: np.ndarray, columns: np.ndarray, values: np.ndarray, rows: int, size: int):
        self.rows, self.size = rows, len(values)
        if (at[1:] < at[:-1]).any():
            by_row = np.argsort(at, kind="stable")
            at, columns, values = at[by_row], columns[by_row], values[by_row]
        present = np.zeros(size, bool)
        present[columns] = True
        self.used = np.flatnonzero(present)
        number = np.cumsum(present) - 1
        self.column, self.row_values = number[columns], values
        by_column = np.argsort(self.column, kind="stable")
        self.row, self.column_values = at[by_column].astype(np.intp), values[by_column]
        counts = np.bincount(at, minlength=rows)
        self.held = np.flatnonzero(counts)
        self.row_starts = (np.cumsum(counts) - counts)[self.held]
        counts = np.bincount(self.column, minlength=len(self.used))
        self.column_starts = np.cumsum(counts) - counts

    def by_row(self, weights: np.ndarray) -> np.ndarray:
        """Sum of values times the weights of their (used) columns, per row."""
        sums = np.zeros(self.rows)
        if self.size:
            products = weights[self.column]
            products *= self.row_values
            sums[self.held] = np.add.reduceat(products, self.row_starts)
        return sums

    def by_column(self, errors: np.ndarray) -> np.ndarray:
        """Sum of values times the errors of their rows, per used column."""
        products = errors[self.row]
        products *= self.column_values
        return np.add.reduceat(products, self.column_starts) if self.size else np.zeros(0)


def fit_softmax(
    at: np.ndarray, columns: np.ndarray, values: np.ndarray, label: np.ndarray, classes: int, size: int, l2: float = 1e-5, steps: int = 200
) -> np.ndarray:
    """Weights (`size` + 1, `classes`) of a multinomial logistic regression; the last row holds the intercepts.

    Columns without entries keep weights of 0.
    """
    rows, truth, entries = len(label), np.eye(classes)[label], _Entries(at, columns, values, len(label), size)
    used = len(entries.used)

    def gradient(x):
        x = x.reshape(classes, used + 1)
        margin = np.stack([entries.by_row(x[k, :used]) + x[k, used] for k in range(classes)], 1)
        error = np.ascontiguousarray((softmax(margin) - truth).T)
        g = np.empty_like(x)
        for k in range(classes):
            g[k, :used] = entries.by_column(error[k]) / rows + l2 * x[k, :used]
        g[:, used] = error.sum(1) / rows
        return g.ravel()

    found = _adam(gradient, np.zeros(classes * (used + 1)), steps, 0.2).reshape(classes, used + 1)
    weights = np.zeros((size + 1, classes))
    weights[entries.used], weights[size] = found[:, :used].T, found[:, used]
    return weights


def softmax(margin: np.ndarray) -> np.ndarray:
    powers = np.exp(margin - margin.max(1, keepdims=True))
    return powers / powers.sum(1, keepdims=True)


def fit_ordinal(
    at: np.ndarray, columns: np.ndarray, values: np.ndarray, grade: np.ndarray, grades: int, size: int, l2: float = 1e-5, steps: int = 200
) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds of P(grade > k) = sigmoid(weights . x - threshold k).

    The thresholds are a first one plus positive steps (as exponents), so their order
    can't break while they are fitted by the likelihood of the observed grades.
    """
    rows, low = len(grade), np.finfo(float).tiny

    def unpack(x):
        steps_up = np.exp(np.clip(x[size + 1 :], -20, 20))
        return x[:size], x[size] + np.concatenate([[0.0], np.cumsum(steps_up)]), steps_up

    def gradient(x):
        weights, cuts, steps_up = unpack(x)
        above = sigmoid(_dot(at, columns, values, weights, rows)[:, None] - cuts)
        tails = np.concatenate([np.ones((rows, 1)), above, np.zeros((rows, 1))], 1)
        slopes = tails * (1 - tails)
        r = np.arange(rows)
        p = np.maximum(tails[r, grade] - tails[r, grade + 1], low)
        down = -(slopes[r, grade] - slopes[r, grade + 1]) / p
        by_cut = np.zeros(grades + 1)
        np.add.at(by_cut, grade, slopes[r, grade] / p)
        np.add.at(by_cut, grade + 1, -slopes[r, grade + 1] / p)
        by_cut = by_cut[1:grades]
        g = np.zeros_like(x)
        g[:size] = np.bincount(columns, down[at] * values, minlength=size) / rows + l2 * weights
        g[size] = by_cut.sum() / rows
        g[size + 1 :] = steps_up * np.cumsum(by_cut[::-1])[::-1][1:] / rows
        return g

    weights, cuts, _ = unpack(_adam(gradient, np.zeros(size + grades - 1), steps, 0.2))
    return weights, cuts

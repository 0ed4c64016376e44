"""A linear-chain conditional random field with two labels, over rows of numbers in sequences."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CELLS = 500_000  # padded cells worked on at once


@dataclass(frozen=True)
class ChainCrf:
    """Label 1 scores ``row @ weights + bias`` against 0 for label 0; neighbours score ``transitions[a, b]``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    transitions: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.mean) / self.scale) @ self.weights + self.bias

    def marginals(self, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row, by forward-backward within each sequence."""
        scores, out = self.scores(rows), np.empty(len(rows))
        for cells, there in _groups(lengths):
            alpha, beta, log_z = _passes(scores[cells] * there, there, self.transitions)
            out[cells[there]] = np.exp(alpha[:, :, 1] + beta[:, :, 1] - log_z)[there]
        return out

    def viterbi(self, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The labels of the likeliest labelling of each sequence; ties go to label 0."""
        scores, out = self.scores(rows), np.zeros(len(rows), dtype=np.int8)
        for cells, there in _groups(lengths):
            unary = scores[cells] * there
            steps, count = unary.shape
            best = np.stack([np.zeros(count), unary[0]], axis=-1)
            back = np.zeros((steps, count, 2), dtype=np.int8)
            for t in range(1, steps):
                ways = best[:, :, None] + self.transitions[None]
                back[t] = ways.argmax(axis=1)
                new = ways.max(axis=1)
                new[:, 1] += unary[t]
                best = np.where(there[t][:, None], new, best)
            label = best.argmax(axis=1).astype(np.int8)
            for t in range(steps - 1, -1, -1):
                out[cells[t][there[t]]] = label[there[t]]
                label = np.where(there[t], back[t][np.arange(count), label], label)
        return out


def _groups(lengths: np.ndarray):
    """(cells, there), steps x sequences: row numbers, and whether a sequence is that long; long sequences go with long ones."""
    lengths = np.asarray(lengths, dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(lengths, kind="stable")[::-1]
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        steps = int(lengths[order[at]])
        some = order[at : at + max(1, CELLS // steps)]
        t = np.arange(steps)[:, None]
        there = t < lengths[some][None, :]
        yield np.where(there, starts[some][None, :] + t, 0), there
        at += len(some)


def _passes(unary: np.ndarray, there: np.ndarray, transitions: np.ndarray):
    """Forward and backward log sums, steps x sequences x 2, and each sequence's log normalizer."""
    steps, count = unary.shape
    alpha, beta = np.zeros((steps, count, 2)), np.zeros((steps, count, 2))
    alpha[0, :, 1] = unary[0]
    for t in range(1, steps):
        ways = alpha[t - 1][:, :, None] + transitions[None]
        new = np.logaddexp(ways[:, 0], ways[:, 1])
        new[:, 1] += unary[t]
        alpha[t] = np.where(there[t][:, None], new, alpha[t - 1])
    for t in range(steps - 2, -1, -1):
        ahead = beta[t + 1].copy()
        ahead[:, 1] += unary[t + 1]
        ways = transitions[None] + ahead[:, None, :]
        beta[t] = np.where(there[t + 1][:, None], np.logaddexp(ways[:, :, 0], ways[:, :, 1]), 0)
    return alpha, beta, np.logaddexp(alpha[-1, :, 0], alpha[-1, :, 1])


def fit(rows: np.ndarray, labels: np.ndarray, lengths: np.ndarray, penalty: float = 1e-3, steps: int = 80) -> ChainCrf:
    """Maximum conditional likelihood with an L2 penalty, by L-BFGS. Without rows: every label is 1."""
    if not len(rows):
        width = rows.shape[1]
        return ChainCrf(np.zeros(width), np.ones(width), np.zeros(width), 5.0, np.zeros((2, 2)))
    mean, scale = rows.mean(axis=0), np.maximum(rows.std(axis=0), 1e-6)
    x, y, n = (rows - mean) / scale, labels.astype(np.float64), len(rows)
    groups = list(_groups(lengths))
    width = x.shape[1]

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        weights, bias, trans = theta[:width], theta[width], theta[width + 1 :].reshape(2, 2)
        scores = x @ weights + bias
        expected, moves, value = np.zeros(n), np.zeros((2, 2)), 0.0
        for cells, there in groups:
            unary = scores[cells] * there
            alpha, beta, log_z = _passes(unary, there, trans)
            expected[cells[there]] = np.exp(alpha[:, :, 1] + beta[:, :, 1] - log_z)[there]
            value += log_z.sum()
            if len(cells) > 1:
                ahead = beta[1:].copy()
                ahead[:, :, 1] += unary[1:]
                pair = np.exp(alpha[:-1, :, :, None] + trans + ahead[:, :, None, :] - log_z[None, :, None, None])
                moves += (pair * there[1:, :, None, None]).sum(axis=(0, 1)) - seen_moves(cells, there)
                value -= (trans * seen_moves(cells, there)).sum()
        value -= (scores * y).sum()
        residual = expected - y
        gradient = np.concatenate([x.T @ residual, [residual.sum()], moves.ravel()])
        return value / n + penalty / 2 * (theta @ theta), gradient / n + penalty * theta

    def seen_moves(cells, there):
        before, after, both = y[cells[:-1]].astype(int), y[cells[1:]].astype(int), there[1:]
        return np.bincount((2 * before + after)[both], minlength=4).reshape(2, 2)

    theta = _lbfgs(loss, np.zeros(width + 5), steps)
    return ChainCrf(mean, scale, theta[:width], float(theta[width]), theta[width + 1 :].reshape(2, 2))


def _lbfgs(loss, theta: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    value, gradient = loss(theta)
    moved: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, used = gradient.copy(), []
        for s, d in reversed(moved):
            used.append((s @ direction) / (d @ s))
            direction -= used[-1] * d
        if moved:
            s, d = moved[-1]
            direction *= (s @ d) / (d @ d)
        for (s, d), a in zip(moved, reversed(used)):
            direction += (a - (d @ direction) / (d @ s)) * s
        rate, slope = 1.0, gradient @ direction
        while rate > 1e-8:
            new = theta - rate * direction
            new_value, new_gradient = loss(new)
            if new_value <= value - 1e-4 * rate * slope:
                break
            rate /= 2
        else:
            break
        s, d = new - theta, new_gradient - gradient
        done = value - new_value < 1e-7
        theta, value, gradient = new, new_value, new_gradient
        if s @ d > 1e-12:
            moved = [*moved[1 - memory :], (s, d)]
        if done:
            break
    return theta

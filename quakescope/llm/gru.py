"""Gated recurrent unit in numpy: forward with or without a trace, and backward through time.

Arrays are (steps, rows, units).  ``x`` holds the projected inputs of the
update gate, reset gate and candidate, side by side; ``u`` the recurrent
weights in the same order.
"""

from __future__ import annotations

import numpy as np

_ONE, _HALF = np.ones(1, np.float32), np.full(1, 0.5, np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def forward(x: np.ndarray, u: np.ndarray, start: np.ndarray, trace: bool = False) -> tuple[np.ndarray, list]:
    """States after each step; with ``trace`` also what ``backward`` needs."""
    steps, rows, units = x.shape[0], x.shape[1], u.shape[0]
    states, kept, h = np.empty((steps, rows, units), x.dtype), [], start
    for t in range(steps):
        step = h @ u
        gates = x[t, :, : 2 * units] + step[:, : 2 * units]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, r = gates[:, :units], gates[:, units:]
        inner = step[:, 2 * units :]
        new = r * inner
        new += x[t, :, 2 * units :]
        np.tanh(new, out=new)
        if trace:
            kept.append((h, z, r, inner, new))
        h = np.subtract(h, new, out=states[t])
        h *= z
        h += new
    return states, kept


def backward(grad: np.ndarray, kept: list, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of ``x`` and ``u`` from the gradient of every state."""
    units, steps, rows = u.shape[0], *grad.shape[:2]
    dx = np.empty((steps, rows, 3 * units), grad.dtype)
    flow, du = np.empty((rows, 3 * units), grad.dtype), np.zeros(u.shape, grad.dtype)  # flow: what reaches a step's recurrent products
    carry, left, a, b, turned = np.zeros_like(grad[0]), np.empty_like(grad[0]), np.empty_like(grad[0]), np.empty_like(grad[0]), np.ascontiguousarray(u.T)
    for t in range(steps - 1, -1, -1):
        h, z, r, inner, new = kept[t]
        carry += grad[t]
        np.subtract(1, z, out=left)
        left *= carry
        # candidate: carry (1 - z) (1 - new^2)
        np.multiply(new, new, out=a)
        np.subtract(1, a, out=a)
        d_new = np.multiply(a, left, out=dx[t, :, 2 * units :])
        # update gate: carry (1 - z) z (h - new)
        np.subtract(h, new, out=a)
        a *= z
        np.multiply(a, left, out=dx[t, :, :units])
        # reset gate: d_new inner r (1 - r)
        np.multiply(d_new, r, out=b)
        np.subtract(1, r, out=a)
        a *= inner
        np.multiply(a, b, out=dx[t, :, units : 2 * units])
        flow[:, : 2 * units] = dx[t, :, : 2 * units]
        flow[:, 2 * units :] = b
        du += h.T @ flow
        carry *= z
        carry += flow @ turned
    return dx, du


def scaled(weights: np.ndarray) -> np.ndarray:
    """Weights (or sums of inputs) of the gates times -1 and of the candidate times -2, so that 1 / (1 + exp) squashes them."""
    units = weights.shape[-1] // 3
    return weights * np.repeat(np.array([-1, -2], np.float32), [2 * units, units])


def _squash(x: np.ndarray) -> None:
    np.exp(x, out=x)
    x += _ONE
    np.divide(_ONE, x, out=x)


def forward_across(vectors: np.ndarray, w: dict[str, np.ndarray], start: np.ndarray, trace: bool = False) -> tuple[np.ndarray, tuple]:
    """States after each step as (steps, units + 1, rows), a one below each; every part of a step lies together.

    ``vectors`` (steps, rows, width) are the inputs; ``w`` holds the weights "on", "in" and "bias", and ``start``
    the first states (units, rows).  exp beyond its range gives infinity and so the gate's limit.
    """
    (units, rows), steps = start.shape, len(vectors)
    whole = scaled(np.vstack([w["on"], w["bias"], w["in"]]))
    in_new = np.ascontiguousarray(whole[units:, 2 * units :].T)
    whole[units:, 2 * units :] = 0  # the reset gate only weighs what the state gives
    on = np.ascontiguousarray(whole.T)
    # each step's: the state before, a one for the bias, the input
    line = np.empty((steps + 1, len(whole), rows), vectors.dtype)
    line[0, :units], line[:, units], line[:steps, units + 1 :] = start, 1, vectors.transpose(0, 2, 1)
    added = np.matmul(in_new, line[:steps, units:])
    gates, news = np.empty((steps if trace else 1, 3 * units, rows), line.dtype), np.empty((steps if trace else 1, units, rows), line.dtype)
    with np.errstate(over="ignore"):
        for t in range(steps):
            here = t if trace else 0
            gate, new = gates[here], news[here]
            np.matmul(on, line[t], out=gate)
            _squash(gate[: 2 * units])
            np.multiply(gate[units : 2 * units], gate[2 * units :], out=new)
            new += added[t]
            _squash(new)
            new += new
            new -= _ONE
            after = np.subtract(line[t, :units], new, out=line[t + 1, :units])
            after *= gate[:units]
            after += new
    return line[1:, : units + 1], (line[:steps], gates, news)


def backward_across(grad: np.ndarray, kept: tuple, w: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Gradients of the inputs (steps, width, rows) and of the weights from the gradient of every state, for ``forward_across``."""
    line, gates, news = kept
    steps, units, rows = news.shape
    z, r, inner = gates[:, :units], gates[:, units : 2 * units], gates[:, 2 * units :]  # inner: times -2
    # what a state's gradient is multiplied by: the candidate's recurrent products, update gate, reset gate, candidate
    slopes, left, some = np.empty((steps, 4, units, rows), grad.dtype), np.subtract(_ONE, z), news * news
    np.subtract(_ONE, some, out=some)
    np.multiply(some, left, out=slopes[:, 3])
    flow = np.multiply(slopes[:, 3], r, out=slopes[:, 0])
    np.subtract(r, _ONE, out=some)
    some *= _HALF
    some *= inner
    np.multiply(some, flow, out=slopes[:, 2])
    np.subtract(line[:, :units], news, out=some)
    some *= z
    np.multiply(some, left, out=slopes[:, 1])
    carry, back = np.zeros((units, rows), grad.dtype), np.empty((units, rows), grad.dtype)
    turned, flat = np.concatenate([w["on"][:, 2 * units :], w["on"][:, : 2 * units]], axis=1), slopes.reshape(steps, 4 * units, rows)
    for t in range(steps - 1, -1, -1):
        carry += grad[t]
        slopes[t] *= carry
        carry *= z[t]
        carry += np.matmul(turned, flat[t, : 3 * units], out=back)
    by = lambda a, b: np.matmul(a, b.transpose(0, 2, 1)).sum(axis=0).T
    both, on_inner, in_new = by(flat[:, units : 3 * units], line), by(flat[:, :units], line[:, :units]), by(flat[:, 3 * units :], line[:, units:])
    below = np.concatenate([both[units:], in_new], axis=1)
    return np.matmul(w["in"], flat[:, units:]), {"on": np.concatenate([both[:units], on_inner], axis=1), "bias": below[0], "in": below[1:]}


class Adam:
    """Steps on a dictionary of arrays, in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(w) for k, w in weights.items()}
        self.v = {k: np.zeros_like(w) for k, w in weights.items()}

    def step(self, weights: dict[str, np.ndarray], grads: dict[str, np.ndarray], clip: float = 5.0) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = min(1.0, clip / (norm + 1e-12))
        for k, g in grads.items():
            g = g * scale
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.99**self.t)
            weights[k] -= (self.rate * m / (np.sqrt(v) + 1e-8)).astype(weights[k].dtype)


def pack(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w.ravel() for w in weights.values()])


def unpack(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, w in like.items():
        out[k] = flat[at : at + w.size].reshape(w.shape).astype(w.dtype)
        at += w.size
    return out


def views(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The parts of ``flat`` under the names and in the shapes of ``like``, not copied."""
    ends = np.cumsum([w.size for w in like.values()])
    return {k: part.reshape(w.shape) for (k, w), part in zip(like.items(), np.split(flat, ends[:-1]))}

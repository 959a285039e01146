"""Convolution over embedded ids with max pooling over fixed-length windows, trained and applied in numpy.

A filter of width w over embedded ids is a sum of w table look-ups, ``(embedding @ W[j])[id]``: applying the network multiplies the
embedding once per table, not once per place.
"""

from __future__ import annotations

import numpy as np


class MaxConv:
    """Filters of several widths; ``pool`` gives each window's largest response to each filter, at least 0."""

    def __init__(self, dim: int, filters: int, widths: tuple[int, ...], rng: np.random.Generator):
        self.widths, self.filters = widths, filters
        self.w = [rng.normal(0, (w * dim) ** -0.5, (w, dim, filters)).astype(np.float32) for w in widths]
        self.b = [np.zeros(filters, np.float32) for _ in widths]

    @property
    def size(self) -> int:
        return self.filters * len(self.widths)

    def tables(self, embedding: np.ndarray) -> list[list[np.ndarray]]:
        return [[embedding @ w[j] for j in range(len(w))] for w in self.w]

    def responses(self, ids: np.ndarray, tables: list[list[np.ndarray]], step: int = 1):
        """For each width the responses (windows, places, filters); ``step``: ids from one table to the next."""
        for parts, b in zip(tables, self.b, strict=True):
            places = ids.shape[1] - (len(parts) - 1) * step
            out = parts[0].take(ids[:, :places], axis=0)
            for j, part in enumerate(parts[1:], 1):
                out += part.take(ids[:, j * step:j * step + places], axis=0)
            yield out, b

    def pool(self, ids: np.ndarray, tables: list[list[np.ndarray]], step: int = 1) -> np.ndarray:
        return np.concatenate([np.maximum(out.max(axis=1) + b, 0) for out, b in self.responses(ids, tables, step)], axis=1)

    def pool_with_places(self, ids: np.ndarray, embedding: np.ndarray):
        tables = self.tables(embedding)
        pooled, places = [], []
        for out, b in self.responses(ids, tables):
            at = out.argmax(axis=1)
            pooled.append(np.maximum(np.take_along_axis(out, at[:, None, :], axis=1)[:, 0] + b, 0))
            places.append(at)
        return np.concatenate(pooled, axis=1), places

    def gradients(self, ids: np.ndarray, embedding: np.ndarray, pooled: np.ndarray, places: list[np.ndarray], grad: np.ndarray):
        """Gradients of the filters, their biases and the embedding, from that of the pooled responses."""
        grad = np.where(pooled > 0, grad, 0).astype(np.float32)
        d_embedding = np.zeros_like(embedding)
        d_w, d_b = [], []
        column, row = np.arange(self.filters)[None, :], np.arange(len(ids))[:, None]
        for k, (w, at) in enumerate(zip(self.w, places, strict=True)):
            g = grad[:, k * self.filters:(k + 1) * self.filters]
            parts = []
            for j in range(len(w)):
                d_table = np.zeros((len(embedding), self.filters), np.float32)
                np.add.at(d_table, (ids[row, at + j], column), g)
                parts.append(embedding.T @ d_table)
                d_embedding += d_table @ w[j].T
            d_w.append(np.stack(parts))
            d_b.append(g.sum(axis=0))
        return d_w, d_b, d_embedding


class Adam:
    def __init__(self, parameters: list[np.ndarray], rate: float, shares: list[float] = ()):
        """``shares``: parts of the rate for the first parameters; the others learn at the full rate."""
        self.p, self.rate, self.t = parameters, rate, 0
        self.shares = [*shares, *[1.0] * (len(parameters) - len(shares))]
        self.m, self.v = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]

    def step(self, gradients: list[np.ndarray]) -> None:
        self.t += 1
        scale = self.rate * (1 - 0.999 ** self.t) ** 0.5 / (1 - 0.9 ** self.t)
        for p, g, m, v, share in zip(self.p, gradients, self.m, self.v, self.shares, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= share * scale * m / (np.sqrt(v) + 1e-8)


def windows(ids: np.ndarray, length: int) -> np.ndarray:
    """The whole sequence in rows of ``length``; the last one is filled with 0."""
    rows = max(1, -(-len(ids) // length))
    out = np.zeros(rows * length, ids.dtype)
    out[:len(ids)] = ids
    return out.reshape(rows, length)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)

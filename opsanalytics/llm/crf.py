"""Two-state linear-chain conditional random field over the lines of many texts at once (numpy).

All lines stand in one row.  A line's factor is a 2x2 matrix; the first line of a text has
equal rows, so what came before it only changes the scale and texts do not mix.  The row is
cut into about as many blocks as a block has lines: block products, vectors at the block
borders, and the vectors inside are each computed for all blocks at once.  A pass over n lines
takes some multiples of sqrt(n) steps, however long a single text is.
"""

from __future__ import annotations

import numpy as np


def _chain(m: np.ndarray) -> np.ndarray:
    """Row vectors v m[0], v m[0] m[1], ..., each scaled to sum 1; v is uniform."""
    n = len(m)
    if not n:
        return np.zeros((0, 2))
    size = max(1, int(np.sqrt(n)))
    blocks = -(-n // size)
    padded = np.empty((blocks * size, 2, 2))
    padded[:n], padded[n:] = m, np.eye(2)
    x = np.ascontiguousarray(padded.reshape(blocks, size, 4).transpose(1, 2, 0))  # step, entry, block
    a, b, c, d = x[0]
    for s in range(1, size):
        e, f, g, h = x[s]
        a, b, c, d = a * e + b * g, a * f + b * h, c * e + d * g, c * f + d * h
        top = np.maximum(np.maximum(a, b), np.maximum(c, d))
        a, b, c, d = a / top, b / top, c / top, d / top
    p, q = np.empty(blocks), np.empty(blocks)
    u = v = 0.5
    for k, (e, f, g, h) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True)):
        p[k], q[k] = u, v
        u, v = u * e + v * g, u * f + v * h
        u, v = u / (u + v), v / (u + v)
    out = np.empty((size, 2, blocks))
    for s in range(size):
        e, f, g, h = x[s]
        p, q = p * e + q * g, p * f + q * h
        total = p + q
        p, q = p / total, q / total
        out[s, 0], out[s, 1] = p, q
    return out.transpose(2, 0, 1).reshape(-1, 2)[:n]


def marginals(unary: np.ndarray, off: np.ndarray, trans: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(P(state) per line, summed pair marginals, log normaliser per text) for log potentials; ``weight`` per line weighs the pairs."""
    n = len(unary)
    first = np.zeros(n, bool)
    full = np.flatnonzero(np.diff(off))
    first[off[:-1][full]] = True
    logs = unary[:, None, :] + np.where(first[:, None, None], 0.0, trans[None])
    top = logs.max((1, 2))
    m = np.exp(logs - top[:, None, None])
    ahead = _chain(m)
    behind = np.full((n, 2), 0.5)
    behind[:-1] = _chain(m[:0:-1].transpose(0, 2, 1))[::-1]
    p = ahead * behind
    p /= p.sum(1, keepdims=True)
    before = np.full((n, 2), 0.5)
    before[1:] = ahead[:-1]
    before[first] = 0.5
    norm = np.zeros(len(off) - 1)
    # The rows of a first line are equal: whatever vector of sum 1 came before, it adds up to one of them.
    grown = np.log(np.einsum("ni,nij->n", before, m)) + top
    norm[full] = np.add.reduceat(grown, off[:-1][full]) if len(full) else 0
    pair = before[:, :, None] * m * behind[:, None, :]
    pair /= pair.sum((1, 2), keepdims=True)
    inner = ~first
    return p, (pair[inner] * (1.0 if weight is None else weight[inner, None, None])).sum(0), norm


def fit(x: np.ndarray, off: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 150, decay: float = 1e-2) -> tuple[np.ndarray, np.ndarray]:
    """Weights of state 1 (per feature) and transitions, by Adam on the penalised log-likelihood; ``weight`` per text."""
    w, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    wl = weight[np.repeat(np.arange(len(off) - 1), np.diff(off))]
    inner = np.ones(len(x), bool)
    inner[off[:-1][np.diff(off) > 0]] = False
    b = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[b - 1], y[b]), wl[b])
    moments = [np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros((2, 2)), np.zeros((2, 2))]
    scale = 1 / max(wl.sum(), 1e-9)
    for step in range(1, steps + 1):
        unary = np.stack([np.zeros(len(x)), x @ w], 1)
        p, expected, _ = marginals(unary, off, trans, wl)
        gw = x.T @ (wl * (y - p[:, 1])) * scale - decay * w
        gt = (seen - expected) * scale - decay * trans
        for k, (g, target) in enumerate(((gw, w), (gt, trans))):
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            target += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return w, trans

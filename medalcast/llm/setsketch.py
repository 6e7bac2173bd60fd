"""SetSketch registers of many sets at once, in numpy.

Ertl, "SetSketch: Filling the Gap between MinHash and HyperLogLog" (2021).
Register i of a set is ``clip(floor(1 - log_b(min over elements of h_i)), 0, q + 1)``
with ``h_i`` independent exponentials of rate ``a`` that depend on the element
alone: exponentially spaced, truncated minima. The register-wise maximum of
two sketches is the sketch of the union, and equal registers mark similar sets.

The m exponentials of an element come from one Poisson stream of rate ``m*a``
whose events fall on registers at random: the first event on each register is
then exponential with rate ``a``, independently. Events are made in growing
blocks and an element stops once its next event can't raise the set's lowest
register, so large sets cost about one event an element.
"""

from __future__ import annotations

import numpy as np

from .textvec import U, mix

M = 256            # registers; a power of two
B = 1.001          # spacing of register values
A = 20.0           # rate
Q = (1 << 16) - 2  # largest register value less one (fits 16 bits)
LOG_B = np.log(B)


def registers(row: np.ndarray, h: np.ndarray, n_rows: int) -> np.ndarray:
    """uint16 [n_rows, M]; ``row``, ``h``: the elements of each set. Rows without elements stay 0."""
    reg = np.zeros(n_rows * M, np.int32)
    r, e = row.astype(np.int64), h
    at = np.zeros(len(h))
    done, block = 0, 1
    while len(e):
        step = max(1, (1 << 19) // block)          # bounded matrices
        last = np.empty(len(e))
        for i in range(0, len(e), step):
            j = np.arange(done + 1, done + block + 1, dtype=U) * U(0xD1342543DE82EF95)
            bits = mix(e[i:i + step, None] + j[None, :])
            x = -np.log(((bits >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
            x = np.cumsum(x, axis=1)
            x += at[i:i + step, None]
            last[i:i + step] = x[:, -1]
            k = np.floor(1.0 - np.log(x / (M * A)) / LOG_B)
            np.clip(k, 0, Q + 1, out=k)
            where = r[i:i + step, None] * M + (bits & U(M - 1)).astype(np.int64)
            np.maximum.at(reg, where.ravel(), k.astype(np.int32).ravel())
        done += block
        low = reg.reshape(n_rows, M).min(axis=1)
        next_k = np.floor(1.0 - np.log(last / (M * A)) / LOG_B)
        go = (next_k > low[r]) & (next_k > 0)
        r, e, at = r[go], e[go], last[go]
        block = min(256, block * 2)
    return reg.reshape(n_rows, M).astype(np.uint16)


def band_keys(reg: np.ndarray, rows_per_band: int) -> np.ndarray:
    """uint64 [n_rows, M // rows_per_band]: a hash of each band's register values and its number."""
    n, bands = len(reg), M // rows_per_band
    parts = reg[:, :bands * rows_per_band].reshape(n, bands, rows_per_band).astype(U)
    acc = np.zeros(parts.shape[:2], U) + (np.arange(parts.shape[1], dtype=U) * U(0x9E3779B97F4A7C15))[None, :]
    for c in range(rows_per_band):
        acc = mix(acc + parts[:, :, c])
    return acc


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / LOG_B


def log_likelihood(j, u, more, less, same):
    """Of similarity ``j`` given how many registers are greater, less and equal; u: share of the first set's size."""
    v = 1.0 - u
    p, n = _p(u - v * j), _p(v - u * j)
    tiny = 1e-300
    return (more * np.log(np.maximum(p, tiny)) + less * np.log(np.maximum(n, tiny))
            + same * np.log(np.maximum(1.0 - p - n, tiny)))


def joint_estimate(reg_a: np.ndarray, reg_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float):
    """Maximum-likelihood similarity of each pair, and its log-likelihood lead over the best value >= threshold.

    The likelihood is concave enough in j for a grid then a refinement to find
    its top; a lead of 0 means that the top lies at or above the threshold.
    Whether two sizes can reach the threshold at all is for the caller to decide
    in whole numbers; here the largest possible similarity is the threshold at least.
    """
    more = (reg_a > reg_b).sum(axis=1).astype(float)
    less = (reg_a < reg_b).sum(axis=1).astype(float)
    same = M - more - less
    u = n_a / (n_a + n_b)
    top = np.maximum(np.minimum(u / (1 - u), (1 - u) / u), threshold)      # largest possible similarity
    grid = np.linspace(0, 1, 101)[None, :] * top[:, None]
    ll = log_likelihood(grid, u[:, None], more[:, None], less[:, None], same[:, None])
    best = ll.argmax(axis=1)
    j = grid[np.arange(len(u)), best]
    ll_at = log_likelihood(np.maximum(j, threshold), u, more, less, same)
    return j, np.maximum(0.0, ll.max(axis=1) - ll_at)

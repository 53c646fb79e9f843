"""Whitening of a small table with Python integers."""

import math

import numpy as np


def whiten(rows, k=4):
    """rows: (vec_id, vector) -> (n, {x: deviation}, eigenvalues, covariance, kept [(vec_id, x)], sums)"""
    kept = []
    for i, v in rows:
        if v is None or not len(v) or any(c is None or not math.isfinite(c) for c in v):
            continue
        kept.append((i, tuple(math.floor(256 * float(c)) for c in v)))
    dims = max((len(x) for _, x in kept), default=0)
    kept = [(i, x + (0,) * (dims - len(x))) for i, x in kept]
    fit = sorted({x for _, x in kept})
    n = len(fit)
    sums = [sum(x[j] for x in fit) for j in range(dims)]
    dev = {x: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for x in fit}
    cov = np.array([[sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit) / n ** 3 for j in range(dims)]
                    for i in range(dims)], float).reshape(dims, dims)
    return n, dev, np.sort(np.linalg.eigvalsh(cov))[::-1][:k], cov, kept, sums

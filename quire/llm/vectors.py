"""Shared preparation of embedding tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and without null or non-finite components."""
    limit = float("inf")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x < limit) & (x > -limit))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def kmeans(points: np.ndarray, centres: int, seed: int = 3, rounds: int = 10) -> np.ndarray:
    """Centres of a sample that fits into memory."""
    rng = np.random.default_rng(seed)
    found = points[rng.choice(len(points), min(centres, len(points)), replace=False)].copy()
    for _ in range(rounds):
        nearest = squared(points, found).argmin(axis=1)
        sums, sizes = np.zeros_like(found), np.bincount(nearest, minlength=len(found))
        np.add.at(sums, nearest, points)
        found[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return found


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``a`` to each of ``b``."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0)

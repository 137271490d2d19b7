"""Eigendecompositions of scatter matrices, kept up to date by rank-one changes."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def secular_roots(poles: np.ndarray, weights: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum_j weights_j / (poles_j - x) for each lane, as (origin, offset): x = poles[origin] + offset.

    Rows are lanes. The first ``live`` entries of a row are rising poles with weights above zero; later ones have
    weight zero. Root i lies between poles i and i + 1, the last one within the sum of weights above its pole. It
    is kept as an offset from the nearer pole, so that differences to poles keep their digits. Steps solve a
    rational form with the value and slope of the terms on either side; one that leaves the bracket is halved.
    """
    lanes, width = poles.shape
    lane, i = np.nonzero(np.arange(width) < live[:, None])
    last = i == live[lane] - 1
    after = np.minimum(i + 1, width - 1)
    gap = np.where(last, weights.sum(1)[lane], poles[lane, after] - poles[lane, i])
    w, below = weights[lane], np.arange(width) <= i[:, None]
    half = gap / 2
    value = 1 + (w / (poles[lane] - poles[lane, i][:, None] - half[:, None])).sum(1)
    right = (value < 0) & ~last
    origin = np.where(right, after, i)
    delta = poles[lane] - poles[lane, origin][:, None]
    low = np.where(right, -half, np.where(value < 0, half, 0.0))
    high = np.where(right, 0.0, np.where(value < 0, gap, half))
    x = np.where(right, -half, half)
    going, below = np.arange(len(x)), below.astype(float)
    for _ in range(200):
        if not len(going):
            break
        inverse = delta - x[going][:, None]
        np.reciprocal(inverse, out=inverse)
        terms = w * inverse
        slopes = terms * inverse
        psi, dpsi = np.einsum("ij,ij->i", terms, below), np.einsum("ij,ij->i", slopes, below)
        phi, dphi = terms.sum(1) - psi, slopes.sum(1) - dpsi
        g = going
        f = 1 + psi + phi
        low[g], high[g] = np.where(f < 0, x[g], low[g]), np.where(f < 0, high[g], x[g])
        at = np.arange(len(g))
        a, b = 1 / inverse[at, i[g]], 1 / inverse[at, after[g]]
        q, s = a * a * dpsi, b * b * dphi
        c = 1 + psi - a * dpsi + np.where(last[g], 0, phi - b * dphi)
        with np.errstate(all="ignore"):
            middle = c * (a + b) + q + s
            end = a * b * f
            spread = np.sqrt(np.abs(middle * middle - 4 * c * end))
            two = np.where(middle <= 0, (middle - spread) / (2 * c), 2 * end / (middle + spread))
            step = np.where(last[g], a + q / c, two)
            to = x[g] + step
            inside = (to > low[g]) & (to < high[g])
        to = np.where(inside, to, (low[g] + high[g]) / 2)
        still = (np.abs(f) > 4 * EPS * (1 + np.abs(psi) + np.abs(phi))) & (np.abs(to - x[g]) > 2 * EPS * np.abs(to))
        x[g[still]] = to[still]
        if not still.all():
            going, delta, w, below = g[still], delta[still], w[still], below[still]
    origins, offsets = np.zeros((lanes, width), int), np.zeros((lanes, width))
    origins[lane, i], offsets[lane, i] = origin, x
    return origins, offsets


def _close_pairs(values, vectors, z, live, tolerance):
    """Turn pairs of all but equal values so that the first of them has no part in the change. In place."""
    width = values.shape[1]
    place = np.where(live, np.arange(width), -1)
    before = np.concatenate([np.full((len(z), 1), -1), np.maximum.accumulate(place, axis=1)[:, :-1]], axis=1)
    gaps = values - np.take_along_axis(values, np.maximum(before, 0), 1)
    # A turn leaves gap * c * s outside the diagonal, and c * s is one half at most.
    with np.errstate(all="ignore"):
        other = np.take_along_axis(z, np.maximum(before, 0), 1)
        left = gaps * np.abs(z * other) / (z * z + other * other)
    for lane in np.flatnonzero((live & (before >= 0) & (left <= tolerance[:, None])).any(1)):
        earlier = -1
        for j in np.flatnonzero(live[lane]):
            if earlier >= 0:
                r = np.hypot(z[lane, earlier], z[lane, j])
                c, s = z[lane, j] / r, z[lane, earlier] / r
                d0, d1 = values[lane, earlier], values[lane, j]
                if abs((d1 - d0) * c * s) <= tolerance[lane]:
                    v0, v1 = vectors[lane, :, earlier].copy(), vectors[lane, :, j].copy()
                    vectors[lane, :, earlier], vectors[lane, :, j] = c * v0 - s * v1, s * v0 + c * v1
                    values[lane, earlier], values[lane, j] = d0 * c * c + d1 * s * s, d0 * s * s + d1 * c * c
                    z[lane, earlier], z[lane, j], live[lane, earlier] = 0.0, r, False
            earlier = j


def rank_one(values: np.ndarray, vectors: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) of V diag(values) V' + x x', for each lane.

    Entries that x hardly touches, and all but one of each set of equal values, are deflated: they stay as they
    are. The others are the roots of the secular equation; vectors come from the entries for which the roots
    are exact, so they are orthogonal however close the roots are.
    """
    values, vectors = values.copy(), vectors.copy()
    z = (x[:, None, :] @ vectors)[:, 0]
    square = (z * z).sum(1)
    tolerance = 8 * EPS * np.maximum(np.abs(values).max(1, initial=0), square)
    live = np.abs(z) * np.sqrt(square)[:, None] > tolerance[:, None]
    _close_pairs(values, vectors, z, live, tolerance)
    lanes, width = values.shape
    order = np.argsort(np.where(live, values, np.inf), axis=1, kind="stable")
    count = live.sum(1)
    poles, z = np.take_along_axis(values, order, 1), np.take_along_axis(np.where(live, z, 0), order, 1)
    active = np.arange(width) < count[:, None]
    # Poles that take no part are kept away from the roots; their weight is zero.
    far = np.where(active, poles, 2 * np.abs(poles).max(1, initial=0)[:, None] + 4 * square[:, None] + 1)
    origin, offset = secular_roots(far, z * z, count)
    base = np.take_along_axis(far, origin, 1)
    both = active[:, :, None] & active[:, None, :]
    to_root = np.where(both, far[:, None, :] - base[:, :, None] - offset[:, :, None], 1.0)
    to_pole = far[:, None, :] - far[:, :, None]
    to_pole = np.where(both & ~np.eye(width, dtype=bool), to_pole, 1.0)
    exact = np.sign(z) * np.sqrt(np.abs(to_root / to_pole).prod(1))
    turn = np.where(both, exact[:, None, :] / to_root, np.eye(width))
    turn /= np.sqrt((turn * turn).sum(2))[:, :, None]
    moved = np.where(active, base + offset, poles)
    rising = np.argsort(moved, axis=1, kind="stable")
    turn = np.take_along_axis(turn, rising[:, :, None], 1)
    basis = np.take_along_axis(vectors, order[:, None, :], 2)
    return np.maximum(np.take_along_axis(moved, rising, 1), 0), basis @ turn.transpose(0, 2, 1)


class Spectra:
    """Count, mean and spectrum of the scatter about the mean, for lanes that take in rows side by side."""

    def __init__(self, lanes: int, width: int):
        self.n, self.mean = np.zeros(lanes), np.zeros((lanes, width))
        self.values = np.zeros((lanes, width))
        self.vectors = np.tile(np.eye(width), (lanes, 1, 1))

    def add(self, rows: np.ndarray) -> None:
        """A row for each of the first lanes: a centred rank-one change."""
        k = len(rows)
        off = rows - self.mean[:k]
        share = np.sqrt(self.n[:k] / (self.n[:k] + 1))
        self.values[:k], self.vectors[:k] = rank_one(self.values[:k], self.vectors[:k], off * share[:, None])
        self.n[:k] += 1
        self.mean[:k] += off / self.n[:k, None]

    def combine(self, other: Spectra) -> None:
        """Take in lanes of ``other`` one for one: a change for each of its eigenvectors, and one for the means."""
        total = self.n + other.n
        for i in range(other.values.shape[1]):
            if (other.values[:, i] > 0).any():
                step = other.vectors[:, :, i] * np.sqrt(other.values[:, i])[:, None]
                self.values, self.vectors = rank_one(self.values, self.vectors, step)
        off = other.mean - self.mean
        with np.errstate(invalid="ignore"):
            share = np.where(total > 0, self.n * other.n / np.maximum(total, 1), 0)
        self.values, self.vectors = rank_one(self.values, self.vectors, off * np.sqrt(share)[:, None])
        self.mean = self.mean + off * (other.n / np.maximum(total, 1))[:, None]
        self.n = total

    def lanes(self, which: slice) -> Spectra:
        found = Spectra.__new__(Spectra)
        found.n, found.mean = self.n[which].copy(), self.mean[which].copy()
        found.values, found.vectors = self.values[which].copy(), self.vectors[which].copy()
        return found

    def merged(self) -> Spectra:
        """One lane out of all, in pairs."""
        held = self
        while len(held.n) > 1:
            count = len(held.n)
            pairs = count // 2
            first, second = held.lanes(slice(0, pairs)), held.lanes(slice(pairs, 2 * pairs))
            first.combine(second)
            if count % 2:
                odd = held.lanes(slice(count - 1, count))
                first = _stacked(first, odd)
            held = first
        return held

    def to_bytes(self) -> bytes:
        return np.concatenate([self.n, self.mean[0], self.values[0], self.vectors[0].ravel()]).tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, width: int) -> Spectra:
        flat, found = np.frombuffer(data).copy(), cls.__new__(cls)
        found.n, found.mean = flat[:1], flat[None, 1:1 + width]
        found.values, found.vectors = flat[None, 1 + width:1 + 2 * width], flat[1 + 2 * width:].reshape(1, width, width)
        return found


def _stacked(a: Spectra, b: Spectra) -> Spectra:
    found = Spectra.__new__(Spectra)
    for name in ("n", "mean", "values", "vectors"):
        setattr(found, name, np.concatenate([getattr(a, name), getattr(b, name)]))
    return found

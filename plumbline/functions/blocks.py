"""Numpy helpers that run inside tasks on one Arrow batch at a time."""

import numpy as np
import pyarrow as pa

TILE = 4096
QUERY_ROWS = 128
PAIRS = 1 << 18
FLOOR = 1e-30
WIDER = 2.0**20
CROWDED = 0.01


def matrix(column, width):
    """A list-of-float Arrow column as a (rows, width) matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def doubles(column, width):
    return matrix(column, width).astype(np.float64)


def limit_copies(ids, points, k):
    """Positions left after keeping the k lowest ids of each distinct point.

    Further copies lose every tie against those, so no top-k result changes.
    ``ids`` must be ascending.
    """
    row = np.dtype((np.void, points.shape[1] * points.itemsize))
    rows = np.ascontiguousarray(points).view(row).ravel()
    order = np.argsort(rows, kind="stable")
    start = np.ones(len(rows), dtype=bool)
    start[1:] = rows[order][1:] != rows[order][:-1]
    place = np.arange(len(rows))
    rank = place - np.maximum.accumulate(np.where(start, place, 0))
    return np.sort(order[rank < k])


def _exact(queries, points, qi, ti):
    """Squared distance of the listed pairs; NaN counts as infinitely far."""
    out = np.empty(len(qi))
    for s in range(0, len(qi), PAIRS):
        part = slice(s, s + PAIRS)
        gap = queries[qi[part]] - points[ti[part]]
        out[part] = np.einsum("ij,ij->i", gap, gap)
    out[np.isnan(out)] = np.inf
    return out


def _scale(table):
    """A power of two that brings all finite values within one."""
    top = np.abs(table, where=np.isfinite(table), out=np.zeros_like(table)).max(initial=0.0)
    return 2.0 ** -np.ceil(np.log2(top)) if top > 0 else 1.0


class Points:
    """Points to search in, by ascending id, with what every search needs of them."""

    def __init__(self, ids, labels, values):
        self.ids, self.labels, self.values = ids, labels, values
        self.scale = None

    @classmethod
    def shared(cls, broadcast, name="points"):
        """The points of a broadcast of plain arrays, made once in each worker.

        A class of this package does not travel in a broadcast: executors may not
        have the package. What is made here stays in the worker's copy.
        """
        held = broadcast.value
        if isinstance(held[name], tuple):
            held[name] = cls(*held[name])
        return held[name]

    def prepare(self, scale):
        """Scaled coordinates; once per worker unless far larger queries come."""
        if self.scale is not None and self.scale <= scale * WIDER:
            return
        self.exact = self.values.astype(np.float64)
        self.scale = min(scale * WIDER, _scale(self.exact))
        self.sides = {}
        with np.errstate(invalid="ignore", over="ignore", under="ignore"):
            scaled = self.exact * self.scale
            self.norms = np.einsum("ij,ij->i", scaled, scaled)

    def side(self, kind):
        """Right side of the product that gives lower bounds, in this precision."""
        if kind not in self.sides:
            scaled = self.exact * self.scale
            low = self.norms * (1 - slack(scaled, kind))
            columns = [scaled, low, np.ones_like(low)]
            self.sides[kind] = np.ascontiguousarray(np.column_stack(columns).T, dtype=kind)
        return self.sides[kind]


def slack(table, kind):
    """Relative rounding error of a matrix product over this width."""
    return 4 * (table.shape[1] + 8) * np.finfo(kind).eps


class _Bounds:
    """Bounds of the distances between some queries and tiles of points."""

    def __init__(self, queries, points, kind):
        self.points, self.kind, self.error = points, kind, slack(queries, kind)
        scaled = queries * points.scale
        self.own = np.einsum("ij,ij->i", scaled, scaled)
        columns = [-2.0 * scaled, np.ones_like(self.own), self.own * (1 - self.error) - FLOOR]
        self.rows = np.column_stack(columns).astype(kind)

    def candidates(self, t, k, kth):
        """Pairs that may be among the k nearest, given distances already found."""
        lower = self.rows @ self.points.side(self.kind)[:, t : t + TILE]
        if t == 0 and lower.shape[1] > k:
            span = self.own[:, None] + self.points.norms[None, :TILE]
            upper = lower + 2 * (self.error * span + FLOOR)
            upper[np.isnan(upper)] = np.inf
            bar = np.partition(upper, k - 1, axis=1)[:, k - 1]
        else:
            bar = kth * self.points.scale * self.points.scale * (1 + self.error)
        # Rounded up, so that the bar is not lowered by its precision.
        bar = np.nextafter(bar.astype(self.kind), self.kind(np.inf))
        found = np.flatnonzero(~(lower > bar[:, None]))
        crowded = len(found) > CROWDED * lower.size + k * len(lower)
        return *np.divmod(found, lower.shape[1]), crowded


def nearest(queries, points, k):
    """The k nearest points of every query: ``(squared distance, position)``.

    Both are (queries, k); ties go to the lower position and unused places hold
    position -1. One matrix product per tile gives bounds that hold for every
    distance despite its rounding, in single precision while that tells points
    apart and in double after; only pairs that the bounds cannot rule out are
    computed, in double.
    """
    distances = np.full((len(queries), k), np.inf)
    positions = np.full((len(queries), k), -1, dtype=np.int64)
    points.prepare(_scale(queries))
    exact = points.exact
    step = QUERY_ROWS * max(1, TILE // max(1, len(exact)))
    kind = np.float32
    with np.errstate(invalid="ignore", over="ignore", under="ignore"):
        for q in range(0, len(queries), step):
            part = queries[q : q + step]
            bounds = _Bounds(part, points, kind)
            best_d, best_p = distances[q : q + step], positions[q : q + step]
            for t in range(0, len(exact), TILE):
                qi, ti, crowded = bounds.candidates(t, k, best_d[:, -1])
                if crowded and kind is np.float32:
                    kind = np.float64
                    bounds = _Bounds(part, points, kind)
                    qi, ti, _ = bounds.candidates(t, k, best_d[:, -1])
                if len(qi):
                    _merge(best_d, best_p, qi, ti + t, _exact(part, exact, qi, ti + t))
    return distances, positions


def _merge(best_d, best_p, qi, ti, exact):
    """Fold candidate pairs into the running k best of every query."""
    rows, k = best_d.shape
    held_q, held_k = np.nonzero(best_p >= 0)
    q = np.concatenate([held_q, qi])
    d = np.concatenate([best_d[held_q, held_k], exact])
    p = np.concatenate([best_p[held_q, held_k], ti])
    order = np.lexsort((p, d, q))
    q, d, p = q[order], d[order], p[order]
    rank = np.arange(len(q)) - np.searchsorted(q, np.arange(rows))[q]
    keep = rank < k
    best_d[q[keep], rank[keep]] = d[keep]
    best_p[q[keep], rank[keep]] = p[keep]

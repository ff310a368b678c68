"""The block search against plain distances, without Spark."""

import numpy as np
import pytest

from plumbline.functions import blocks


def brute(queries, points, k):
    with np.errstate(invalid="ignore", over="ignore"):
        gaps = ((queries[:, None] - points[None]) ** 2).sum(axis=2)
    gaps[np.isnan(gaps)] = np.inf
    order = np.lexsort((np.broadcast_to(np.arange(len(points)), gaps.shape), gaps), axis=1)[:, :k]
    return np.take_along_axis(gaps, order, 1), order


def make(kind, rng, rows, width):
    x = rng.normal(size=(rows, width))
    if kind == "whole":
        x = rng.integers(0, 3, (rows, width)).astype(float)
    if kind == "offset":
        x += 1e6
    if kind == "clusters":
        x += 1000.0 * rng.integers(0, 20, (rows, 1))
    if kind == "tiny":
        x *= 1e-30
    if kind == "huge":
        x *= 1e30
    if kind == "mixed":
        x *= 10.0 ** rng.integers(-20, 20, (rows, 1))
    if kind == "nan":
        x[rng.integers(0, rows, 2)] = np.nan
    if kind == "infinite":
        x[rng.integers(0, rows, 2), 0] = np.inf
    return x


KINDS = ["spread", "whole", "offset", "clusters", "tiny", "huge", "mixed", "nan", "infinite"]


@pytest.mark.parametrize("kind", KINDS)
def test_nearest_matches_plain_distances(kind, monkeypatch):
    monkeypatch.setattr(blocks, "TILE", 50)
    monkeypatch.setattr(blocks, "QUERY_ROWS", 7)
    rng = np.random.default_rng(KINDS.index(kind))
    for _ in range(40):
        width, k = int(rng.integers(1, 20)), int(rng.integers(1, 9))
        points = make(kind, rng, int(rng.integers(2, 250)), width)
        queries = make(kind, rng, int(rng.integers(2, 30)), width)
        distances, positions = blocks.nearest(queries, blocks.Points(None, None, points), k)
        gaps, order = brute(queries, points, k)
        found = min(k, len(points))
        assert np.allclose(distances[:, :found], gaps, rtol=1e-12, atol=0)
        if kind in ("spread", "whole", "nan", "infinite"):
            assert (positions[:, :found] == order).all()
        assert (positions[:, found:] == -1).all()


def test_copies_beyond_k_change_nothing():
    rng = np.random.default_rng(9)
    points = rng.integers(0, 2, (300, 3)).astype(float)
    keep = blocks.limit_copies(np.arange(300), points, 4)
    assert len(keep) == 32
    _, order = brute(points[:20], points, 4)
    _, positions = blocks.nearest(points[:20], blocks.Points(None, None, points[keep]), 4)
    assert (keep[positions] == order).all()

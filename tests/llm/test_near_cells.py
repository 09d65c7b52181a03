"""Cells of pairs: looked at together they give the links and components that a loop over their rows gives."""

import numpy as np
import pytest

from vecframe.llm import near
from vecframe.llm.shingles import least_matches, signatures

LEAST = least_matches(0.8, 1e-8, [16, 32, 48, 64])


@pytest.fixture(scope="module")
def cells():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 7, 30)
    sets = []
    for size in sizes:
        base = rng.integers(0, 2**63, 100).astype(np.uint64)
        for _ in range(size):
            x, k = base.copy(), rng.integers(0, 16)
            x[:k] = rng.integers(0, 2**63, k).astype(np.uint64)
            sets.append(np.append(x, x[: rng.integers(0, 5)]))
    counts, hashes = np.array([len(x) for x in sets]), np.concatenate(sets)
    n = len(sets)
    side, mixed, copies = rng.integers(0, 2, n), np.repeat(rng.random(len(sizes)) < 0.3, sizes), rng.integers(1, 9, n)
    return np.append(0, np.cumsum(sizes)), sets, hashes, counts, signatures(hashes, counts, 4).view(np.uint16), side, mixed, copies


def by_loop(cells, counted):
    bounds, sets, _, _, values, side, mixed, copies = cells
    links, label = np.zeros(len(sets), np.int64), np.arange(len(sets))
    for start, end in zip(bounds, bounds[1:]):
        at = slice(start, end)
        links[at], own = near._verify_cell(sets[start:end], values[at], side[at], mixed[at], copies[at], LEAST, 0.8, counted)
        label[at] = start + own
    return links, label


def test_small_cells_together_equal_a_loop(cells, monkeypatch):
    monkeypatch.setattr(near, "ELEMENTS", 700)
    monkeypatch.setattr(near, "PAIRS", 20)
    bounds, _, hashes, counts, values, side, mixed, copies = cells
    links, linked = np.zeros(len(counts), np.int64), []
    for a, b in near._small_pairs(bounds, side, mixed):
        a, b = near._verify_pairs(*near._pairs_alike(values, a, b, LEAST), hashes, counts, 0.8)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        linked.append((a, b))
    wanted = by_loop(cells, True)
    assert links.sum() > 0 and (links == wanted[0]).all() and (near._labels(len(counts), linked) == wanted[1]).all()


def test_joined_rows_need_no_comparison(cells):
    assert (by_loop(cells, False)[1] == by_loop(cells, True)[1]).all()

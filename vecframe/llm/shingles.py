"""Hashes of words, shingles and MinHash signatures, computed for many texts at once with numpy."""

from __future__ import annotations

import functools

import numpy as np

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bins of one hash round; a signature has ``rounds * BINS`` values of 16 bits, four to a band.
BINS = 16
EMPTY = np.uint32(0xFFFFFFFF)
PIECE = 1 << 20


def random_odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * U64(2) + U64(1)


BYTE = random_odd(256, 11)
BASE = int(random_odd(1, 12)[0])
PLACES = random_odd(64, 13)
ROUNDS = random_odd(64, 14)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    # In two arrays: memory that is new to the process costs more than the arithmetic.
    out, part = x >> U64(30), np.empty_like(x)
    out ^= x
    out *= U64(0xBF58476D1CE4E5B9)
    out ^= np.right_shift(out, U64(27), out=part)
    out *= U64(0x94D049BB133111EB)
    out ^= np.right_shift(out, U64(31), out=part)
    return out


@functools.lru_cache(maxsize=2)
def _powers_of(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, BASE, U64), np.full(size, pow(BASE, -1, 2**64), U64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers_of(max(1 << 18, 1 << (n - 1).bit_length()))


def word_spans(data: np.ndarray, bounds: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes) and text number of each word: runs of bytes other than those ``between``, by default space and 09 to 0D."""
    n = len(data)
    solid = ~between[data]
    new = np.zeros(n + 1, bool)
    new[bounds] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | new[1:n]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | new[1:n]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(bounds, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; spans are in order. Works through about PIECE bytes at a time, a long span whole."""
    out, at = [np.zeros(0, U64)], 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, "right")))
        first, last = starts[at], ends[to - 1]
        out.append(_hash_piece(data[first:last], starts[at:to] - first, ends[at:to] - first))
        at = to
    return np.concatenate(out)


def _hash_piece(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _powers(len(data))
    terms = BYTE[data] * up[: len(data)]
    sums = np.cumsum(terms, dtype=U64)
    return mix((sums[ends - 1] - sums[starts] + terms[starts]) * down[starts] + (ends - starts).astype(U64))


def shingle(units: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` units, and how many each text has.

    ``counts`` are the units of each text, in order. A text with fewer units has one shingle of all
    of them, a text with none has none.
    """
    sums, part = units * PLACES[0], np.empty_like(units)
    for k in range(1, size):
        sums[:-k] += np.multiply(units[k:], PLACES[k], out=part[:-k])
    ends = np.cumsum(counts)
    valid = np.ones(len(units), bool)
    tails = (ends[:, None] - 1 - np.arange(size - 1))[counts[:, None] > np.arange(size - 1)]
    valid[tails] = False
    for text in np.flatnonzero((counts > 0) & (counts < size)):
        at = ends[text] - counts[text]
        sums[at] = (units[at : ends[text]] * PLACES[: counts[text]]).sum(dtype=U64) + U64(counts[text])
        valid[at] = True
    return mix(sums[valid]), np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)


def word_shingles(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, text = word_spans(data, bounds)
    return shingle(span_hashes(data, starts, ends), np.bincount(text, minlength=len(bounds) - 1), size)


def char_shingles(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    firsts = np.searchsorted(np.flatnonzero((data & 0xC0) != 0x80), bounds)
    return shingle(np.add(codes, U64(1), dtype=U64), np.diff(firsts), size)


def signatures(hashes: np.ndarray, counts: np.ndarray, rounds: int) -> np.ndarray:
    """MinHash signatures as int64 of shape (texts, rounds // 4 * BINS); texts without shingles get zeros.

    Each round is a one-permutation hash with BINS bins. An empty bin takes the value of the first
    filled one in a random order fixed per bin, so equal sets fill alike. A long packs, for one bin, the
    16-bit values of four rounds: it is the key of a band, and the values for comparing.
    """
    texts = len(counts)
    owner = np.repeat(np.arange(texts, dtype=np.int64) * BINS, counts)
    low = np.full((rounds, texts * BINS), EMPTY)
    x, at, value = np.empty_like(hashes), np.empty(len(hashes), np.int64), np.empty(len(hashes), np.uint32)
    for r in range(rounds):
        np.multiply(hashes, ROUNDS[r], out=x)
        np.right_shift(x, U64(60), out=at.view(U64))
        at += owner
        x >>= U64(24)
        value[:] = x
        np.minimum.at(low[r], at, value)
    out = (_fill(low) & np.uint32(0xFFFF)).astype(np.uint16).reshape(rounds // 4, 4, texts, BINS).transpose(2, 0, 3, 1)
    out = np.ascontiguousarray(out)
    out[counts == 0] = 0
    return out.view(np.int64).reshape(texts, rounds // 4 * BINS)


@functools.lru_cache(maxsize=64)
def _donors(round_: int) -> np.ndarray:
    rng = np.random.default_rng(1000 + round_)
    return np.stack([rng.permutation([b for b in range(BINS) if b != own]) for own in range(BINS)])


def _fill(low: np.ndarray) -> np.ndarray:
    """Each row holds the bins of all texts in one round; empty ones take their donors' values, in all rounds together."""
    rounds, wide = low.shape
    donors = np.stack([_donors(r) for r in range(rounds)]).reshape(rounds * BINS, BINS - 1)
    low = low.ravel()
    empty, out = low == EMPTY, low.copy()
    at = np.flatnonzero(empty)
    first, own = at - at % BINS, at // wide * BINS + at % BINS
    for k in range(BINS - 1):
        if not len(at):
            break
        donor = first + donors[own, k]
        out[at] = low[donor]
        left = empty[donor]
        at, first, own = at[left], first[left], own[left]
    return out


def least_matches(threshold: float, tolerance: float, steps: list[int]) -> list[int]:
    """For each number of compared values, the fewest equal ones a pair needs to be kept.

    With a uniform prior, similarity after k of n equal values is Beta(k + 1, n - k + 1), so the
    chance that it is at least t is that of at most k successes in n + 1 draws of chance t.
    """
    from math import comb

    out = []
    for n in steps:
        chance, k = 0.0, -1
        while chance < tolerance:
            k += 1
            chance += comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k)
        out.append(k)
    return out

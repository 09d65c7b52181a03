"""Blocked top-k inside one task: batches of corpus rows against a set of queries.

A float32 matrix product bounds every score; only pairs whose bound can still reach a query's
current k-th place are scored again in float64. The result is exact, it does not depend on how
rows were batched, and memory stays at ``queries x k`` plus one tile, however many rows pass.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

COSINE, DOT, EUCLIDEAN = 0, 1, 2
METRIC_CODES = {"cosine": COSINE, "dot_product": DOT, "euclidean": EUCLIDEAN}
TILE_CELLS = 2_000_000
# Rough scores below this cannot have overflowed.
SAFE_SCORE = 1e37
BUFFER_ROWS = 400_000
UNCONSTRAINED = -2


def to_matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Arrow list column to a float32 matrix; ragged rows and null elements are errors."""
    lengths = np.diff(vectors.offsets.to_numpy())
    if (lengths != dim).any():
        found = int(lengths[lengths != dim][0])
        raise ValueError(f"vector of dimension {found} where {dim} is expected")
    flat = vectors.flatten()
    if flat.null_count:
        raise ValueError("vector with a null element")
    return flat.to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(-1, dim)


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


def _norms(m: np.ndarray) -> np.ndarray:
    wide = m.astype(np.float64)
    return np.sqrt(_dots(wide, wide))


def exact_goodness(q: np.ndarray, x: np.ndarray, metric: int) -> np.ndarray:
    """Float64 scores of aligned rows, turned so that larger is better."""
    q, x = q.astype(np.float64), x.astype(np.float64)
    if metric == EUCLIDEAN:
        gap = q - x
        return -np.sqrt(_dots(gap, gap))
    dot = _dots(q, x)
    if metric == DOT:
        return dot
    scale = np.sqrt(_dots(q, q)) * np.sqrt(_dots(x, x))
    return np.divide(dot, scale, out=np.zeros_like(dot), where=scale != 0)


class TopK:
    """Best k corpus rows of each query, over any number of ``add`` calls.

    ``queries`` is a table with columns ``qid, qvec, qk, qfloor, qmetric`` (floor in "larger is
    better" terms, null for none), ``f_<name>`` per filter column and, for cell search, ``qcells``.
    With ``whole``, the dimension and metric of a second vector ``qwhole``, every kept row also gets its exact score by that one.
    """

    def __init__(self, queries: pa.Table, dim: int, whole: tuple[int, int] | None = None):
        queries = queries.combine_chunks()
        column = lambda name: _one_array(queries.column(name))
        self.ids = column("qid")
        self.dim = dim
        self.q = to_matrix(column("qvec"), dim)
        self.k = column("qk").to_numpy(zero_copy_only=False).astype(np.int64)
        floors = column("qfloor").to_numpy(zero_copy_only=False).astype(np.float64)
        self.floor = np.where(np.isnan(floors), -np.inf, floors)
        self.metric = column("qmetric").to_numpy(zero_copy_only=False).astype(np.int64)
        self.q_norm = _norms(self.q)
        self.whole = whole
        if whole is not None:
            self.q_whole = to_matrix(column("qwhole"), whole[0])
        self.unit_q = np.divide(
            self.q, self.q_norm[:, None], out=np.zeros(self.q.shape), where=self.q_norm[:, None] != 0
        ).astype(np.float32)
        self.filters = {}
        for name in queries.column_names:
            if name.startswith("f_"):
                wanted = column(name)
                values = pc.unique(wanted.drop_null())
                codes = pc.fill_null(pc.index_in(wanted, value_set=values), UNCONSTRAINED)
                self.filters[name] = (values, codes.to_numpy(zero_copy_only=False).astype(np.int64))
        if self.filters:
            _, codes = next(iter(self.filters.values()))
            self.unfiltered = np.flatnonzero(codes == UNCONSTRAINED)
            filtered = np.flatnonzero(codes != UNCONSTRAINED)
            self.wanting = _grouped(codes[filtered], filtered)
        self.probes = None
        if "qcells" in queries.column_names:
            cells = column("qcells")
            owner = np.repeat(np.arange(len(cells)), np.diff(cells.offsets.to_numpy()))
            self.probes = _grouped(cells.flatten().to_numpy(zero_copy_only=False), owner)
        n = len(self.ids)
        self.kth = np.full(n, -np.inf)
        self.found = np.zeros(n, dtype=np.int64)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.buffered = 0
        self.kept = 0

    def add(self, keys: pa.Array, vectors: pa.Array, filters: dict[str, pa.Array], cells=None, wholes: pa.Array | None = None) -> None:
        if keys.null_count:
            raise ValueError("a row without a key cannot be searched")
        if len(self.ids) == 0 or len(keys) == 0:
            return
        x = to_matrix(vectors, self.dim)
        key_values = keys.to_numpy(zero_copy_only=False)
        if self.whole is not None:
            # The place of a row stands for its key until the batch is done, so that the second vector is found.
            self.x_whole, self.x_keys = to_matrix(wholes, self.whole[0]), key_values
            key_values = np.arange(len(keys))
        codes = {}
        for name, (values, _) in self.filters.items():
            found = pc.index_in(filters[name].cast(values.type), value_set=values)
            codes[name] = pc.fill_null(found, -1).to_numpy(zero_copy_only=False)
        if self.probes is not None:
            self._add_groups(self.probes, cells, key_values, x, codes)
        elif codes:
            # Rows meet only the queries that want their value of the first filter.
            name = next(iter(codes))
            self._add_groups(self.wanting, codes[name], key_values, x, codes)
            if len(self.unfiltered):
                self._add_block(self.unfiltered, key_values, x, codes)
        else:
            self._add_block(np.arange(len(self.ids)), key_values, x, codes)
        # Sorting only once the buffer has doubled keeps its cost in proportion to the rows kept.
        if self.buffered > 2 * self.kept + 1000:
            self._compact()

    def _add_groups(self, asking_by_group, groups, keys, x, codes) -> None:
        """One block per group of rows that some queries ask for."""
        order = np.argsort(groups, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(groups[order]) != 0])
        for start, stop in zip(starts, np.r_[starts[1:], len(order)]):
            rows = order[start:stop]
            asking = asking_by_group.get(int(groups[rows[0]]))
            if asking is not None:
                self._add_block(asking, keys[rows], x[rows], {name: c[rows] for name, c in codes.items()})

    def _add_block(self, asking, keys, x, codes) -> None:
        x_norm = _norms(x)
        finite = x_norm[np.isfinite(x_norm)]
        longest = finite.max() if len(finite) else 0.0
        for metric in (COSINE, DOT, EUCLIDEAN):
            of_metric = asking[self.metric[asking] == metric]
            if not len(of_metric):
                continue
            right = x
            if metric == COSINE:
                out = np.zeros(x.shape)
                with np.errstate(invalid="ignore"):
                    right = np.divide(x, x_norm[:, None], out=out, where=x_norm[:, None] != 0).astype(np.float32)
            widest = self.q_norm[of_metric].max()
            safe = len(finite) == len(x) and (widest + longest) ** 2 < SAFE_SCORE
            step = max(1, TILE_CELLS // len(x))
            for at in range(0, len(of_metric), step):
                self._add_tile(of_metric[at : at + step], metric, keys, x, right, x_norm, longest, codes, safe)

    def _bounds(self, qs, metric, right, x_norm, longest):
        """Scores in a monotone form, and how far from the true value each query's may be."""
        if metric == COSINE:
            rough, reach = self.unit_q[qs] @ right.T, np.ones(len(qs))
        else:
            rough = self.q[qs] @ right.T
            reach = self.q_norm[qs] * longest
            if metric == EUCLIDEAN:
                half_q = self.q_norm[qs] ** 2 / 2
                rough -= (x_norm**2 / 2).astype(np.float32)[None, :]
                rough -= half_q.astype(np.float32)[:, None]
                reach = reach + half_q + longest**2 / 2
        return rough, reach * (self.dim + 16) * 2.0**-22 + 1e-30

    def _add_tile(self, qs, metric, keys, x, right, x_norm, longest, codes, safe) -> None:
        with np.errstate(over="ignore", invalid="ignore"):
            rough, slack = self._bounds(qs, metric, right, x_norm, longest)
            bar = np.maximum(self.kth[qs], self.floor[qs])
            if metric == EUCLIDEAN:
                bar = np.where(np.isneginf(bar), bar, -(bar**2) / 2)
            unsure = None if safe else ~np.isfinite(rough)
        allowed = None
        for name, row_codes in codes.items():
            wanted = self.filters[name][1][qs]
            same = (wanted[:, None] == row_codes[None, :]) | (wanted == UNCONSTRAINED)[:, None]
            allowed = same if allowed is None else allowed & same
        settled = rough
        if unsure is not None:
            drop = unsure if allowed is None else unsure | ~allowed
            settled = np.where(drop, np.float32(-np.inf), rough)
        elif allowed is not None:
            settled = np.where(allowed, rough, np.float32(-np.inf))
        k_max = int(self.k[qs].max())
        # A k-th place found among few rows is a poor bar for many, so a wide block gives its own.
        if settled.shape[1] > 16 * k_max or settled.shape[1] > k_max and (self.found[qs] < self.k[qs]).any():
            bar = np.maximum(bar, _kth_or_less(settled, k_max).astype(np.float64) - slack)
        hopeful = settled >= _at_most(bar - slack)[:, None]
        if unsure is not None:
            hopeful &= ~np.isneginf(settled)
            hopeful |= unsure
        if allowed is not None:
            hopeful &= allowed
        at_q, at_x = np.divmod(np.flatnonzero(hopeful.reshape(-1)), hopeful.shape[1])
        self._score(qs[at_q], keys, x, at_x, metric)

    def _score(self, q_rows, keys, x, x_rows, metric) -> None:
        """Exact scores of aligned (query, row) pairs; those that can still rank are kept."""
        step = max(1, 4_000_000 // self.dim)
        for at in range(0, len(q_rows), step):
            q_part, x_part = q_rows[at : at + step], x_rows[at : at + step]
            with np.errstate(over="ignore", invalid="ignore"):
                good = exact_goodness(self.q[q_part], x[x_part], metric)
                # Scores equal to the k-th still compete: the key decides.
                keep = (good >= self.floor[q_part]) & (good >= self.kth[q_part]) & ~np.isnan(good)
                part = (q_part[keep], good[keep], keys[x_part[keep]])
                if self.whole is not None:
                    places = part[2]
                    part = (*part[:2], self.x_keys[places], exact_goodness(self.q_whole[part[0]], self.x_whole[places], self.whole[1]))
            self.parts.append(part)
            self.buffered += int(keep.sum())
            if self.buffered > BUFFER_ROWS + 2 * self.kept:
                self._compact()

    def add_pairs(self, keys: pa.Array, vectors: pa.Array, asking: pa.Array) -> None:
        """Rows that each name the ids of the queries to score them for."""
        x = to_matrix(vectors, self.dim)
        key_values = keys.to_numpy(zero_copy_only=False)
        x_rows = np.repeat(np.arange(len(keys)), np.diff(asking.offsets.to_numpy()))
        q_rows = pc.index_in(asking.flatten(), value_set=self.ids).to_numpy(zero_copy_only=False).astype(np.int64)
        for metric in (COSINE, DOT, EUCLIDEAN):
            of_metric = self.metric[q_rows] == metric
            self._score(q_rows[of_metric], key_values, x, x_rows[of_metric], metric)
        if self.buffered > 2 * self.kept + 1000:
            self._compact()

    def _compact(self) -> None:
        if not self.parts:
            return
        columns = [np.concatenate(column) for column in zip(*self.parts)]
        table = pd.DataFrame(dict(zip(["q", "good", "key", "whole"], columns)))
        table = table.sort_values(["q", "good", "key"], ascending=[True, False, True], kind="stable")
        place = table.groupby("q").cumcount().to_numpy()
        table = table[place < self.k[table["q"].to_numpy()]]
        q = table["q"].to_numpy()
        self.found = np.bincount(q, minlength=len(self.ids))
        last = table.groupby("q")["good"].min()
        full = self.found[last.index] >= self.k[last.index]
        self.kth[last.index[full]] = last.to_numpy()[full]
        self.parts = [(q, *(table[name].to_numpy() for name in table.columns[1:]))]
        self.kept = self.buffered = len(table)

    def result(self, key_type: pa.DataType) -> pa.RecordBatch:
        """Columns ``query_id, key, goodness, qk, qmetric`` of the best rows seen, and ``whole``, the score by the second vector."""
        self._compact()
        if self.parts:
            q, good, keys, *whole = self.parts[0]
        else:
            q, good, keys, whole = np.array([], dtype=np.int64), np.array([]), [], [np.array([])]
        columns = {
            "query_id": self.ids.take(pa.array(q, type=pa.int64())),
            "key": pa.array(keys, type=key_type),
            "goodness": pa.array(good, type=pa.float64()),
            "qk": pa.array(self.k[q], type=pa.int32()),
            "qmetric": pa.array(self.metric[q], type=pa.int32()),
        }
        if self.whole is not None:
            columns["whole"] = pa.array(whole[0], type=pa.float64())
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _kth_or_less(scores: np.ndarray, k: int) -> np.ndarray:
    """A value per row that at least ``k`` of its scores reach, the k-th best or a little less.

    The k-th best of the maxima of disjoint groups of columns is one, and much cheaper than that of all columns.
    """
    n, width = scores.shape
    deep = min(width // (8 * k), 64)
    if deep > 1:
        scores = scores[:, : width // deep * deep].reshape(n, deep, -1).max(axis=1)
    return np.partition(scores, -k, axis=1)[:, -k]


def _at_most(values: np.ndarray) -> np.ndarray:
    """Doubles as floats that are not larger."""
    with np.errstate(over="ignore"):
        floats = values.astype(np.float32)
    return np.where(floats > values, np.nextafter(floats, np.float32(-np.inf)), floats)


def _one_array(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], type=column.type)
    return column


def _grouped(groups: np.ndarray, members: np.ndarray) -> dict[int, np.ndarray]:
    order = np.argsort(groups, kind="stable")
    found, starts = np.unique(groups[order], return_index=True)
    return dict(zip(found.tolist(), np.split(members[order], starts[1:])))

"""Task-side arithmetic for rows that hold several vectors each."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from vicinal.functions.scores import score_array
from vicinal.operators.blocks import METRIC_OF_SPACE, as_matrix, combined


def rows_and_cuts(column):
    """Inner vectors of an array-of-vectors column as one matrix, with the row each belongs to.
    Null and empty inner vectors are skipped."""
    arr = combined(column)
    inner = arr.flatten()
    owner = np.repeat(np.arange(len(arr)), np.nan_to_num(np.asarray(
        arr.value_lengths().to_numpy(zero_copy_only=False), dtype=float)).astype(int))
    lengths = np.nan_to_num(inner.value_lengths().to_numpy(zero_copy_only=False).astype(float))
    real = lengths > 0
    if not real.all():
        inner, owner = inner.filter(pa.array(real)), owner[real]
    return as_matrix(inner), owner


def token_scores(a: np.ndarray, b: np.ndarray, metric: str, space: str) -> np.ndarray:
    a, b = a.astype(np.float64), b.astype(np.float64)
    if metric == "l2":
        # Centring first keeps the expanded form accurate for vectors far from the origin.
        mid = a.mean(axis=0)
        a, b = a - mid, b - mid
        raw = np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0.0)
    else:
        if metric == "cos":
            a, b = (m / np.where((n := np.sqrt((m * m).sum(1))) > 0, n, 1.0)[:, None] for m in (a, b))
        raw = -(a @ b.T)
        if metric == "cos":
            raw += 1.0
    return score_array(raw, space)


def _by_tokens(batches, vec: str, most: int):
    """The batches cut so that a piece holds about ``most`` inner vectors."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(combined(batch.column(vec)).value_lengths().to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def compare_token_sets(scan, q_table: pa.Table, batches, hits) -> None:
    """Task side of ``late_interaction_join``: all token pairs of a batch in blocks, reduced to one score per pair
    of rows before anything is kept."""
    metric = METRIC_OF_SPACE[scan.space]
    q_rows, q_owner = rows_and_cuts(q_table.column(scan.query_vec))
    n_q = q_table.num_rows
    if len(np.unique(q_owner)) < n_q:
        raise ValueError("query vectors must not be empty")
    starts = np.searchsorted(q_owner, np.arange(n_q))
    ends = np.append(starts[1:], len(q_rows))
    for batch in _by_tokens(batches, scan.vec, 20_000):
        d_rows, d_owner = rows_and_cuts(batch.column(scan.vec))
        d_starts = np.searchsorted(d_owner, np.arange(batch.num_rows))
        table = pa.table({c: batch.column(c) for c in dict.fromkeys([*scan.columns, *scan.order])})
        at = 0
        while at < n_q:
            # As many whole queries as keep the token block small.
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + max(1, 2_000_000 // len(d_rows)), "right")))
            block = token_scores(q_rows[starts[at]:ends[stop - 1]], d_rows, metric, scan.space)
            best = np.maximum.reduceat(block, d_starts, axis=1)
            total = -np.add.reduceat(best, starts[at:stop] - starts[at], axis=0)
            bound = hits.tau[at:stop]
            if total.shape[1] > hits.k:
                bound = np.minimum(bound, np.partition(total, hits.k - 1, axis=1)[:, hits.k - 1])
            qi, ci = np.nonzero(total <= bound[:, None])
            hits.push(qi + at, total[qi, ci], table.take(pa.array(ci)))
            at = stop

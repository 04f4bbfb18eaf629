"""Task-side block arithmetic: one Arrow batch of corpus rows against one block of query rows.

The candidate test uses a float32 matrix product with a proven error bound, so it can only let too many
pairs through, never too few. The pairs let through get their distance again in double by the plain formula,
and only that distance is ranked or compared with a radius.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CELLS = 4_000_000  # query x corpus cells held at once
STRIP = 250_000    # and those of a product that is only compared
GEMM = ("l2", "ip", "cos", "ip_gap")
METRIC_OF_SPACE = {"l2": "l2", "l1": "l1", "linf": "linf", "cosinesimil": "cos", "innerproduct": "ip",
                   "hamming": "hamming"}


def combined(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    return column


def as_matrix(column) -> np.ndarray:
    """(rows, dim) view of a list column; every row must have the same length and no null inside."""
    arr = combined(column)
    n = len(arr)
    if n == 0:
        return np.zeros((0, 0), np.float32)
    if arr.null_count:
        raise ValueError("a null vector reached the distance step")
    flat = arr.flatten()
    dim = len(flat) // n
    if flat.null_count or dim * n != len(flat) or not np.all(np.diff(arr.offsets.to_numpy()) == dim):
        raise ValueError("vectors must all have the same length and no null element")
    return flat.to_numpy(zero_copy_only=False).reshape(n, dim)


def as_bytes(column) -> np.ndarray:
    """(rows, bytes) view of a binary column of equally long codes."""
    arr = combined(column)
    n = len(arr)
    if n == 0:
        return np.zeros((0, 0), np.uint8)
    if pa.types.is_list(arr.type) or pa.types.is_large_list(arr.type):
        return as_matrix(arr).astype(np.int8).view(np.uint8)
    if arr.null_count:
        raise ValueError("a null code reached the distance step")
    if pa.types.is_large_binary(arr.type):
        arr = arr.cast(pa.binary())
    offsets = np.frombuffer(arr.buffers()[1], np.int32)[arr.offset:arr.offset + n + 1]
    width = int(offsets[1] - offsets[0])
    if not np.all(np.diff(offsets) == width):
        raise ValueError("codes must all have the same length")
    data = np.frombuffer(arr.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if width else np.zeros(0, np.uint8)
    return data.reshape(n, width)


def pack_vectors(column) -> pa.Array:
    """A list column of float or double vectors as their bytes, which are copied whole wherever rows are moved; checked as by ``as_matrix``."""
    rows = as_matrix(column)
    return binary_array(np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1) if rows.size else np.zeros((len(column), 0), np.uint8))


def unpack_vectors(column, kind: str) -> np.ndarray:
    return as_bytes(column).view(kind)


def binary_array(rows: np.ndarray) -> pa.Array:
    """Binary column from a (rows, bytes) array."""
    rows = np.ascontiguousarray(rows, np.uint8)
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(rows.tobytes())])


def list_array(rows: np.ndarray, kind=None) -> pa.Array:
    n, dim = rows.shape
    values = pa.array(np.ascontiguousarray(rows).reshape(-1), type=kind)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dim), values)


def where_valid(values: pa.Array, kind: pa.DataType, f) -> pa.Array:
    """``f`` of the values that are there; null for the others."""
    there = values.drop_null()
    if not len(there):
        return pa.nulls(len(values), kind)
    out = f(there)
    valid = values.is_valid().to_numpy(zero_copy_only=False)
    return out if valid.all() else out.take(pa.array(np.cumsum(valid) - 1, mask=~valid))


def to_words(codes: np.ndarray) -> np.ndarray:
    """Packed bytes as 64-bit words, zero-filled at the end."""
    n, width = codes.shape
    pad = -width % 8
    if pad:
        codes = np.concatenate([codes, np.zeros((n, pad), np.uint8)], axis=1)
    return np.ascontiguousarray(codes).view(np.uint64)


class Prepared:
    """One side of the comparison with what the metric needs computed once."""

    def __init__(self, metric: str, rows: np.ndarray):
        self.metric = metric
        self.n = len(rows)
        self.side = {}
        self.width = rows.shape[1] if rows.ndim == 2 else 0
        if metric == "hamming":
            self.rows = to_words(rows.view(np.uint8) if rows.dtype == np.int8 else rows)
            return
        self.rows = rows
        if metric not in GEMM:
            self.rows = rows.astype(np.float64)
            size = np.abs(self.rows)
            self.norm2 = size.sum(axis=1) if metric == "l1" else size.max(axis=1) if size.size else np.zeros(len(rows))
            self.fast = not size.size or size.max() < 1e30
            self.wide = self.rows
            self.narrow = self.rows.astype(np.float32) if self.fast else None
            return
        wide = rows.astype(np.float64)
        self.norm2 = np.einsum("ij,ij->i", wide, wide)
        if metric == "cos":
            norm = np.sqrt(self.norm2)
            wide = wide / np.where(norm > 0, norm, 1.0)[:, None]
        top = np.abs(wide).max() if wide.size else 0.0
        # Outside this range float32 products overflow or lose their relative precision.
        self.fast = top < 1e15 and (top == 0.0 or top > 1e-12)
        self.wide = wide
        self.narrow = wide.astype(np.float32) if self.fast else None

    def _part(self, at) -> "Prepared":
        part = object.__new__(Prepared)
        part.metric, part.width = self.metric, self.width
        part.rows = self.rows[at]
        part.n = len(part.rows)
        if self.metric != "hamming":
            part.norm2, part.wide, part.fast = self.norm2[at], self.wide[at], self.fast
            part.narrow = self.narrow[at] if self.fast else None
        if self.metric in GEMM and self.fast:
            part.side = {"query": self.factor("query", True)[at]}
        return part

    def take(self, start: int, stop: int) -> "Prepared":
        return self._part(slice(start, stop))

    def pick(self, index: np.ndarray) -> "Prepared":
        return self._part(index)

    def factor(self, side: str, fast: bool) -> np.ndarray:
        """This side's factor of the matrix product that gives the lower bounds outright.

        Two further columns carry each side's own term (and a 1 for the other's), so no pass over the product is needed.
        """
        if fast and side in self.side:
            return self.side[side]
        rows = self.narrow if fast else self.wide
        g = slack(self.width, fast)
        one = np.ones(self.n)
        if self.metric == "l2":
            own, scale = (1 - g) * self.norm2, -2
        elif self.metric == "cos":
            own, scale = np.full(self.n, (1 - g) / 2), -1
        else:
            own, scale = (0.5 if self.metric == "ip_gap" else 0.0) * (1 - g) - g * self.norm2, -1
        extra = [own, one] if side == "query" else [one, own]
        out = np.empty((self.n, self.width + 2), rows.dtype)
        out[:, :-2] = rows * rows.dtype.type(scale) if side == "query" else rows
        out[:, -2], out[:, -1] = extra
        if fast:
            self.side[side] = out
        return out


def slack(dim: int, fast: bool) -> float:
    """Relative error allowed for a product over ``dim`` columns, including the rounding of its inputs."""
    return (dim + 32) * (2.0 ** -22 if fast else 2.0 ** -50)


def lower_bounds(q: Prepared, c: Prepared):
    """``low``, ``eq``, ``ec`` with  low <= raw <= low + eq[:, None] + ec[None, :]."""
    metric = q.metric
    if q.width != c.width:
        raise ValueError(f"vector lengths differ: {q.width} and {c.width}")
    if metric == "hamming":
        low = np.zeros((q.n, c.n), np.float32)
        words = np.ascontiguousarray(c.rows.T)
        strip = max(1, 80_000 // max(1, c.n))
        differ, count = np.empty((strip, c.n), np.uint64), np.empty((strip, c.n), np.uint8)
        for s in range(0, q.n, strip):
            mine, total = q.rows[s:s + strip], low[s:s + strip]
            for w in range(len(words)):
                np.bitwise_xor(mine[:, w, None], words[w][None], out=differ[:len(mine)])
                total += np.bitwise_count(differ[:len(mine)], out=count[:len(mine)])
        return low, np.zeros(q.n), np.zeros(c.n)
    if metric in ("l1", "linf"):
        return _by_dimension(q, c)
    fast = q.fast and c.fast
    g = slack(q.width, fast)
    low = q.factor("query", fast) @ c.factor("corpus", fast).T
    if metric == "cos":
        return low, np.full(q.n, 4 * g), np.zeros(c.n)
    return low, 4 * g * q.norm2 + (4 * g if metric == "ip_gap" else 0.0), 4 * g * c.norm2


def _by_dimension(q: Prepared, c: Prepared):
    """Bounds for the metrics without a matrix product: one dimension at a time over strips that stay in cache, on a grid of 16-bit numbers
    where one is fine enough.

    The float32 error of a sum (or maximum) of differences is at most a multiple of the two rows' sizes.
    """
    fast = q.fast and c.fast
    grid = _grid(q, c) if fast else None
    if grid is not None:
        return _on_grid(q, c, *grid)
    a, b = (q.narrow, c.narrow) if fast else (q.wide, c.wide)
    low = np.empty((q.n, c.n), a.dtype)
    columns = np.ascontiguousarray(b.T)
    merge = np.add if q.metric == "l1" else np.maximum
    strip = max(1, 160_000 // max(1, c.n))
    gap = np.empty((strip, c.n), a.dtype)
    for s in range(0, q.n, strip):
        mine = a[s:s + strip]
        total, step = low[s:s + strip], gap[:len(mine)]
        np.abs(np.subtract(mine[:, 0, None], columns[0][None], out=total), out=total)
        for j in range(1, a.shape[1]):
            np.abs(np.subtract(mine[:, j, None], columns[j][None], out=step), out=step)
            merge(total, step, out=total)
    g = (a.shape[1] + 8) * (2.0 ** -23 if fast else 2.0 ** -51)
    low -= (g * q.norm2).astype(a.dtype)[:, None]
    low -= (g * c.norm2).astype(a.dtype)[None, :]
    return low, 3 * g * q.norm2, 3 * g * c.norm2


def _grid(q: Prepared, c: Prepared):
    """(center, cells a unit, corpus cells by dimension) of a grid on which sums (or maxima) of differences fit 16 bits. None where its cells
    are not small beside the rows, as with very many dimensions or outliers."""
    most = 32_767 // q.width if q.metric == "l1" else 32_767
    if most < 256 or not q.n or not c.n:
        return None
    center, reach, size, unit, cells = c.side.get("grid") or (None,) * 5
    if center is None:
        center = np.median(c.wide, axis=0)
        far = np.abs(c.wide - center)
        reach, size = far.max(), np.median(far.sum(axis=1) if q.metric == "l1" else far.max(axis=1))
    need = max(reach, np.abs(q.wide - center).max())
    if unit is None or need > reach:
        reach = need
        unit = (most - 1) / (2 * reach) if reach > 0 else 0.0
        cells = np.ascontiguousarray(np.rint((c.wide - center) * unit).astype(np.int16).T)
        c.side["grid"] = center, reach, size, unit, cells
    error = (q.width if q.metric == "l1" else 1) / unit if unit else np.inf
    # Far from the origin, rounding of the differences to the center would count as well.
    exact = max(q.norm2.max(), c.norm2.max()) * 2.0 ** -50 * unit < 1e-3
    return (center, unit, cells) if exact and error <= 0.05 * size else None


def _on_grid(q: Prepared, c: Prepared, center: np.ndarray, unit: float, cells: np.ndarray):
    """Either row of a pair lies within half a cell of its grid point in each dimension."""
    a = np.rint((q.wide - center) * unit).astype(np.int16)
    merge = np.add if q.metric == "l1" else np.maximum
    error = (1.01 * q.width if q.metric == "l1" else 1.01) / unit
    low = np.empty((q.n, c.n), np.float32)
    strip = max(1, 160_000 // max(1, c.n))
    total, gap = np.empty((strip, c.n), np.int16), np.empty((strip, c.n), np.int16)
    for s in range(0, q.n, strip):
        mine = a[s:s + strip]
        sums, step = total[:len(mine)], gap[:len(mine)]
        np.abs(np.subtract(mine[:, 0, None], cells[0][None], out=sums), out=sums)
        for j in range(1, q.width):
            np.abs(np.subtract(mine[:, j, None], cells[j][None], out=step), out=step)
            merge(sums, step, out=sums)
        np.multiply(sums, np.float32(1 / unit), out=low[s:s + strip])
    low -= np.float32(error)
    return low, np.full(q.n, 2 * error), np.zeros(c.n)


def exact_pairs(q: Prepared, c: Prepared, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """Raw distance of the listed pairs, in double."""
    out = np.empty(len(qi))
    step = max(1, 100_000 // max(1, c.rows.shape[1]))  # numbers that stay in cache
    for s in range(0, len(qi), step):
        a, b = q.rows[qi[s:s + step]], c.rows[ci[s:s + step]]
        out[s:s + step] = pair_distance(q.metric, a, b)
    return out


def pair_distance(metric: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-by-row raw distance of two equally shaped arrays."""
    if metric == "hamming":
        return np.bitwise_count(a ^ b).sum(axis=1).astype(np.float64)
    if a.shape[1] != b.shape[1]:
        raise ValueError(f"vector lengths differ: {a.shape[1]} and {b.shape[1]}")
    a, b = a.astype(np.float64), b.astype(np.float64)
    if metric == "l2":
        d = a - b
        return np.einsum("ij,ij->i", d, d)
    if metric == "l1":
        return np.abs(a - b).sum(axis=1)
    if metric == "linf":
        return np.abs(a - b).max(axis=1)
    dot = np.einsum("ij,ij->i", a, b)
    if metric == "ip":
        return -dot
    if metric == "ip_gap":
        return 1.0 - dot
    norms = np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b)
    return 1.0 - np.where(norms > 0, dot / np.sqrt(np.where(norms > 0, norms, 1.0)), 0.0)


def spare_copies(rows: np.ndarray, ids: pa.Array, k: int) -> np.ndarray | None:
    """Row numbers to keep when a batch holds more than ``k`` copies of one vector.

    All copies are equally far from every query, so only the ``k`` with the smallest ids can be hits.
    """
    probe = np.random.default_rng(7).standard_normal(rows.shape[1])
    with np.errstate(all="ignore"):
        mark = (rows.astype(np.float64) * probe).sum(axis=1)
    _, first, group, count = np.unique(mark, return_index=True, return_inverse=True, return_counts=True)
    if not len(count) or count.max() <= k:
        return None
    keep = np.ones(len(rows), bool)
    rank = np.empty(len(rows), np.int64)
    rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(rows))
    for g in np.flatnonzero(count > k):
        same = np.flatnonzero(group == g)
        same = same[(rows[same] == rows[first[g]]).all(axis=1)]
        keep[same[np.argsort(rank[same], kind="stable")[k:]]] = False
    return np.flatnonzero(keep)


_COMPARE = {"==": np.equal, "!=": np.not_equal, "<": np.less, "<=": np.less_equal, ">": np.greater,
            ">=": np.greater_equal}


def _plain(column):
    """Values and a not-null mask as numpy, in a form that compares across batches."""
    arr = combined(column)
    valid = pc.is_valid(arr).to_numpy(zero_copy_only=False)
    if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type):
        return np.array(pc.fill_null(arr, "").to_pylist(), dtype=str), valid
    if pa.types.is_temporal(arr.type):
        arr = arr.cast(pa.timestamp("us") if not pa.types.is_time(arr.type) else pa.time64("us")).cast(pa.int64())
    zero = pa.scalar(False) if pa.types.is_boolean(arr.type) else pa.scalar(0).cast(arr.type)
    return pc.fill_null(arr, zero).to_numpy(zero_copy_only=False), valid


def allowed_pairs(conds, q_rows, c_rows) -> np.ndarray:
    """Which query row may meet which corpus row; an unknown comparison is not allowed."""
    mask = np.ones((q_rows.num_rows, c_rows.num_rows), bool)
    for qcol, op, ccol in conds:
        qv, qok = _plain(q_rows.column(qcol))
        cv, cok = _plain(c_rows.column(ccol))
        mask &= _COMPARE[op](qv[:, None], cv[None, :]) & qok[:, None] & cok[None, :]
    return mask


def allowed_hits(conds, q_rows, c_rows, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """The same for listed pairs of rows."""
    mask = np.ones(len(qi), bool)
    for qcol, op, ccol in conds:
        qv, qok = _plain(q_rows.column(qcol).take(pa.array(qi)))
        cv, cok = _plain(c_rows.column(ccol).take(pa.array(ci)))
        mask &= _COMPARE[op](qv, cv) & qok & cok
    return mask


class Hits:
    """Best ``k`` rows (or best ``k`` distinct groups) per query seen so far.

    Ordered by raw distance, then by the order columns, so equal distances resolve by id.
    """

    def __init__(self, n: int, k: int, order, group: str | None, limit: np.ndarray | None):
        self.n, self.k, self.order, self.group = n, k, list(order), group
        self.tau = np.full(n, np.inf) if limit is None else limit.astype(np.float64).copy()
        self.limit = self.tau.copy()
        self.table: pa.Table | None = None
        self.pending: list[pa.Table] = []
        self.waiting = 0
        self.done = np.zeros(n, bool)  # queries that have k hits already

    def push(self, qi, raw, rows: pa.Table, dist=None):
        if not len(qi):
            return
        self.pending.append(rows.append_column("_q", pa.array(qi, pa.int32())).append_column("_raw", pa.array(raw)))
        self.waiting += len(qi)
        if not self.done[qi].all() or self.waiting > max(50_000, self.n * self.k // 4):
            self.compact()

    def compact(self):
        if not self.pending:
            return
        parts = self.pending if self.table is None else [self.table, *self.pending]
        table = pa.concat_tables(parts).combine_chunks()
        self.pending, self.waiting = [], 0
        keys = [("_q", "ascending"), ("_raw", "ascending")] + [(c, "ascending") for c in self.order]
        table = table.take(pc.sort_indices(table, sort_keys=keys))
        q = table.column("_q").to_numpy()
        if self.group:
            codes = combined(table.column(self.group)).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            _, first = np.unique(q.astype(np.int64) * (int(codes.max()) + 1) + codes, return_index=True)
            first.sort()
            table = table.take(pa.array(first))
            q = q[first]
        start = np.searchsorted(q, q)
        keep = np.arange(len(q)) - start < self.k
        table = table.filter(pa.array(keep))
        q = q[keep]
        counts = np.bincount(q, minlength=self.n)
        last = np.cumsum(counts) - 1
        done = counts >= self.k
        raw = table.column("_raw").to_numpy()
        self.tau[done] = np.minimum(self.limit[done], raw[last[done]])
        self.done = done
        self.table = table

    def result(self) -> pa.Table | None:
        self.compact()
        return self.table


def scan_batch(hits: Hits | None, q: Prepared, q_rows, batch, vectors: np.ndarray, id_col, columns, conds=(),
               limit=None, accept=None, q_index=None, exact=None):
    """Compare one batch with all queries. Feeds ``hits``; without it, yields every accepted pair. ``exact`` knows the full
    vectors beside the codes compared: it thins out the candidates of a radius, and the distance of accepted pairs is carried along."""
    if not len(vectors):
        return
    index = np.arange(q.n) if q_index is None else q_index
    table = pa.table({c: batch.column(c) for c in columns})
    picked = None
    if hits is not None and not conds and hits.group is None and len(index) >= 16 and len(vectors) > hits.k:
        picked = spare_copies(vectors, combined(batch.column(id_col)), hits.k)
        if picked is not None:
            vectors = vectors[picked]
    c = Prepared(q.metric, vectors)
    groups = starts = None
    if hits is not None and hits.group is not None:
        code = combined(batch.column(hits.group)).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        groups = np.argsort(code, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(code[groups]) > 0])
    step = max(1, CELLS // c.n)
    for s in range(0, len(index), step):
        rows = index[s:s + step]
        part = q.take(s, s + len(rows)) if q_index is None else q.pick(rows)
        bound = limit[rows] if hits is None else hits.tau[rows]
        # Conditions are tested on the pairs that the bounds let through, unless those are many.
        ok = near(part, c, bound) if np.isfinite(bound).all() else None
        dense = ok is None or np.count_nonzero(ok) > (ok.size // 16 if hits is None else 4 * len(rows) * hits.k)
        if dense and (conds or hits is not None or ok is None):
            low, eq, ec = lower_bounds(part, c)
            if conds:
                low = np.where(allowed_pairs(conds, q_rows.take(pa.array(rows)), batch), low, np.inf)
            if hits is not None:
                bound = np.minimum(bound, _kth_best(low, ec.astype(low.dtype), hits.k, groups, starts) + eq)
            ok = within(low, bound)
            if conds:
                ok &= np.isfinite(low)
        if exact is not None and hits is None:
            ok = exact.thinned(ok, rows)
        hit = set_places(ok)
        qi, ci = np.divmod(hit, c.n)
        if conds and len(hit) and not dense:
            keep = allowed_hits(conds, q_rows, batch, rows[qi], ci)
            qi, ci = qi[keep], ci[keep]
        if not len(qi):
            continue
        raw = exact_pairs(part, c, qi, ci)
        keep = raw <= (limit if hits is None else hits.tau)[rows][qi] if accept is None else accept(raw, rows[qi])
        if conds:
            keep &= np.isfinite(raw)
        qi, ci, raw = qi[keep], ci[keep], raw[keep]
        source = ci if picked is None else picked[ci]
        found = table.take(pa.array(source))
        if exact is not None:
            found = found.append_column("_exact", pa.array(exact.distances(rows[qi], source)))
        if hits is None:
            yield found.append_column("_q", pa.array(rows[qi], pa.int32())).append_column("_raw", pa.array(raw))
        else:
            hits.push(rows[qi], raw, found)


def _kth_best(low: np.ndarray, ec: np.ndarray, k: int, groups, starts) -> np.ndarray:
    """A distance within which each row has its k best columns, or its best columns of k groups; infinite where there are no more than k.

    The first groups bound all of them. Where they don't suffice, as conditions may exclude them, all are looked at."""
    every = low.shape[1] if groups is None else len(starts)
    if every <= k:
        return np.full(len(low), np.inf)
    for n in (max(256, 32 * k), every):
        if groups is None:
            n, high = every, low + ec
        elif n < every:
            high = np.minimum.reduceat(low[:, groups[:starts[n]]] + ec[groups[:starts[n]]], starts[:n], axis=1)
        else:
            n, high = every, np.minimum.reduceat((low + ec)[:, groups], starts, axis=1)
        kth = np.partition(high, k - 1, axis=1)[:, k - 1].astype(np.float64)
        if n == every or np.isfinite(kth).all():
            return kth


def set_places(ok: np.ndarray) -> np.ndarray:
    """Where a matrix of booleans is set, as places in its flat form. Few are, so eight are passed over at once."""
    flat = ok.reshape(-1)
    words = len(flat) // 8
    some = np.flatnonzero(flat[:8 * words].view(np.uint64))
    row, byte = np.nonzero(flat[:8 * words].reshape(words, 8)[some])
    return np.concatenate([some[row] * 8 + byte, 8 * words + np.flatnonzero(flat[8 * words:])])


def near(q: Prepared, c: Prepared, bound: np.ndarray) -> np.ndarray:
    """``within`` of the lower bounds, which are not kept: a product is made in strips of columns that stay in cache."""
    if q.metric not in GEMM or q.width != c.width:
        return within(lower_bounds(q, c)[0], bound)
    fast = q.fast and c.fast
    left, right = q.factor("query", fast), c.factor("corpus", fast)
    reach, ok = _reach(bound, left.dtype)[:, None], np.empty((q.n, c.n), bool)
    strip = max(64, STRIP // max(1, q.n))
    for s in range(0, c.n, strip):
        np.less_equal(left @ right[s:s + strip].T, reach, out=ok[:, s:s + strip])
    return ok


def within(low: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Which pairs' lower bounds leave them within their query's bound."""
    return low <= _reach(bound, low.dtype)[:, None]


def _reach(bound: np.ndarray, dtype) -> np.ndarray:
    """The bound widened by a rounding step of the matrix it is compared with."""
    if dtype == np.float32:
        with np.errstate(over="ignore"):
            return (bound + np.abs(bound) * 1e-6 + 1e-30).astype(np.float32)
    return bound + np.abs(bound) * 1e-12 + 1e-300

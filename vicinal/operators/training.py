"""Training of encoders and coarse lists as Spark jobs.

Every pass has the same shape: tasks fold their rows into fixed-size partial sums, the partials are added up by key
after one small shuffle, and only the finished parameters (dimensions x centroids, size-checked) reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinal.operators.blocks import as_bytes, as_matrix, list_array
from vicinal.operators.encoders import (BitQuantizer, ProductQuantizer, Sq1, Sq7, _unit, coarse_metric, nearest_centroid,
                                        random_rotation, rotated, structured_rotation)
from vicinal.plans.limits import LIMITS, few_partitions, vector_length
from vicinal.spec import IVF_LIMIT, MAX_CODE_SIZE, SpecError


def sample_vectors(c: DataFrame, n: int, *, id: str = "id", seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all if there are fewer), uniform and repeatable: those with the smallest hashed ids.

    The hash of the last one is found by histograms over ever more of its leading bits: partial counts of at most 65,536 slices a pass,
    until the slice with the n-th row is small. No rows are sorted but those of that slice, and vectors do not move.
    """
    mark = F.xxhash64(F.lit(seed), F.col(id))
    inside, need, bits = F.lit(True), n, 16
    while True:
        slice_ = F.shiftright(mark, 64 - bits)
        counts = sorted((r.s, r.n) for r in c.where(inside).groupBy(slice_.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect())
        if bits == 16 and sum(k for _, k in counts) <= n:
            return c
        for place, k in counts:
            if k >= need:
                break
            need -= k
        inside = slice_ == F.lit(place)
        if k <= SLICE_ROWS or bits == 64:
            break
        bits += 16
    last = c.where(inside).select(mark.alias("h"), F.col(id).alias("i")).orderBy("h", "i").limit(need).agg(F.max(F.struct("h", "i")).alias("m")).first()
    return c.where((mark < last.m.h) | ((mark == last.m.h) & (F.col(id) <= F.lit(last.m.i))))


SLICE_ROWS = 10_000      # rows of a slice that are sorted to find the last one


def _check_model_bytes(values: int) -> None:
    if values * 8 > LIMITS.model_bytes:
        raise SpecError("the trained table would exceed the size that may be held on the driver")


def _moments(c: DataFrame, vec: str, matrix: np.ndarray | None) -> DataFrame:
    """``(dim, n, mean, std)`` from one pass; tasks emit one row per dimension."""

    def task(batches):
        n, mean, m2 = 0, None, None
        for batch in batches:
            rows = as_matrix(batch.column(0)).astype(np.float64)
            if not len(rows):
                continue
            rows = rotated(rows, matrix)
            if mean is None:
                mean, m2 = np.zeros(rows.shape[1]), np.zeros(rows.shape[1])
            b_mean = rows.mean(axis=0)
            b_m2 = ((rows - b_mean) ** 2).sum(axis=0)
            gap, total = b_mean - mean, n + len(rows)
            m2 = m2 + b_m2 + gap * gap * (n * len(rows) / total)
            mean = mean + gap * (len(rows) / total)
            n = total
        if n:
            dim = len(mean)
            yield pa.record_batch([pa.array(np.arange(dim), pa.int32()), pa.array(np.full(dim, n), pa.int64()),
                                   pa.array(mean), pa.array(m2)], names=["dim", "n", "mean", "m2"])

    parts = few_partitions(c.where(F.col(vec).isNotNull()).select(vec)).mapInArrow(
        task, "dim int, n bigint, mean double, m2 double")
    whole = parts.groupBy("dim").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
                                     F.sum("m2").alias("within"),
                                     F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("sq"))
    var = (F.col("within") + F.col("sq") - F.col("n") * F.col("mean") * F.col("mean")) / F.col("n")
    return whole.select("dim", "n", "mean", F.sqrt(F.greatest(var, F.lit(0.0))).alias("std"))


def _side_means(c: DataFrame, vec: str, cut: np.ndarray, matrix: np.ndarray | None) -> DataFrame:
    """``(dim, below, above)``: means of the values up to the cut and beyond it; an empty side reads 0."""

    def task(batches):
        dim = len(cut)
        n, low, high = np.zeros(dim), np.zeros(dim), np.zeros(dim)
        total = 0
        for batch in batches:
            rows = as_matrix(batch.column(0)).astype(np.float64)
            if not len(rows):
                continue
            rows = rotated(rows, matrix)
            up = rows > cut
            n += up.sum(axis=0)
            high += np.where(up, rows, 0.0).sum(axis=0)
            low += np.where(up, 0.0, rows).sum(axis=0)
            total += len(rows)
        yield pa.record_batch([pa.array(np.arange(dim), pa.int32()), pa.array(total - n), pa.array(n), pa.array(low),
                               pa.array(high)], names=["dim", "nb", "na", "low", "high"])

    parts = few_partitions(c.where(F.col(vec).isNotNull()).select(vec)).mapInArrow(
        task, "dim int, nb double, na double, low double, high double")

    def mean(total, count):
        return F.when(F.sum(count) > 0, F.sum(total) / F.greatest(F.sum(count), F.lit(1.0))).otherwise(F.lit(0.0))

    return parts.groupBy("dim").agg(mean("low", "nb").alias("below"), mean("high", "na").alias("above"))


def _column(df: DataFrame, dim: int, *names):
    rows = {r.dim: r for r in df.collect()}  # one row per dimension
    if not rows:
        raise SpecError("there is no vector to train on")
    return [np.array([rows[j][n] for j in range(dim)]) for n in names]


def vector_stats(c: DataFrame, *, vec: str = "vec") -> DataFrame:
    """Per dimension: count, mean, population deviation, and the means below and above the mean."""
    stats = _moments(c, vec, None)
    dim = vector_length(c, vec)
    if dim is None:
        return stats.withColumns({"below": F.lit(0.0), "above": F.lit(0.0)})
    (mean,) = _column(stats, dim, "mean")
    return stats.join(F.broadcast(_side_means(c, vec, mean, None)), "dim")


def fit_scalar_quantizer(c: DataFrame, bits: int = 1, *, sample: int | None = None, rotate: bool = False,
                         vec: str = "vec", id: str = "id", seed: int = 42, matrix: np.ndarray | None = None, unit: bool = False) -> BitQuantizer:
    """Thresholds ``mean + (-1 + 2(i+1)/(bits+1)) * std`` per dimension, over all rows, or over
    ``sample`` of them. ``unit`` scales rows to length 1 first, which is what cosine compares.
    """
    if bits not in (1, 2, 4):
        raise SpecError("bits must be 1, 2 or 4")
    c = c.where(F.col(vec).isNotNull())
    dim = vector_length(c, vec)
    if dim is None:
        raise SpecError("there is no vector to train on")
    if rotate and matrix is None:
        # A dense matrix where the driver may hold one, else a transform that needs none.
        matrix = random_rotation(dim) if dim * dim * 8 <= LIMITS.model_bytes else structured_rotation(dim)
    if sample is not None:
        c = sample_vectors(c, sample, id=id, seed=seed)
    if unit:
        from vicinal.functions.vectors import l2_normalize

        c = c.withColumn(vec, l2_normalize(vec))
    mean, std = _column(_moments(c, vec, matrix), dim, "mean", "std")
    if bits == 1:
        below, above = _column(_side_means(c, vec, mean, matrix), dim, "below", "above")
        return BitQuantizer(mean[None, :], below, above, matrix, unit)
    step = -1 + 2 * (np.arange(bits) + 1) / (bits + 1)
    return BitQuantizer(mean[None, :] + step[:, None] * std[None, :], rotation=matrix, unit=unit)


def fit_sq7(c: DataFrame, confidence_interval: float | None = None, *, vec: str = "vec", id: str = "id",
            sample: int | None = None) -> Sq7:
    """Bounds that hold the middle ``confidence_interval`` of all values.

    Unset: ``1 - 1/(dim + 1)``. 0: the interval out of a few candidates with the smallest squared error.
    """
    if confidence_interval is not None and confidence_interval != 0 and not 0.9 <= confidence_interval <= 1.0:
        raise SpecError("the confidence interval must be 0 or lie in 0.9..1.0")
    c = c.where(F.col(vec).isNotNull())
    dim = vector_length(c, vec)
    if sample is not None:
        c = sample_vectors(c, sample, id=id)
    values = c.select(F.explode(vec).alias("v")).select(F.col("v").cast("double").alias("v"))
    default = 1 - 1 / (dim + 1)
    tries = [confidence_interval or default] if confidence_interval != 0 else [0.9, 0.95, 0.99, default, 1.0]
    points = [p for t in tries for p in ((1 - t) / 2, 1 - (1 - t) / 2)]
    cuts = values.agg(F.percentile_approx("v", points, 10_000).alias("p")).first().p
    bounds = [(cuts[2 * i], cuts[2 * i + 1]) for i in range(len(tries))]
    if len(bounds) == 1:
        return Sq7(*bounds[0])

    def error(low, high):
        step = (high - low) / 127 or 1.0
        held = F.greatest(F.lit(low), F.least(F.lit(high), F.col("v")))
        back = F.lit(low) + F.rint((held - low) / step) * step
        return F.sum((F.col("v") - back) * (F.col("v") - back))

    errors = values.agg(*[error(*b).alias(f"e{i}") for i, b in enumerate(bounds)]).first()
    return Sq7(*bounds[int(np.argmin(list(errors)))])


def fit_sq1(c: DataFrame, space: str = "l2", *, vec: str = "vec") -> Sq1:
    """Centroid of the (for cosine: normalized) vectors; the corrections are fitted per row while encoding."""
    if space not in ("l2", "innerproduct", "cosinesimil"):
        raise SpecError(f"space {space!r} is not supported with 1-bit scalar codes")
    dim = vector_length(c, vec)
    if space == "cosinesimil":
        from vicinal.functions.vectors import l2_normalize

        c = c.select(l2_normalize(vec).alias(vec))
    (mean,) = _column(_moments(c, vec, None), dim, "mean")
    return Sq1(mean, space)


def first_centroids(c: DataFrame, n: int, *, vec: str, id: str, seed: int) -> np.ndarray:
    """Deterministic starting points: distinct vectors of the rows with the smallest hashed ids."""
    _check_model_bytes(n * (vector_length(c, vec) or 1))
    size = 4 * n
    while True:
        # Copies may fill part of the sample; widen it until enough distinct vectors are in it or the table ends.
        rows = (sample_vectors(c.select(id, vec), size, id=id, seed=seed)
                .groupBy(F.xxhash64(vec).alias("_v"))
                .agg(F.min_by(vec, F.xxhash64(F.lit(seed), F.col(id))).alias("vec"), F.count("*").alias("_n"),
                     F.min(F.xxhash64(F.lit(seed), F.col(id))).alias("_h"))
                .orderBy("_h").limit(n).collect())
        # Fewer than n distinct vectors come back unlimited, so their copies add up to the sample's size.
        if len(rows) == n or sum(r["_n"] for r in rows) < size:
            packed = bool(rows) and isinstance(rows[0]["vec"], (bytes, bytearray))
            return np.array([np.frombuffer(r["vec"], np.uint8) for r in rows]) if packed else np.array([r["vec"] for r in rows], np.float64)
        size *= 4


def _added_up(batches):
    """Rows (s, j, n, total) with n and total added up for each (s, j) of the partition."""
    keys, counts, sums = np.zeros(0, np.int64), np.zeros(0, np.int64), None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = as_matrix(batch.column(3))
        key = (batch.column(0).to_numpy().astype(np.int64) << 32) | batch.column(1).to_numpy()
        new, where = np.unique(np.concatenate([keys, key]), return_inverse=True)
        n, total = np.zeros(len(new), np.int64), np.zeros((len(new), rows.shape[1]), rows.dtype)
        if sums is not None:
            n[where[:len(keys)]], total[where[:len(keys)]] = counts, sums
        np.add.at(n, where[len(keys):], batch.column(2).to_numpy())
        np.add.at(total, where[len(keys):], rows)
        keys, counts, sums = new, n, total
    if len(keys):
        yield pa.record_batch([pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(counts), list_array(sums)],
                              names=["s", "j", "n", "total"])


def kmajority(c: DataFrame, init: np.ndarray, *, vec: str = "vec", iterations: int = 10) -> np.ndarray:
    """Lloyd's iterations in the Hamming space; ``init`` is (centroids, bytes) of packed bits.

    A centroid's bit becomes what most of its rows have, and stays where they are divided evenly. Tasks count set bits per nearest
    centroid, at most one row a centroid and task, which Spark adds up. A centroid without rows becomes the fullest one
    with its most divided bit turned over, and takes half of its weight. Stops when nothing changes.
    """
    k, width = init.shape
    _check_model_bytes(init.size * 8)
    sc = c.sparkSession.sparkContext
    table = few_partitions(c.where(F.col(vec).isNotNull()).select(vec))
    centroids = np.ascontiguousarray(init, np.uint8)

    for _ in range(iterations):
        held = sc.broadcast(centroids)

        def assign(batches, held=held):
            now = held.value
            ones, counts = np.zeros((len(now), 8 * now.shape[1]), np.int64), np.zeros(len(now), np.int64)
            for batch in batches:
                rows = as_bytes(batch.column(0))
                if not len(rows):
                    continue
                near = nearest_centroid(rows, now, "hamming")
                order = np.argsort(near, kind="stable")
                for part in np.array_split(order, max(1, rows.size // (1 << 22))):
                    start = np.flatnonzero(np.r_[True, np.diff(near[part]) > 0])
                    ones[near[part][start]] += np.add.reduceat(np.unpackbits(rows[part], axis=1), start, axis=0, dtype=np.int64)
                counts += np.bincount(near, minlength=len(now))
            j = np.flatnonzero(counts)
            if len(j):
                yield pa.record_batch([pa.array(np.zeros(len(j)), pa.int32()), pa.array(j, pa.int32()), pa.array(counts[j]), list_array(ones[j])],
                                      names=["s", "j", "n", "total"])

        schema = "s int, j int, n bigint, total array<bigint>"
        rows = table.mapInArrow(assign, schema).repartition("j").mapInArrow(_added_up, schema).toArrow()
        held.unpersist()
        if not rows.num_rows:
            break
        j, ones, n = rows.column("j").to_numpy(), np.zeros((k, 8 * width)), np.zeros(k)
        n[j], ones[j] = rows.column("n").to_numpy(), as_matrix(rows.column("total"))
        bits = np.unpackbits(centroids, axis=1)
        new = np.where(2 * ones > n[:, None], 1, np.where(2 * ones < n[:, None], 0, bits)).astype(np.uint8)
        new[n == 0] = bits[n == 0]
        for empty in np.flatnonzero(n == 0):
            full = int(n.argmax())
            if n[full] < 2:
                break
            new[empty] = new[full]
            turned = int(np.abs(2 * ones[full] - n[full]).argmin())
            new[empty, turned] ^= 1
            ones[full, turned] = np.inf      # the next one turns another bit
            n[empty] = n[full] / 2
            ones[empty] = ones[full] / 2
            n[full] /= 2
            ones[full] /= 2
        packed = np.packbits(new, axis=1)
        if (packed == centroids).all():
            break
        centroids = packed
    return centroids


def kmeans(c: DataFrame, init: np.ndarray, *, vec: str = "vec", iterations: int = 10, metric: str = "l2",
           tolerance: float = 1e-6) -> np.ndarray:
    """Lloyd's iterations on one or several sub-spaces at once; ``init`` is (subs, centroids, width).

    Each iteration is one pass: tasks add their rows up per nearest centroid, and the partial sums, at most one per
    centroid and task, are merged by a streaming sum after a shuffle on (sub, centroid). A centroid that lost all
    its rows takes over half of the fullest one's neighbourhood.
    """
    subs, k, width = init.shape
    _check_model_bytes(init.size)
    sc = c.sparkSession.sparkContext
    table = few_partitions(c.where(F.col(vec).isNotNull()).select(vec))
    centroids = init.astype(np.float64)

    for _ in range(iterations):
        held = sc.broadcast(centroids)

        def assign(batches, held=held):
            now = held.value
            sums, counts = np.zeros(now.shape), np.zeros(now.shape[:2], np.int64)
            for batch in batches:
                rows = as_matrix(batch.column(0)).astype(np.float64)
                if not len(rows):
                    continue
                if metric == "cos":
                    rows = _unit(rows)
                for s in range(subs):
                    part = rows[:, s * width:(s + 1) * width]
                    near = nearest_centroid(part, now[s], metric)
                    order = np.argsort(near, kind="stable")
                    start = np.flatnonzero(np.r_[True, np.diff(near[order]) > 0])
                    sums[s][near[order][start]] += np.add.reduceat(part[order], start, axis=0)
                    counts[s] += np.bincount(near, minlength=k)
            s, j = np.nonzero(counts)
            if len(s):
                yield pa.record_batch([pa.array(s, pa.int32()), pa.array(j, pa.int32()), pa.array(counts[s, j]),
                                       list_array(sums[s, j])], names=["s", "j", "n", "total"])

        schema = "s int, j int, n bigint, total array<double>"
        rows = table.mapInArrow(assign, schema).repartition("s", "j").mapInArrow(_added_up, schema).toArrow()
        s, j = rows.column("s").to_numpy(), rows.column("j").to_numpy()
        n = np.zeros((subs, k))
        n[s, j] = rows.column("n").to_numpy()
        new = centroids.copy()
        new[s, j] = as_matrix(rows.column("total")) / n[s, j][:, None]
        for sub in range(subs):
            for empty in np.flatnonzero(n[sub] == 0):
                full = int(n[sub].argmax())
                if n[sub, full] < 2:
                    break
                nudge = np.where(np.arange(width) % 2 == 0, 1.0, -1.0) * (np.abs(new[sub, full]) * 1e-3 + 1e-6)
                new[sub, empty] = new[sub, full] + nudge
                new[sub, full] = new[sub, full] - nudge
                n[sub, empty] = n[sub, full] / 2
                n[sub, full] /= 2
        held.unpersist()
        moved = np.abs(new - centroids).max()
        centroids = new
        if moved <= tolerance:
            break
    return centroids


def fit_ivf(c: DataFrame, nlist: int = 4, *, space: str = "l2", iterations: int = 10, seed: int = 42, vec: str = "vec",
            id: str = "id", init: np.ndarray | None = None) -> np.ndarray:
    """Coarse centroids of an inverted file: ``(nlist, dim)`` numbers, or ``(nlist, bytes)`` packed bits in the Hamming space."""
    if not 0 < nlist < IVF_LIMIT:
        raise SpecError(f"nlist must lie in 1..{IVF_LIMIT - 1}")
    metric = coarse_metric(space)
    if init is None:
        init = first_centroids(c.where(F.col(vec).isNotNull()), nlist, vec=vec, id=id, seed=seed)
        if len(init) < nlist:
            raise SpecError(f"training needs at least {nlist} distinct vectors")
    if metric == "hamming":
        return kmajority(c, init, vec=vec, iterations=iterations)
    if metric == "cos":
        init = _unit(init)
    return kmeans(c, init[None], vec=vec, iterations=iterations, metric=metric)[0]


def fit_pq(c: DataFrame, m: int = 1, code_size: int = 8, *, space: str = "l2", iterations: int = 10, seed: int = 42,
           vec: str = "vec", id: str = "id", init: np.ndarray | None = None) -> ProductQuantizer:
    """Codebook of ``2**code_size`` centroids for each of ``m`` sub-vectors; up to 8 bits a code takes one byte, beyond that two."""
    if not 0 < code_size <= MAX_CODE_SIZE:
        raise SpecError(f"code_size must lie in 1..{MAX_CODE_SIZE}")
    c = c.where(F.col(vec).isNotNull())
    if space == "cosinesimil":
        from vicinal.functions.vectors import l2_normalize

        c = c.withColumn(vec, l2_normalize(vec))
    if init is None:
        dim = vector_length(c, vec)
        if dim is None or dim % m:
            raise SpecError("the dimension must be divisible by m")
        k = 1 << code_size
        rows = first_centroids(c, k, vec=vec, id=id, seed=seed)
        if len(rows) < k:
            raise SpecError(f"training needs at least {k} distinct vectors")
        init = rows.reshape(k, m, dim // m).transpose(1, 0, 2)
    return ProductQuantizer(kmeans(c, init, vec=vec, iterations=iterations), space == "cosinesimil")

"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors of cosine ``least`` or more lie within squared distance 2 - 2 * least. Rotated at random and split into blocks of dimensions,
such a pair is within its proportional share of that budget in at least one block. So each block is range-joined on its own: along its first
coordinate it is cut into slabs as wide as the block's radius, a vector is at home in one slab and visits the next ones within its radius, and
inside a slab the distances of the block's coordinates alone decide who is a candidate. The union of candidates is verified with
the whole vectors in double precision. A pair that several blocks find counts in the first of them only, so nothing is counted
twice and no pair has to be shuffled: a cell returns link counts by vector and a spanning forest of its links.

Equal vectors are one class with a weight. Slabs are cut into cells of bounded size (``common.met_in``), hot ones into many."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Forest, components, cut, in_cells, met_in, whole_groups

CELL = 32768        # rows of a slab that one chunk holds, about
NUMBERS = 1 << 22   # and components of their vectors: a slab of n chunks is sent n times, a task holds two
TILE = 512          # rows compared at once, a multiple of 8
SLACK = 1e-9    # relative room for rounding when a block's budget is tested


def rotation(dim: int, seed: int = 10) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def edges_of(dim: int, blocks: int) -> list[int]:
    n = max(1, min(blocks, dim))
    return [dim * i // n for i in range(n + 1)]


def usable(vec: Column) -> Column:
    """Vectors that can have a cosine: not null, no null or non-finite component, not zero."""
    fine = F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce(fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column, dims: np.ndarray):
    """Groups of equal dimension: (row numbers, matrix in double)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(dims)])
    for d in np.unique(dims):
        rows = np.flatnonzero(dims == d)
        yield rows, flat[starts[rows][:, None] + np.arange(d)]


def _slabs(blocks: int, budget: float, seed: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = np.diff(batch.column(2).offsets.to_numpy())
            out = {k: [] for k in ("row", "dim", "block", "slab", "home")}
            for rows, x in _matrix(batch.column(2), dims):
                d = x.shape[1]
                y = unit(x) @ rotation(d, seed)
                cuts = edges_of(d, blocks)
                for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    reach = np.sqrt(budget * (hi - lo) / d) * (1 + 1e-6)
                    first = y[:, lo]
                    own = np.floor(first / reach).astype(np.int64)
                    last = np.floor((first + reach) / reach).astype(np.int64)
                    for step in range(int((last - own).max()) + 1):
                        some = own + step <= last
                        n = int(some.sum())
                        out["row"].append(rows[some])
                        out["dim"].append(np.full(n, d))
                        out["block"].append(np.full(n, b))
                        out["slab"].append(own[some] + step)
                        out["home"].append(np.full(n, step == 0))
            got = {k: np.concatenate(v) for k, v in out.items()}
            take = pa.array(got["row"])
            yield pa.record_batch([pa.array(got["dim"], pa.int32()), pa.array(got["block"], pa.int32()), pa.array(got["slab"], pa.int64()),
                                   pa.array(got["home"], pa.bool_()), batch.column(0).take(take), batch.column(1).take(take), batch.column(2).take(take)],
                                  ["dim", "block", "slab", "home", "node", "n", "vec"])
    return run


def _verify(blocks: int, least: float, budget: float, seed: int):
    def pairs_of(a, b, raw, y, cuts, block, same):
        """Verified pairs of the rows a with the rows b; within one list each pair once."""
        lo, hi = cuts[block], cuts[block + 1]
        share = np.diff(cuts) / cuts[-1] * budget * (1 + SLACK)
        x, z = y[a, lo:hi], y[b, lo:hi]
        # Two further columns carry either side's square, so a product not below zero is a distance within the share. Its error in float32 is less than the room.
        room = (8 * (hi - lo) + 32) * 2.0 ** -24
        left = np.column_stack([x, np.ones(len(a)), (share[block] + room - (x ** 2).sum(axis=1)) / 2]).astype(np.float32)
        right = np.zeros((-(-len(b) // 8) * 8, hi - lo + 2), np.float32)
        right[:, -2] = -9       # rows that fill up the last eight are far from all
        right[:len(b)] = np.column_stack([z, (z ** 2).sum(axis=1) / -2, np.ones(len(b))])
        for at, to in ((at, to) for at in range(0, len(a), TILE) for to in range(at if same else 0, len(b), TILE)):
            near = left[at:at + TILE] @ right[to:to + TILE].T >= 0
            some = np.flatnonzero(near.reshape(-1).view(np.uint64))
            row, byte = np.nonzero(near.reshape(-1, 8)[some])
            i, j = np.divmod(some[row] * 8 + byte, near.shape[1])
            i, j = i + at, j + to
            if same:
                keep = i < j
                i, j = i[keep], j[keep]
            for part in range(0, len(i), 65536):
                p, q = a[i[part:part + 65536]], b[j[part:part + 65536]]
                ok = np.einsum("ij,ij->i", raw[p], raw[q]) >= least
                p, q = p[ok], q[ok]
                if not len(p):
                    continue
                gaps = np.add.reduceat((y[p] - y[q]) ** 2, cuts[:-1], axis=1) <= share
                first = gaps.argmax(axis=1) == block
                yield p[first], q[first]

    def run(batches):
        for table, bounds in whole_groups(batches, ["dim", "block", "slab", "cell_i", "cell_j"]):
            dims = table.column("dim").to_numpy()
            block = table.column("block").to_numpy()
            home = table.column("home").combine_chunks().to_numpy(zero_copy_only=False)
            side = table.column("side").to_numpy()
            node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
            vec = table.column("vec").combine_chunks()
            a, b, w = [], [], []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                d = int(dims[lo])
                raw = unit(vec[lo:hi].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(hi - lo, d))
                y, cuts = raw @ rotation(d, seed), np.array(edges_of(d, blocks))
                forest, links = Forest(hi - lo), np.zeros(hi - lo, np.int64)
                group = {(s, h): np.flatnonzero((side[lo:hi] == s) & (home[lo:hi] == h)) for s in range(3) for h in (False, True)}
                if side[lo] == 0:
                    meet = [(group[0, True], group[0, True], True), (group[0, True], group[0, False], False)]
                else:
                    meet = [(group[1, True], group[2, True], False), (group[1, True], group[2, False], False), (group[2, True], group[1, False], False)]
                for left, right, same in meet:
                    if len(left) and len(right):
                        for p, q in pairs_of(left, right, raw, y, cuts, int(block[lo]), same):
                            np.add.at(links, p, n[lo + q])
                            np.add.at(links, q, n[lo + p])
                            for s, t in zip(p.tolist(), q.tolist()):
                                forest.link(s, t)
                some = np.flatnonzero(links)
                a += [node[lo + some], node[lo + np.array([x for x, _ in forest.kept], np.int64)]]
                b += [np.zeros(len(some), np.int64), node[lo + np.array([x for _, x in forest.kept], np.int64)]]
                w += [links[some], np.zeros(len(forest.kept), np.int64)]
            yield pa.record_batch([pa.array(np.concatenate(x).astype(np.int64)) for x in (a, b, w)], ["a", "b", "links"])
    return run


def near_duplicates(vectors: DataFrame, id: str = "vec_id", vec: str = "embedding", least: float = 0.9, blocks: int = 4, seed: int = 10,
                    cell: int = CELL, numbers: int = NUMBERS) -> DataFrame:
    """(id, n_links, component_id, kept) for each row: how many other rows have a cosine of ``least`` or more with it, the smallest id
    reachable by such links (itself included), and whether that is its own.

    Rows with a null id and vectors that are null, zero, or hold null or non-finite components link with nothing. Vectors of different
    length are not compared. Repeated rows are other rows with the same vector; rows of one id with different vectors are rows of their
    own, linked only where their vectors are. Other columns are not read."""
    rows = vectors.select(F.col(id).cast("bigint").alias("id"), F.col(vec).alias("vec"))
    good = rows.where(F.col("id").isNotNull() & usable(F.col("vec")))
    # A class has a number of its own, fixed once written: an id may stand for several vectors.
    classes = good.groupBy("vec").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = cut(classes.select(F.monotonically_increasing_id().alias("node"), "rep", "n", "vec"), "vector-classes")
    kind = vectors.schema[vec].dataType.simpleString()
    budget = 2 - 2 * least
    slabs = classes.select("node", "n", "vec").mapInArrow(_slabs(blocks, budget, seed), f"dim int, block int, slab bigint, home boolean, node bigint, n bigint, vec {kind}")
    where = ["dim", "block", "slab"]
    dealt = in_cells(met_in(cut(slabs, "vector-slabs"), where, F.struct("node", "home"), cell, F.size("vec"), numbers), where)
    found = cut(dealt.mapInArrow(_verify(blocks, least, budget, seed), "a bigint, b bigint, links bigint"), "vector-links")
    counts = found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("others"))
    roots = components(found.where("links = 0").select("a", "b"), "vector-components")
    rooted = classes.select("node", "rep").join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    best = rooted.join(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("node", "component_id")
    known = classes.join(counts, "node", "left").join(best, "node").select(
        F.col("vec").alias("__vec"), (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    got = rows.join(known, (F.col("vec") == F.col("__vec")) & F.col("id").isNotNull(), "left")
    return got.select(F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      F.coalesce("component_id", "id").alias("component_id")).withColumn("kept", F.coalesce(F.col(id) == F.col("component_id"), F.lit(True)))

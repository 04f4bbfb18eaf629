"""Exact top-k search in Hamming space by incremental multi-index hashing.

A binary code is cut into segments of ``SEGMENT`` bits. Each task indexes its part of the rows: for every segment, row numbers sorted
by the segment's value. A query probes all values within segment radius 0, then 1, 2, ... and verifies what it finds with the whole
code. Once radius s is done in all m segments, every code within m * (s + 1) - 1 bits has been seen, for one farther away differs by more than s in each
segment; the search stops when the k-th verified distance is not above that, which proves it exact, ties included.

Rows are never shuffled. Queries come in blocks of bounded size, each broadcast to the tasks; a task sends at most k rows a query."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_path

SEGMENT = 16
BLOCK = 65_536       # queries broadcast at once
SHARD = 1 << 20      # rows indexed at once in a task


def sign_code(vec: Column) -> Column:
    """One bit a component, set where it is positive, most significant first; 64 components take eight bytes, the last ones of a longer
    vector eight more. A vector without components has eight zero bytes."""
    def word(part: Column) -> Column:
        bits = F.aggregate(part, F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, 1).bitwiseOR((F.coalesce(x, F.lit(0.0)) > 0).cast("long")))
        return F.lpad(F.hex(bits), 16, "0")

    words = F.greatest(F.ceil(F.size(vec) / 64), F.lit(1)).cast("int")
    parts = F.transform(F.sequence(F.lit(0), words - 1), lambda i: word(F.slice(vec, i * 64 + 1, F.lit(64))))
    return F.when(vec.isNotNull(), F.unhex(F.array_join(parts, "")))


def masks(bits: int, radius: int) -> np.ndarray:
    """All values of so many bits with exactly ``radius`` set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(bits), radius)], np.int64)


class Index:
    """Multi-index over codes of one length (rows of bytes)."""

    def __init__(self, codes: np.ndarray):
        n, size = codes.shape
        wide = -(-size // 8) * 8
        padded = np.zeros((n, wide), np.uint8)
        padded[:, :size] = codes
        self.codes = padded.view(np.uint64)
        self.bits = [min(SEGMENT, 8 * size - at) for at in range(0, 8 * size, SEGMENT)]
        self.order, self.starts = [], []
        self.masks: dict = {}
        for s, bits in enumerate(self.bits):
            value = self.segment(codes, s)
            order = np.argsort(value, kind="stable").astype(np.int32)
            self.order.append(order)
            self.starts.append(np.searchsorted(value[order], np.arange((1 << bits) + 1)).astype(np.int32))

    @staticmethod
    def segment(codes: np.ndarray, s: int) -> np.ndarray:
        high = codes[:, 2 * s].astype(np.int64)
        return high << 8 | codes[:, 2 * s + 1] if 2 * s + 1 < codes.shape[1] else high

    def nearest(self, query: np.ndarray, ids: np.ndarray, k: int):
        """(distances, rows) of the k nearest by distance and id."""
        n, m = len(self.codes), len(self.bits)
        seen = np.zeros(n, bool)
        padded = np.zeros(self.codes.shape[1] * 8, np.uint8)
        padded[: len(query)] = query
        whole = padded.view(np.uint64)
        own = [int(self.segment(query[None], s)[0]) for s in range(m)]
        rows, far = np.empty(0, np.int64), np.empty(0, np.int64)
        for radius in range(max(self.bits) + 1):
            fresh = []
            for s in range(m):
                if radius > self.bits[s]:
                    continue
                key = self.bits[s], radius
                if key not in self.masks:
                    self.masks[key] = masks(*key)
                probes = own[s] ^ self.masks[key]
                lo, hi = self.starts[s][probes], self.starts[s][probes + 1]
                some = hi > lo
                lo, count = lo[some].astype(np.int64), (hi - lo)[some].astype(np.int64)
                if not len(lo):
                    continue
                ends = np.cumsum(count)
                at = np.arange(ends[-1]) + np.repeat(lo - (ends - count), count)
                hit = self.order[s][at]
                hit = hit[~seen[hit]]
                seen[hit] = True
                fresh.append(hit)
            if fresh:
                new = np.concatenate(fresh).astype(np.int64)
                rows = np.concatenate([rows, new])
                far = np.concatenate([far, np.bitwise_count(self.codes[new] ^ whole).sum(axis=1, dtype=np.int64)])
                if len(rows) > k:
                    kth = np.partition(far, k - 1)[k - 1]
                    keep = far <= kth
                    rows, far = rows[keep], far[keep]
            if len(rows) >= min(k, n) and (seen.all() or np.partition(far, min(k, n) - 1)[min(k, n) - 1] <= m * (radius + 1) - 1):
                break
        best = np.lexsort((ids[rows], far))[:k]
        return far[best], rows[best]


def _search(sent, k: int, shard: int):
    def run(batches):
        held, size = [], 0

        def flush():
            table = pa.Table.from_batches(held)
            ids = table.column("id").to_numpy()
            code = table.column("code").combine_chunks()
            lengths = np.array([len(c.as_py()) for c in code])
            out = [[], [], []]
            for length in np.unique(lengths[lengths > 0]).tolist():
                at = np.flatnonzero(lengths == length)
                mine = np.frombuffer(b"".join(code.take(pa.array(at)).to_pylist()), np.uint8).reshape(-1, length)
                index = None
                for query, value in sent.value:
                    if len(value) != length:
                        continue
                    index = index or Index(mine)
                    far, rows = index.nearest(np.frombuffer(value, np.uint8), ids[at], k)
                    out[0].append(np.full(len(rows), query))
                    out[1].append(ids[at][rows])
                    out[2].append(far)
            arrays = [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out]
            return pa.record_batch([*arrays[:2], arrays[2].cast(pa.int32())], ["query_id", "id", "distance"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= shard:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()
    return run


def nearest(queries: DataFrame, rows: DataFrame, k: int = 10, id: str = "id", code: str = "code", block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, id, distance): for every query the k rows of smallest Hamming distance, ties by id; fewer where fewer exist.

    ``queries`` and ``rows`` have a long ``id`` and a binary ``code``. Rows or queries with a null id or a null or empty code match
    nothing; codes of different length are not compared. A query that equals a row finds it; repeated rows are all found, and of repeated queries one
    answers. An empty side gives an empty table."""
    spark = rows.sparkSession
    usable = f"`{id}` is not null and length(`{code}`) > 0"
    asked = queries.where(usable).select(F.col(id).cast("long").alias("id"), F.col(code).alias("code")).groupBy("id").agg(F.min("code").alias("code"))
    given = rows.where(usable).select(F.col(id).cast("long").alias("id"), F.col(code).alias("code"))
    blocks = max(1, -(-asked.count() // block))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))

    def best(b: int):
        part = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).orderBy("id").toArrow()
        sent = spark.sparkContext.broadcast(list(zip(part.column("id").to_pylist(), part.column("code").to_pylist())))
        found = given.mapInArrow(_search(sent, k, shard), "query_id bigint, id bigint, distance int")
        return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance"), sent

    if blocks == 1:
        return best(0)[0]
    # One block of queries at a time is held by the driver and the tasks; its hits are written before the next one.
    out = shared_path(spark, "top-k")
    for b in range(blocks):
        found, sent = best(b)
        found.write.mode("append").parquet(out)
        sent.destroy()
    return spark.read.schema(found.schema).parquet(out)


TOPK_SQL = """
WITH d AS (SELECT q.vec_id AS query_id, e.vec_id AS vec_id, CAST(list_sum([CASE WHEN (q.embedding[i] > 0) <> (e.embedding[i] > 0) THEN 1 ELSE 0 END for i in range(1, 65)]) AS INTEGER) AS distance
  FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM d)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10
"""

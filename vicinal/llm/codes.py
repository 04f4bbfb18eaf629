"""Vector code compression: every part of a vector becomes the number of the nearest entry of that part's codebook.

The nearest entry is found by slice and intersect. A codebook's coordinates are sorted along each dimension, and beside every place in that
order stands the mask of the entries before it, one bit an entry of a uint64. An initial radius, the distance to the nearest of the
entries that come next along one dimension each, bounds the search: along a dimension it selects a range of the order, whose entries are the
exclusive-or of two prefix masks. The masks of all dimensions, ANDed, leave the entries in a box that the nearest cannot lie
outside of; those few are compared exactly, in integers.

Training is a pass over the rows a round: tasks fold their rows into one sum a part and entry, at most ``parts * 64`` rows each, which Spark
adds up; only codebooks reach the driver and the tasks."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

MASK = 64                # bits of a mask, entries of a codebook at most
SCALE = 256
LARGEST = 1 << 28        # of a scaled component, so that squared distances stay within 64 bits


class Slices:
    """One codebook (entries, width), ready for slice and intersect."""

    def __init__(self, entries: np.ndarray):
        self.entries = np.ascontiguousarray(entries, np.int64)
        m, width = self.entries.shape
        if not 0 < m <= MASK:
            raise ValueError(f"a codebook holds 1 to {MASK} entries")
        self.order = np.argsort(self.entries, axis=0, kind="stable")
        self.sorted = [self.entries[self.order[:, d], d] for d in range(width)]
        bits = np.uint64(1) << self.order.astype(np.uint64)
        self.masks = [np.concatenate([[np.uint64(0)], np.bitwise_or.accumulate(bits[:, d])]) for d in range(width)]

    def radius(self, rows: np.ndarray) -> np.ndarray:
        """A whole number not below the distance of each row to its nearest entry."""
        best = None
        for d, line in enumerate(self.sorted):
            at = np.minimum(np.searchsorted(line, rows[:, d]), len(line) - 1)
            far = ((rows - self.entries[self.order[at, d]]) ** 2).sum(axis=1)
            best = far if best is None else np.minimum(best, far)
        return np.sqrt(best.astype(np.float64)).astype(np.int64) + 1

    def box(self, rows: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The mask of the entries that differ by at most the radius in every dimension."""
        mask = np.full(len(rows), ~np.uint64(0))
        for d, line in enumerate(self.sorted):
            low = np.searchsorted(line, rows[:, d] - radius, "left")
            high = np.searchsorted(line, rows[:, d] + radius, "right")
            mask &= self.masks[d][high] ^ self.masks[d][low]
        return mask

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row; ties go to the lower entry."""
        if not len(rows):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        mask = self.box(rows, self.radius(rows)).astype("<u8")
        row, entry = np.nonzero(np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        far = ((rows[row] - self.entries[entry]) ** 2).sum(axis=1)
        starts = np.searchsorted(row, np.arange(len(rows)))
        least = np.minimum.reduceat(far, starts)
        hit = np.flatnonzero(far == least[row])
        first = hit[np.append(True, row[hit][1:] != row[hit][:-1])]
        return entry[first], least


@dataclass
class Codebooks:
    """``books`` (part, entry, width) of whole numbers."""

    books: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position, joined by commas; lowercase hex."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, part) entries and squared distances of scaled vectors."""
        cut_up = rows.reshape(len(rows), *self.books.shape[::2])
        both = [Slices(book).nearest(np.ascontiguousarray(cut_up[:, p])) for p, book in enumerate(self.books)]
        return np.stack([b[0] for b in both], axis=1), np.stack([b[1] for b in both], axis=1)


def usable(vec: Column) -> Column:
    """Vectors that are neither null nor empty and whose components are all finite numbers, small enough for exact distances."""
    fine = F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST / SCALE), F.lit(False)))
    return F.coalesce(fine & (F.size(vec) > 0), F.lit(False))


def scaled(vectors: DataFrame, vec: str, keep: list[str]) -> DataFrame:
    """``keep`` and v: the usable rows' components as floor(256 * x)."""
    v = F.transform(F.col(f"`{vec}`"), lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    return vectors.where(usable(F.col(f"`{vec}`"))).select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], v.alias("v"))


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _folded(books: np.ndarray):
    """(part, entry, n, sums) of a task's rows."""
    parts, entries, width = books.shape

    def run(batches):
        n, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            rows = _matrix(batch.column(0), parts * width)
            got, _ = Codebooks(books).assign(rows)
            for p in range(parts):
                n[p] += np.bincount(got[:, p], minlength=entries)
                np.add.at(sums[p], got[:, p], rows[:, p * width:(p + 1) * width])
        part, entry = np.nonzero(n)
        flat = pa.array(sums[part, entry].ravel())
        offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * width)
        yield pa.record_batch([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry]),
                               pa.ListArray.from_arrays(offsets, flat)], ["part", "entry", "n", "sums"])
    return run


def train(vectors: DataFrame, id: str = "vec_id", vec: str = "embedding", parts: int = 16, entries: int = MASK, rounds: int = 2) -> Codebooks | None:
    """Codebooks of ``entries`` entries for each of ``parts`` equal parts of the vectors.

    They start as the parts of the usable rows with the smallest ids (null ids last; of equal ids the smaller vector first). A round assigns
    every part and replaces each entry by the componentwise floor of the mean of its parts; unused entries stay. All usable rows take
    part. None where no row is usable. The first vector's length counts; its being no multiple of ``parts`` is an error."""
    if not 0 < entries <= MASK:
        raise ValueError(f"a codebook holds 1 to {MASK} entries")
    rows = scaled(vectors, vec, [id])
    first = rows.orderBy(F.col("k0").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not first:
        return None
    dim = len(first[0].v)
    if dim % parts:
        raise ValueError(f"vectors of {dim} components do not have {parts} equal parts")
    start = np.array([r.v for r in first if len(r.v) == dim], np.int64)
    books = np.ascontiguousarray(start.reshape(len(start), parts, dim // parts).swapaxes(0, 1))
    for _ in range(rounds):
        folded = rows.where(F.size("v") == dim).select("v").mapInArrow(_folded(books), "part int, entry int, n bigint, sums array<bigint>")
        total = folded.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(
            *[F.sum(F.col("sums")[d].cast("decimal(38,0)")) for d in range(dim // parts)]).alias("sums"))
        books = books.copy()
        for r in total.collect():
            books[r.part, r.entry] = [int(s) // r.n for s in r.sums]
    return Codebooks(books)


def encode(vectors: DataFrame, books: Codebooks | None, vec: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of every usable row, with its code (one byte a part) and error (squared distances of its parts to their
    entries, added up).

    Vectors that are null, empty, of another length than the codebooks', or hold null, non-finite or (2^20 and more) too large components
    have no row. Repeated rows are rows. Without codebooks there are no rows."""
    keep = list(keep or [])
    rows = scaled(vectors, vec, keep)
    kinds = [rows.schema[f"k{i}"].dataType for i in range(len(keep))]
    schema = T.StructType([*[T.StructField(f"k{i}", k) for i, k in enumerate(kinds)], T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])
    if books is None:
        return vectors.sparkSession.createDataFrame([], schema).toDF(*keep, "code", "error")
    held = books.books
    dim = held.shape[0] * held.shape[2]

    def run(batches):
        for batch in batches:
            got, far = Codebooks(held).assign(_matrix(batch.column(len(keep)), dim))
            codes = pa.FixedSizeBinaryArray.from_buffers(pa.binary(held.shape[0]), len(got), [None, pa.py_buffer(got.astype(np.uint8).tobytes())])
            yield pa.record_batch([*batch.columns[:-1], codes.cast(pa.binary()), pa.array(far.sum(axis=1))], [*batch.schema.names[:-1], "code", "error"])

    return rows.where(F.size("v") == dim).mapInArrow(run, schema).toDF(*keep, "code", "error")


def decode(codes: DataFrame, books: Codebooks, code: str = "code", to: str = "embedding") -> DataFrame:
    """``codes`` with the vectors that their codes stand for."""
    flat = F.lit([float(x) / SCALE for x in books.books.ravel().tolist()])
    parts, entries, width = books.books.shape
    at = F.sequence(F.lit(0), F.lit(parts * width - 1))
    digits = F.hex(F.col(code))
    entry = F.transform(at, lambda i: F.conv(F.substring(digits, (2 * F.floor(i / width) + 1).cast("int"), F.lit(2)), 16, 10).cast("int"))
    picked = F.zip_with(at, entry, lambda i, e: F.element_at(flat, ((F.floor(i / width) * entries + e) * width + i % width + 1).cast("int")))
    return codes.withColumn(to, picked)


# The same codes for DuckDB: parts as rows, all entries compared, two rounds spelled out.
def _codes_sql(rounds: int = 2) -> str:
    def floor_div(a: str, b: str) -> str:
        return f"(({a}) - ((({a}) % ({b})) + ({b})) % ({b})) // ({b})"

    ctes = [
        "good AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings "
        "WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)",
        "p AS MATERIALIZED (SELECT vec_id, part, list_slice(v, CAST(part * len(v) // 16 + 1 AS BIGINT), CAST((part + 1) * len(v) // 16 AS BIGINT)) AS x FROM good, range(16) t(part))",
        "b0 AS MATERIALIZED (SELECT part, r AS entry, x AS e FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS r FROM p) WHERE r < 64)"]
    far = "CAST(list_sum(list_transform(list_zip(p.x, b.e), lambda s: (s[1] - s[2]) * (s[1] - s[2]))) AS BIGINT)"
    for n in range(rounds + 1):
        ctes.append(f"a{n} AS MATERIALIZED (SELECT vec_id, p.part, min(x) AS x, min({far} * 64 + entry) AS m FROM p JOIN b{n} b ON b.part = p.part GROUP BY vec_id, p.part)")
        if n < rounds:
            ctes.append(f"u{n} AS (SELECT part, m % 64 AS entry, d, {floor_div('CAST(sum(x[d + 1]) AS BIGINT)', 'count(*)')} AS c FROM a{n}, range(len(x)) t(d) GROUP BY ALL)")
            ctes.append(f"n{n} AS (SELECT part, entry, list(c ORDER BY d) AS e FROM u{n} GROUP BY ALL)")
            ctes.append(f"b{n + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(n.e, b.e) AS e FROM b{n} b LEFT JOIN n{n} n ON n.part = b.part AND n.entry = b.entry)")
    ctes.append(f"c AS (SELECT vec_id, string_agg(printf('%02x', m % 64), '' ORDER BY part) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)")
    ctes.append(f"books AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})")
    return (f"WITH {', '.join(ctes)} SELECT c.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 "
            "FROM c JOIN good g ON g.vec_id = c.vec_id, books")


CODES_SQL = _codes_sql()

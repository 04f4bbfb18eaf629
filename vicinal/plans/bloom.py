"""Bloom filters of bounded size: built by Spark's bitmap aggregates, tested inside the tasks of a scan.

A filter tells a scan which of its rows can matter to a later join, so that the rest never reaches a shuffle. It lets some rows too many
through, never one too few: what follows stays exact whatever its size."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE = 1 << 15            # bits of one row of the aggregate, as Spark's bitmap functions cut them
LEAST, MOST = PAGE, 1 << 28      # bits of a filter; the upper end is 32 MiB on the driver and in a task
PER_KEY = 16              # bits a key where the upper end allows it


@dataclass
class Bloom:
    """Two bits a key: the low and the high half of its 64-bit hash."""

    sent: Broadcast
    bits: int

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Which of these hashes (64-bit numbers) may be among the keys."""
        h = hashes.view(np.uint64) if hashes.dtype.itemsize == 8 else hashes.astype(np.uint64)
        held, inside = self.sent.value, np.uint64(self.bits - 1)
        low, high = h & inside, (h >> np.uint64(32)) & inside
        seven = np.uint64(7)
        return ((held[low >> np.uint64(3)] >> (low & seven).astype(np.uint8)) & (held[high >> np.uint64(3)] >> (high & seven).astype(np.uint8)) & 1).astype(bool)

    def column(self, hashes: Column) -> Column:
        """The same as a Column over a Column of non-null hashes."""
        has = self.has

        @F.arrow_udf("boolean")
        def test(values: pa.Array) -> pa.Array:
            return pa.array(has(values.to_numpy(zero_copy_only=False)))

        return test(hashes)


def build(keys: DataFrame, column: str = "h", bits: int | None = None) -> Bloom:
    """The filter of a table's 64-bit hashes. Its size follows from their number, up to ``MOST`` bits; ``bits`` (a power of two) sets it.

    Tasks combine their keys into pages of bits before the shuffle, and one row a page reaches the driver."""
    spark = keys.sparkSession
    if bits is None:
        n = keys.count()
        bits = min(MOST, max(LEAST, 1 << (PER_KEY * n - 1).bit_length() if n else LEAST))
    h = F.col(column)
    both = F.array(*[half.bitwiseAND(F.lit(bits - 1)) + 1 for half in (h, F.shiftrightunsigned(h, 32))])
    at = keys.where(h.isNotNull()).select(F.explode(both).alias("at"))
    pages = at.groupBy(F.bitmap_bucket_number("at").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map")).toArrow()
    held = np.zeros(max(bits, PAGE) // 8, np.uint8)
    for page, map in zip(pages.column("page").to_pylist(), pages.column("map")):
        held[(page - 1) * (PAGE // 8): page * (PAGE // 8)] = np.frombuffer(map.as_buffer(), np.uint8)
    return Bloom(spark.sparkContext.broadcast(held), bits)

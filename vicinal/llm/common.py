"""What several operators share: tables in the shared folder, buckets cut into bounded cells, connected components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder that the cluster names in ``spark.checkpoint.dir``. Where that is unset, a local
    session gets a temporary folder of its own; a cluster gets an error, because its executors share no such folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        sc = spark.sparkContext
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own.setdefault(sc.applicationId, None) or tempfile.mkdtemp(prefix="run-", dir="/tmp")
        _own[sc.applicationId] = base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: later steps neither repeat the work nor depend on an executor."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: Column) -> Column:
    """Number of words (runs of anything but ASCII white space); 0 for a missing text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def met_in(df: DataFrame, keys: list[str], spread: Column, rows: int, size: Column | None = None, most: int = 1) -> DataFrame:
    """Rows of every bucket (equal ``keys``) that has two or more, once for each cell they belong to: any two rows of a bucket meet in exactly
    one cell of at most about ``2 * rows`` rows. A bucket of up to ``rows`` rows is one cell (``side`` 0). A larger one is cut
    into n chunks by ``spread``, and each pair of chunks is a cell, to which one brings side 1 and the other side 2.
    So a hot bucket becomes many tasks, and no task holds more than two chunks. Where a row's ``size`` is given, chunks are also cut to
    about ``most`` of it. Adds ``cell_i``, ``cell_j``, ``side``."""
    amount = F.sum(size) / most if size is not None else F.lit(0.0)
    sized = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.greatest(F.count(F.lit(1)) / rows, amount).alias("_k")).where("_n > 1")
    met = df.join(sized, keys).withColumn("_k", F.greatest(F.ceil("_k"), F.lit(1)).cast("int"))
    met = met.withColumn("_c", F.pmod(F.xxhash64(spread, F.lit(7)), F.col("_k")).cast("int"))
    at = F.explode(F.sequence(F.lit(0), F.col("_k") - 1))
    met = met.select("*", at.alias("_o"))
    met = met.withColumn("cell_i", F.least("_c", "_o")).withColumn("cell_j", F.greatest("_c", "_o"))
    side = F.when(F.col("_c") == F.col("_o"), 0).when(F.col("_c") < F.col("_o"), 1).otherwise(2)
    return met.withColumn("side", side.cast("int")).drop("_n", "_k", "_c", "_o")


def in_cells(met: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``met_in`` with every cell together in one task, cell by cell."""
    where = [*keys, "cell_i", "cell_j"]
    return met.repartition(partitions(met.sparkSession), *where).sortWithinPartitions(*where)


def cells(df: DataFrame, keys: list[str], spread: Column, rows: int) -> DataFrame:
    """``df`` dealt to its cells."""
    return in_cells(met_in(df, keys, spread, rows), keys)


def whole_groups(batches, keys: list[str]):
    """From record batches sorted by integer ``keys``: (table, bounds) such that ``bounds`` cut the table into whole
    groups. Holds one group more than a batch at most."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
            if held:
                change[0] |= held[-1].column(k)[-1].as_py() != v[0]
        at = np.flatnonzero(change)
        if not len(at):
            held.append(batch)
            continue
        if at[-1]:
            held.append(batch.slice(0, at[-1]))
        if held:
            yield _bounded(held, keys)
        held = [batch.slice(at[-1])]
    if held:
        yield _bounded(held, keys)


def _bounded(held, keys):
    table = pa.Table.from_batches(held).combine_chunks()
    change = np.ones(table.num_rows, bool)
    change[1:] = False
    for k in keys:
        v = table.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return table, np.append(np.flatnonzero(change), table.num_rows)


HOT = 4096      # groups of this share of all rows or more are at most so many


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of their group, one row of ``groups`` for each set of ``keys`` (nulls are equal to each other); ``size``
    is the group's number of rows. Groups with more than 1 / HOT of all rows number less than HOT: they are broadcast and their rows
    stay where they are. The rest meets in a shuffle in which no key can have more than that share."""
    least = max(1, (rows.agg(F.count(F.lit(1))).first()[0]) // HOT)
    named = groups.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    hot, cold = F.broadcast(named.where(F.col(size) > least)), named.where(F.col(size) <= least)
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    drop = [f"__{k}" for k in keys]
    return rows.join(hot, same).drop(*drop).unionByName(rows.join(hot, same, "left_anti").join(cold, same, how).drop(*drop))


class Forest:
    """Union by smallest index over 0..n-1; keeps only the links that joined two trees."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.kept: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def link(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.kept.append((a, b))


def components(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: non-null longs), root being the smallest node reachable.

    Alternating large-star and small-star steps: a round moves every neighbour to the smallest one by joins and partial
    aggregates, so a hub is never one task's list, and the number of rounds grows with the logarithm of the longest
    path. Each round is a written table; only its row count and checksum reach the driver."""
    spark = edges.sparkSession
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = None
    for _ in range(rounds):
        got = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if (got.n, got.s) == mark or not got.n:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b"), F.col("b"))).distinct()
        mark = (got.n, got.s)
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        now = cut(small.select("a", F.col("m").alias("b")).union(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(), name)
    raise RuntimeError(f"components of {name}: not settled after {rounds} rounds")

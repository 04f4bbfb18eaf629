"""Size rules: what may be broadcast, how large a block may get, and where shared scratch tables go."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinal.spec import SpecError


@dataclass(frozen=True)
class Limits:
    query_rows: int = 20_000          # query rows one broadcast block may hold
    query_bytes: int = 64 << 20       # and their vector bytes
    state_rows: int = 4_000_000       # running hits one task may hold (queries x k)
    block_bytes: int = 128 << 20      # corpus vector bytes of one grid cell
    join_rows: int = 1_000_000        # rows of hits that may be broadcast into an id join
    model_bytes: int = 512 << 20      # trained tables held on the driver and broadcast
    scan_tasks: int = 20_000          # scan tasks beyond which input splits are joined into longer ones


LIMITS = Limits()


def query_cap(dim: int, k: int, limits: Limits) -> int:
    """Most query rows that a broadcast block may hold for this width and depth."""
    return max(1, min(limits.query_rows, limits.query_bytes // (8 * max(1, dim)), limits.state_rows // max(1, k)))


def vector_length(df: DataFrame, vec: str, of: Column | None = None) -> int | None:
    """Length of the first vector (bytes for packed codes), or None for a table without any."""
    kind = df.schema[vec].dataType.typeName()
    if kind == "array" and df.schema[vec].dataType.elementType.typeName() == "array":
        # Rows hold several vectors each: the bound is the longest list times the widest vector.
        row = df.select(F.max(F.size(vec)).alias("n"), F.max(F.size(F.col(vec)[0])).alias("d")).first()
        return None if row.n is None else row.n * (row.d or 1)
    size = F.octet_length(vec) if kind == "binary" else F.size(vec)
    row = df.where(F.col(vec).isNotNull()).select(size.alias("n")).first()
    return None if row is None else row.n


def parallelism(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def few_partitions(df: DataFrame) -> DataFrame:
    """Cap the number of scan tasks. A scan task streams its rows and emits at most k per query, so fewer,
    longer tasks shrink what the merge has to shuffle. The cap is far above any cluster's core count, also where
    executors are still being added, and coalesce never adds a shuffle."""
    return df.coalesce(max(LIMITS.scan_tasks, 4 * parallelism(df.sparkSession)))


def _shared(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``. Only a local session may do without one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise SpecError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared folder."""
    return f"{_shared(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame) -> DataFrame:
    """Materialize on reliable storage so that later steps neither recompute nor depend on executors."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(_shared(df.sparkSession))
    return df.checkpoint()

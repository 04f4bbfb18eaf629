import os
import sys

import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    yield spark


def table(spark, rows, id="id", vec="vec", kind="float"):
    """Rows given as ``{id: vector}`` or a matrix."""
    items = rows.items() if isinstance(rows, dict) else enumerate(rows)
    cast = float if kind in ("float", "double") else int
    return spark.createDataFrame([(int(i), None if v is None else [cast(x) for x in np.asarray(v).tolist()]) for i, v in items],
                                 f"{id} bigint, {vec} array<{kind}>")


def query(spark, *vectors, kind="float"):
    return table(spark, {i: v for i, v in enumerate(vectors)}, "query_id", "query_vec", kind)


def uniform(n, dim, seed):
    return np.random.default_rng(seed).random((n, dim)).astype(np.float32)


def distances(space, q, c):
    q, c = np.asarray(q, float), np.asarray(c, float)
    if space == "l2":
        return ((q[:, None] - c[None]) ** 2).sum(-1)
    if space == "l1":
        return np.abs(q[:, None] - c[None]).sum(-1)
    if space == "linf":
        return np.abs(q[:, None] - c[None]).max(-1)
    if space == "innerproduct":
        return -(q @ c.T)
    return 1 - q @ c.T / np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1))


def nearest(space, q, c, k):
    d = distances(space, q, c)
    return np.lexsort((np.broadcast_to(np.arange(d.shape[1]), d.shape), np.round(d, 9)), axis=1)[:, :k]


def ids(hits, k=None):
    pdf = hits.toPandas().sort_values(["query_id", "rank"])
    return [list(g.id) for _, g in pdf.groupby("query_id")]

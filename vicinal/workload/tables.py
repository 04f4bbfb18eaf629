"""Inputs of the registered queries, all derived by Spark from the given tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vicinal.operators.encoders import BitQuantizer, ProductQuantizer
from vicinal.operators.training import fit_scalar_quantizer
from vicinal.sources.models import Model
from vicinal.spec import VectorSpec

DIM = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


def queries(spark, sf_dir, *extra) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"), *extra)


def byte_vectors(vec: str) -> Column:
    return F.transform(vec, lambda x: F.round(x.cast("double") * 127).cast("tinyint"))


def children(spark, sf_dir) -> DataFrame:
    """Parents of five vectors each, as an array of structs."""
    e = table(spark, sf_dir, "embeddings")
    child = F.struct((F.col("vec_id") % 5).alias("place"), F.col("embedding").alias("vec"), "label")
    return e.groupBy(F.floor(F.col("vec_id") / 5).alias("id")).agg(F.sort_array(F.collect_list(child)).alias("children"))


def child_rows(spark, sf_dir) -> DataFrame:
    from vicinal.operators.nested import explode_children

    return explode_children(children(spark, sf_dir), "id", "children").where(F.col("vec").isNotNull())


def token_sets(spark, sf_dir, id: str, vecs: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    member = F.struct((F.col("vec_id") % 4).alias("p"), "embedding")
    return (e.groupBy(F.floor(F.col("vec_id") / 4).alias(id)).agg(F.sort_array(F.collect_list(member)).alias("m"))
            .select(id, F.col("m.embedding").alias(vecs)))


def mean_rows(df: DataFrame, key: str, vec: str) -> np.ndarray:
    """Mean vector of each key 0, 1, 2, ..."""
    rows = df.select(key, F.posexplode(vec).alias("pos", "x")).groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("m")).collect()
    out = np.zeros((max(r[key] for r in rows) + 1, DIM))
    for r in rows:
        out[r[key], r.pos] = r.m
    return out


def label_means(spark, sf_dir) -> np.ndarray:
    """Mean vector of each label: 10 rows, used as fixed coarse centroids and codebooks."""
    return mean_rows(table(spark, sf_dir, "embeddings"), "label", "embedding")


def ivf_model(spark, sf_dir, space: str = "l2") -> Model:
    means = label_means(spark, sf_dir)
    return Model(VectorSpec(DIM, space=space, method="ivf", params={"nlist": len(means)}), None, means)


def binary_corpus(spark, sf_dir) -> DataFrame:
    """The signs of the vectors as packed bits."""
    return corpus(spark, sf_dir).select("id", signed_bits("vec").alias("vec"), "label")


def label_codes(spark, sf_dir) -> np.ndarray:
    """Majority of every label's sign bits: 10 rows, used as fixed coarse centroids of binary vectors."""
    e = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    rows = e.groupBy("label", "pos").agg((2 * F.sum((F.col("x") > 0).cast("int")) > F.count("x")).alias("bit")).collect()
    out = np.zeros((max(r.label for r in rows) + 1, DIM), np.uint8)
    for r in rows:
        out[r.label, r.pos] = r.bit
    return np.packbits(out, axis=1)


def binary_ivf_model(spark, sf_dir) -> Model:
    codes = label_codes(spark, sf_dir)
    return Model(VectorSpec(DIM, data_type="binary", method="ivf", params={"nlist": len(codes)}), None, codes)


def bit_model(spark, sf_dir, bits: int = 1, space: str = "l2") -> Model:
    quantizer = fit_scalar_quantizer(corpus(spark, sf_dir), bits, sample=None)
    return Model(VectorSpec(DIM, space=space, encoder="binary", mode="on_disk",
                            compression={1: "32x", 2: "16x", 4: "8x"}[bits], params={"bits": bits}), quantizer)


def label_codebook(spark, sf_dir, m: int = 8) -> ProductQuantizer:
    means = label_means(spark, sf_dir)
    return ProductQuantizer(means.reshape(len(means), m, DIM // m).transpose(1, 0, 2))


def wide_codebook(spark, sf_dir, m: int = 8, steps: int = 40) -> ProductQuantizer:
    """4,000 fixed centroids a sub-vector, made of all pairs of label means: a + t * b with ``steps`` factors t."""
    means = label_means(spark, sf_dir)
    factors = (np.arange(steps) - steps / 2 + 0.5) / 8
    rows = (means[:, None, None] + factors[None, None, :, None] * means[None, :, None]).reshape(-1, DIM)
    return ProductQuantizer(rows.reshape(len(rows), m, DIM // m).transpose(1, 0, 2))


def signed_bits(vec: str) -> Column:
    from vicinal.sources.vectors import packed_bits

    return packed_bits(vec, 0.0)


def plain_bits(spark, sf_dir) -> BitQuantizer:
    return BitQuantizer(np.zeros((1, DIM)))


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Six decimals, so that two engines adding in different orders agree."""
    return df.withColumns({n: six_decimals(n) if df.schema[n].dataType == T.DoubleType() else F.round(n, 6) for n in names})


def six_decimals(name: str) -> Column:
    """``round(name, 6)`` of a double, which goes by way of decimal text. A whole number of millionths is divided outright, to the same value;
    only what lies near the middle of two, or is large, is left to that."""
    x = F.col(name)
    whole = F.rint(x * F.lit(1e6))
    return F.when((F.abs(x) < 1e3) & (F.abs(x * F.lit(1e6) - whole) < 0.4999), whole / F.lit(1e6) + F.lit(0.0)).otherwise(F.round(name, 6))


def flat(df: DataFrame, id: str, vec: str) -> DataFrame:
    """One row per element of a vector column."""
    return df.select(id, F.posexplode(vec).alias("pos", "value")).withColumn("value", F.round(F.col("value").cast("double"), 6))

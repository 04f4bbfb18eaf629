import numpy as np
from pyspark.sql import functions as F

from vicinal.plans import bloom


def test_every_key_is_found_and_few_others(spark):
    keys = spark.range(40_000).select(F.xxhash64("id").alias("h"))
    got = bloom.build(keys)
    assert got.bits <= bloom.MOST
    seen = spark.range(80_000).select("id", got.column(F.xxhash64("id")).alias("in"))
    n = {r[0]: r[1] for r in seen.where("in").groupBy((F.col("id") < 40_000).alias("k")).count().collect()}
    assert n[True] == 40_000 and n.get(False, 0) < 2_000


def test_plain_rule_and_small_filters(spark):
    values = np.random.default_rng(0).integers(-(1 << 63), (1 << 63) - 1, 500)
    got = bloom.build(spark.createDataFrame([(int(v),) for v in values] + [(None,)], "h long"), bits=1 << 15)
    bits = {int(v) % (1 << 15) for v in values} | {(int(v) % (1 << 64) >> 32) % (1 << 15) for v in values}
    others = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 5_000)
    want = [int(v) % (1 << 15) in bits and (int(v) % (1 << 64) >> 32) % (1 << 15) in bits for v in others]
    assert got.has(values).all() and got.has(others).tolist() == want


def test_no_keys(spark):
    assert not bloom.build(spark.range(0).select(F.col("id").alias("h"))).has(np.arange(100)).any()

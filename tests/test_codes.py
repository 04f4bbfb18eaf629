"""Product codes of two bytes, rotations without a matrix, samples without a sort."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import ids, nearest, query, table, uniform
from vicinal.operators import encoders as E
from vicinal.operators import training as Q
from vicinal.operators.approx import Index
from vicinal.operators.knn import knn_join
from vicinal.plans import limits as L
from vicinal.sources.models import Model, fit_model
from vicinal.spec import SpecError, VectorSpec, resolve_spec


@pytest.mark.parametrize("k, width, seed", [(1024, 2, 1), (1500, 8, 2), (4096, 3, 3), (1024, 1, 4)])
def test_two_levels_find_the_nearest(k, width, seed):
    rng = np.random.default_rng(seed)
    centroids, rows = rng.normal(size=(k, width)), rng.normal(size=(700, width)) * 1.5
    rows[:50] = centroids[:50]
    assert (E.nearest_in_two_levels(rows, centroids) == E.nearest_centroids(rows, centroids, 1)[:, 0]).all()
    same = np.zeros((k, width))
    assert (E.nearest_in_two_levels(rows, same) == 0).all()


@pytest.mark.parametrize("code_size", [9, 10, 12])
def test_long_codes_train_store_and_search(spark, code_size, tmp_path):
    n = 6000 if code_size == 12 else 2500
    x = uniform(n, 8, code_size)
    c = table(spark, x)
    spec = VectorSpec(8, encoder="pq", params={"m": 2, "code_size": code_size})
    model = fit_model(c, spec, iterations=2)
    assert model.encoder.codebook.shape == (2, 1 << code_size, 4)
    coded = model.encode(c)
    assert coded.select(F.max(F.octet_length("code")), F.min(F.octet_length("code"))).first() == (4, 4)
    again = E.unpack(model.to_blob())[0]
    codes = again.encode_rows(x[:200].astype(np.float64))
    near = np.stack([((x[:200, None, s:s + 4] - again.codebook[s // 4][None]) ** 2).sum(-1).argmin(1) for s in (0, 4)], axis=1)
    assert (again.numbers(codes) == near).mean() > 0.999
    q = uniform(20, 8, 99)
    got = ids(knn_join(query(spark, *q), Index(coded, model), 10, mode="pq"))
    back = again.decode_rows(again.encode_rows(x.astype(np.float64)), "l2")
    assert np.mean([len(set(a) & set(b)) for a, b in zip(got, nearest("l2", q, back, 10).tolist())]) > 9.5
    truth = nearest("l2", q, x, 10).tolist()
    short = fit_model(c, VectorSpec(8, encoder="pq", params={"m": 2, "code_size": 5}), iterations=2)
    less = ids(knn_join(query(spark, *q), Index(short.encode(c), short), 10, mode="pq"))
    share = lambda found: np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found, truth)])
    assert share(got) > share(less) + 0.1


def test_code_sizes_beyond_two_bytes_are_refused():
    with pytest.raises(SpecError):
        resolve_spec(8, encoder="pq", params={"m": 2, "code_size": 17})


@pytest.mark.parametrize("dim", [1, 2, 3, 64, 100, 768, 16_000])
def test_structured_rotation_keeps_lengths_and_angles(dim):
    rows = np.random.default_rng(dim).normal(size=(6, dim))
    turned = E.rotated(rows, E.structured_rotation(dim))
    assert np.allclose(turned @ turned.T, rows @ rows.T, rtol=1e-6, atol=1e-8 * dim)
    assert (turned == E.rotated(rows, E.structured_rotation(dim))).all()
    if dim >= 64:
        peak = np.zeros((1, dim))
        peak[0, dim // 3] = 1.0
        spread = np.abs(E.rotated(peak, E.structured_rotation(dim)))
        assert spread.max() < 8 * dim ** -0.5 and (spread > 0).mean() > 0.9


def test_wide_vectors_train_with_a_rotation(spark):
    dim = 16_000
    rng = np.random.default_rng(1)
    c = spark.createDataFrame([(i, [float(v) for v in rng.normal(size=dim).astype(np.float32)]) for i in range(12)], "id bigint, vec array<float>")
    quantizer = Q.fit_scalar_quantizer(c, 1, rotate=True)
    assert quantizer.rotation.shape == (2,) and quantizer.thresholds.shape == (1, dim)
    again = E.unpack(E.pack(quantizer))[0]
    assert (again.encode_rows(rng.normal(size=(2, dim))).shape) == (2, dim // 8)


def test_structured_rotation_recalls_what_the_dense_one_does(spark, monkeypatch):
    x, q = uniform(1100, 32, 1), uniform(60, 32, 2)
    # Most of the variance in few dimensions: where a rotation helps.
    x[:, 4:] *= 0.05
    q[:, 4:] *= 0.05
    c, asked = table(spark, x), query(spark, *q)
    truth = nearest("l2", q, x, 50).tolist()

    def recall(quantizer):
        model = Model(VectorSpec(32, encoder="binary", mode="on_disk", compression="32x", params={"bits": 1}), quantizer)
        got = ids(knn_join(asked, Index(model.encode(c), model), 50, mode="binary", rescore=2))
        return np.mean([len(set(a) & set(b)) / 50 for a, b in zip(got, truth)])

    dense = recall(Q.fit_scalar_quantizer(c, 1, rotate=True))
    monkeypatch.setattr(Q, "LIMITS", L.Limits(model_bytes=1000))
    quantizer = Q.fit_scalar_quantizer(c, 1, matrix=E.structured_rotation(32))
    assert recall(quantizer) > dense - 0.05


@pytest.mark.parametrize("n", [1, 7, 500, 4999, 5000, 9000])
def test_samples_are_exact_in_number_and_the_smallest_hashes(spark, monkeypatch, n):
    monkeypatch.setattr(Q, "SLICE_ROWS", 1)
    c = spark.range(5000).withColumn("vec", F.array(F.lit(1.0)))
    got = Q.sample_vectors(c, n, seed=5)
    want = [r.id for r in c.orderBy(F.xxhash64(F.lit(5), "id")).limit(n).collect()]
    assert sorted(r.id for r in got.collect()) == sorted(want)


def test_a_sample_of_ten_million_needs_no_sort(spark):
    c = spark.range(12_000_000).withColumn("vec", F.lit(None).cast("array<float>"))
    got = Q.sample_vectors(c.repartition(8), 10_000_000)
    assert "Sort" not in got._jdf.queryExecution().executedPlan().toString() and got.count() == 10_000_000

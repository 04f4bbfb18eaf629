"""Inverted files over binary vectors, and the spaces that have none."""

import numpy as np
import pytest

from vicinal.operators.approx import Index, assign_lists
from vicinal.operators.encoders import nearest_centroids
from vicinal.operators.knn import knn_join
from vicinal.operators.training import fit_ivf, kmajority
from vicinal.plans.limits import Limits
from vicinal.sources.models import Model, fit_model, load_model, train_model
from vicinal.spec import SpecError, VectorSpec, resolve_spec, validate_spec
from tests.conftest import query, table, uniform


def codes(spark, rows, id="id", vec="vec"):
    return spark.createDataFrame([(i, bytearray(r)) for i, r in enumerate(np.asarray(rows, np.uint8))], f"{id} bigint, {vec} binary")


def clusters(n, width, seed, centres=5, flips=6):
    rng = np.random.default_rng(seed)
    heads = rng.integers(0, 2, (centres, 8 * width))
    bits = heads[np.arange(n) % centres].copy()
    for b in bits:
        b[rng.choice(8 * width, flips, replace=False)] ^= 1
    return np.packbits(bits.astype(np.uint8), axis=1), np.packbits(heads.astype(np.uint8), axis=1)


def differ(a, b):
    return np.unpackbits(a[:, None] ^ b[None], axis=2).sum(axis=2)


def plain_majority(rows, start, rounds):
    bits, now = np.unpackbits(rows, axis=1).astype(int), np.unpackbits(start, axis=1).astype(int)
    for _ in range(rounds):
        near = differ(rows, np.packbits(now.astype(np.uint8), axis=1)).argmin(axis=1)
        for j in range(len(now)):
            mine = bits[near == j]
            if len(mine):
                twice = 2 * mine.sum(axis=0)
                now[j] = np.where(twice > len(mine), 1, np.where(twice < len(mine), 0, now[j]))
    return np.packbits(now.astype(np.uint8), axis=1)


@pytest.mark.parametrize("width", [1, 3, 8, 11])
def test_majority_equals_plain_rounds(spark, width):
    rows, _ = clusters(120, width, width, flips=3)
    start = rows[:4] if len(np.unique(rows[:4], axis=0)) == 4 else np.unique(rows, axis=0)[:4]
    got = kmajority(codes(spark, rows).repartition(3), start, iterations=2)
    want = plain_majority(rows, start, 2)
    near = differ(rows, start).argmin(axis=1)
    if len(np.unique(near)) == 4:
        assert (got == want).all()


def test_training_finds_the_clusters(spark):
    rows, heads = clusters(400, 8, 2)
    got = fit_ivf(codes(spark, rows), 5, space="hamming", seed=3, iterations=20)
    assert got.dtype == np.uint8 and len(np.unique(got, axis=0)) == 5
    assert differ(rows, got).min(axis=1).mean() < 1.35 * differ(rows, heads).min(axis=1).mean() + 3


def test_a_centroid_without_rows_takes_over_a_part(spark):
    rows, _ = clusters(60, 2, 4, centres=1, flips=4)
    far = np.full((1, 2), 0, np.uint8) ^ ~rows[:1]
    got = kmajority(codes(spark, rows), np.concatenate([rows[:1], far, far]), iterations=6)
    assert len(np.unique(got, axis=0)) == 3


@pytest.mark.parametrize("limits", [Limits(), Limits(query_rows=8, block_bytes=8 * 8 * 60)], ids=["broadcast", "cells"])
def test_search_equals_the_visited_lists(spark, limits):
    rows, heads = clusters(300, 8, 6, flips=14)
    asked, _ = clusters(30, 8, 6, flips=10)
    model = Model(VectorSpec(64, data_type="binary", method="ivf", params={"nlist": 5}), None, heads)
    index = Index(model.encode(codes(spark, rows)), model)
    got = knn_join(codes(spark, asked, "query_id", "query_vec"), index, 4, "hamming", mode="ivf", nprobes=2, limits=limits)
    out = got.toPandas().sort_values(["query_id", "rank"])
    home, visits, far = differ(rows, heads).argmin(axis=1), np.argsort(differ(asked, heads), axis=1, kind="stable")[:, :2], differ(asked, rows)
    want = []
    for i in range(len(asked)):
        there = np.flatnonzero(np.isin(home, visits[i]))
        want += [(i, int(there[j])) for j in np.argsort(far[i, there], kind="stable")[:4]]
    assert list(zip(out.query_id, out.id)) == want


def test_trained_kept_and_loaded(spark, tmp_path):
    rows, _ = clusters(80, 4, 9)
    spec = VectorSpec(32, data_type="binary", method="ivf", params={"nlist": 4, "nprobes": 4})
    train_model(codes(spark, rows), "bits", spec, f"{tmp_path}/m", iterations=3)
    model = load_model(spark, f"{tmp_path}/m", "bits")
    assert model.space == "hamming" and model.centroids.dtype == np.uint8
    index = Index(model.encode(codes(spark, rows)), model)
    asked = codes(spark, rows[:10], "query_id", "query_vec")
    every = [tuple(r) for r in knn_join(asked, index, 3, "hamming", mode="ivf").select("query_id", "id", "rank", "distance").collect()]
    assert sorted(every) == sorted(tuple(r) for r in knn_join(asked, codes(spark, rows), 3, "hamming").select("query_id", "id", "rank", "distance").collect())
    with pytest.raises(SpecError):
        train_model(codes(spark, rows), "short", VectorSpec(64, data_type="binary", method="ivf"), f"{tmp_path}/m")


@pytest.mark.parametrize("space", ["l1", "linf"])
def test_spaces_without_lists_are_refused(spark, space):
    c = table(spark, uniform(40, 4, 1))
    with pytest.raises(SpecError):
        resolve_spec(4, space=space, method="ivf")
    with pytest.raises(SpecError):
        fit_ivf(c, 4, space=space)
    with pytest.raises(SpecError):
        assign_lists(c, uniform(4, 4, 2), space)
    with pytest.raises(SpecError):
        nearest_centroids(uniform(3, 4, 1), uniform(3, 4, 2), 1, space)
    model = fit_model(c, validate_spec(VectorSpec(4, method="ivf", params={"nlist": 4})))
    with pytest.raises(SpecError):
        knn_join(query(spark, *uniform(2, 4, 3)), Index(model.encode(c), model), 2, space, mode="ivf")


def test_binary_lists_need_the_hamming_space(spark):
    rows, heads = clusters(20, 1, 3)
    model = Model(VectorSpec(8, data_type="binary", method="ivf"), None, heads)
    with pytest.raises(SpecError):
        knn_join(query(spark, *uniform(2, 8, 3)), Index(model.encode(codes(spark, rows)), model), 2, "l2", mode="ivf")

import numpy as np
import pytest

from vicinal.llm.embeddings import near_duplicates
from .conftest import frame, least_reachable

SCHEMA = "vec_id long, embedding array<float>, node string, n_links string"


def vectors(dim, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(60, dim))
    rows = [base + rng.normal(size=base.shape) * s for s in (0, 0.15, 0.3, 0.45)]
    rows.append(base[:1] + rng.normal(size=(150, dim)) * 0.05)        # one crowded place
    rows.append(np.repeat(base[3:4] * 7, 20, axis=0))                 # copies up to length
    return np.concatenate(rows).astype(np.float32)


@pytest.mark.parametrize("dim, blocks, cell", [(64, 4, 8192), (64, 8, 40), (5, 4, 30), (1, 4, 100)])
def test_links_equal_brute_force(spark, dim, blocks, cell):
    x = vectors(dim, dim + blocks)
    ids = np.random.default_rng(1).permutation(len(x)) + 10
    bad = [None, [0.0] * dim, [float("nan")] * dim, [float("inf")] + [1.0] * (dim - 1), [None] * dim, []]
    rows = [(int(i), v.tolist(), "a", "b") for i, v in zip(ids, x)] + [(10_000 + n, v, "a", "b") for n, v in enumerate(bad)]
    rows += [(rows[5][0], (-x[5]).tolist(), "a", "b"), (rows[9][0], x[40].tolist(), "a", "b")]      # ids with two vectors
    rows += [(None, x[0].tolist(), "a", "b"), (20_000, [1.0] * (dim + 1), "a", "b"), rows[0], (20_001, [1e30] * dim, "a", "b"), (20_002, [1e-30] * dim, "a", "b")]
    got = near_duplicates(frame(spark, rows, SCHEMA), blocks=blocks, cell=cell)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    def unit(r):
        v = r[1]
        if r[0] is None or not v or any(c is None or not np.isfinite(c) for c in v) or not any(v):
            return None
        v = np.array(np.array(v, np.float32), float)
        return v / np.linalg.norm(v)
    u = [unit(r) for r in rows]
    near = lambda i, j: u[i] is not None and u[j] is not None and len(u[i]) == len(u[j]) and u[i] @ u[j] >= 0.9
    root = least_reachable(len(rows), near)
    best = {r: min(rows[i][0] for i in range(len(rows)) if root[i] == r) if u[r] is not None else rows[r][0] for r in set(root)}
    want = [(r[0], sum(near(i, j) for j in range(len(rows)) if j != i), best[root[i]], r[0] is None or r[0] == best[root[i]]) for i, r in enumerate(rows)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [], SCHEMA)).collect() == []


def test_an_id_with_two_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [-1.0, 0.0]), (0, [0.01, 1.0])]
    got = near_duplicates(frame(spark, [(*r, "a", "b") for r in rows], SCHEMA)).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 0, True), (1, 1, 0, False), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_wide_vectors_are_cut_into_smaller_chunks(spark):
    """Chunks are bounded by the components they hold as well; results don't depend on them."""
    x = vectors(12, 5)
    df = frame(spark, [(i, v.tolist(), "a", "b") for i, v in enumerate(x)], SCHEMA)
    whole = sorted(map(tuple, near_duplicates(df).collect()))
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    assert [r[1] for r in whole] == ((u @ u.T >= 0.9).sum(axis=1) - 1).tolist()
    assert sorted(map(tuple, near_duplicates(df, numbers=12 * 35).collect())) == whole


def test_a_slab_that_fits_a_task_is_sent_once(spark, monkeypatch):
    from vicinal.llm import embeddings

    sent, plain = [], embeddings.met_in
    monkeypatch.setattr(embeddings, "met_in", lambda df, *rest: sent.append((df, plain(df, *rest))) or sent[0][1])
    x = np.random.default_rng(0).normal(size=(12_000, 8))
    got = near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"), blocks=1)
    x = x.astype(np.float32).astype(float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = sum((np.array_split(u, 8)[n] @ u.T >= 0.9).sum() for n in range(8)) - len(u)
    assert got.agg({"n_links": "sum"}).first()[0] == links
    rows, dealt = sent[0]
    assert dealt.count() <= rows.count()

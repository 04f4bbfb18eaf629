import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import distances, query, table, uniform
from vicinal.operators.approx import Index
from vicinal.operators.nested import explode_children, nested_knn, nested_radius
from vicinal.operators.training import fit_scalar_quantizer
from vicinal.plans.limits import Limits
from vicinal.sources.models import Model
from vicinal.spec import SpecError, VectorSpec

GRID = Limits(query_rows=9, block_bytes=6 * 8 * 50)


def parents(spark, n, per, value=lambda i, j: [float(i), float(i)]):
    rows = [(i, i % 2 == 1, [(value(i, j), "true" if i % 2 else "false") for j in range(per)]) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, parking boolean, children array<struct<vec:array<float>,spot:string>>")


def test_best_parents(spark):
    rows = explode_children(parents(spark, 15, 2), "id", "children")
    got = nested_knn(query(spark, [14, 14]), rows, 2).orderBy("rank").collect()
    # Both children of a parent are equally far: the first one stands.
    assert [(r.parent_id, r.child_pos, r.rank) for r in got] == [(14, 0, 1), (13, 0, 2)]
    assert [r.score for r in got] == pytest.approx([1.0, 1 / 3])


def test_empty_parents_keep_a_row_and_never_match(spark):
    df = spark.createDataFrame([(1, []), (2, None), (3, [([1.0, 0.0],)])], "id bigint, children array<struct<vec:array<float>>>")
    rows = explode_children(df, "id", "children")
    assert rows.count() == 3
    assert [r.parent_id for r in nested_knn(query(spark, [1, 0]), rows, 5).collect()] == [3]


@pytest.mark.parametrize("limits", [Limits(), GRID], ids=["broadcast", "grid"])
@pytest.mark.parametrize("hot", [False, True])
def test_equals_brute_force(spark, limits, hot):
    c, q = uniform(240, 6, 1), uniform(30, 6, 2)
    parent = np.arange(240) // 4
    if hot:
        parent[:80] = 0  # one parent holds a third of all children
    pos = np.array([np.count_nonzero(parent[:i] == parent[i]) for i in range(240)])
    rows = spark.createDataFrame([(int(p), int(j), v.tolist()) for p, j, v in zip(parent, pos, c)],
                                 "parent_id bigint, child_pos int, vec array<float>").repartition(5)
    got = nested_knn(query(spark, *q), rows, 4, limits=limits).toPandas().sort_values(["query_id", "rank"])
    d = distances("l2", q, c)
    for i in range(30):
        best = {p: min((d[i, j], pos[j]) for j in np.flatnonzero(parent == p)) for p in np.unique(parent)}
        want = sorted(best, key=lambda p: (best[p][0], p))[:4]
        mine = got[got.query_id == i]
        assert list(mine.parent_id) == want and list(mine.child_pos) == [best[p][1] for p in want]


def test_expand_filters_and_radius(spark):
    df = parents(spark, 5, 2, lambda i, j: [float(i), float(i + j)])
    rows = explode_children(df, "id", "children")
    q = query(spark, [4, 4])
    every = nested_knn(q, rows, 3, expand=True, keep=["spot"]).toPandas()
    assert sorted(zip(every.parent_id, every.child_pos)) == [(p, j) for p in (2, 3, 4) for j in (0, 1)]
    by_child = nested_knn(q, rows, 5, child_filter="spot = 'true'").toPandas()
    assert set(by_child.parent_id) == {1, 3}
    by_parent = nested_knn(q, rows, 5, parent_filter=df.where("not parking").select(F.col("id").alias("parent_id"))).toPandas()
    assert set(by_parent.parent_id) == {0, 2, 4}
    near = nested_radius(q, rows, max_distance=2.0).toPandas()
    assert set(near.parent_id) == {3, 4} and (near.distance <= 2).all()
    one = nested_radius(q, rows, max_distance=2.0, max_results=1).toPandas()
    assert list(one.parent_id) == [4]


def test_rescoring_looks_at_all_siblings(spark):
    c, q = uniform(200, 16, 3), uniform(20, 16, 4)
    rows = spark.createDataFrame([(i // 4, i % 4, v.tolist()) for i, v in enumerate(c)],
                                 "parent_id bigint, child_pos int, vec array<float>")
    bits = fit_scalar_quantizer(rows.withColumn("id", F.col("parent_id") * 4 + F.col("child_pos")), 1)
    model = Model(VectorSpec(16, encoder="binary", params={"bits": 1}), bits)
    # All 50 parents are candidates, so the second pass must give the exact result.
    got = nested_knn(query(spark, *q), Index(model.encode(rows), model), 5, mode="binary", rescore=1)
    want = nested_knn(query(spark, *q), rows, 5)
    assert got.exceptAll(want).count() == 0 and got.count() == 100


def test_expanding_needs_a_nested_table(spark):
    flat = spark.createDataFrame([(1, [1.0])], "id bigint, vec array<float>")
    with pytest.raises(SpecError):
        nested_knn(query(spark, [1]), flat, 1, expand=True)


@pytest.mark.parametrize("mode", ["exact", "binary"])
@pytest.mark.parametrize("expand", [False, True])
def test_conditions_hold_in_every_form(spark, mode, expand):
    c, q = uniform(120, 8, 3), uniform(6, 8, 4)
    rows = spark.createDataFrame([(i // 4, i % 4, c[i].tolist(), i % 3) for i in range(120)], "parent_id int, child_pos int, vec array<float>, label int")
    asked = query(spark, *q).withColumn("want", (F.col("query_id") % 3).cast("int"))
    model = Model(VectorSpec(8, encoder="binary", params={"bits": 1}), fit_scalar_quantizer(rows, 1, id="parent_id"), id="parent_id")
    table = rows if mode == "exact" else Index(model.encode(rows), model)
    names = dict(mode=mode, **({} if mode == "exact" else dict(rescore=100)))
    got = nested_knn(asked, table, 5, expand=expand, on=[("want", "label")], **names).collect()
    d = distances("l2", q, c)
    for i in range(6):
        best = sorted((min(d[i, j] for j in range(4 * p, 4 * p + 4) if j % 3 == i % 3), p) for p in range(30) if any(j % 3 == i % 3 for j in range(4 * p, 4 * p + 4)))[:5]
        want = {(p, j % 4) for _, p in best for j in range(4 * p, 4 * p + 4) if j % 3 == i % 3}
        mine = {(r.parent_id, r.child_pos) for r in got if r.query_id == i}
        assert mine == want if expand else {p for p, _ in mine} == {p for _, p in best}


@pytest.mark.parametrize("limits", [Limits(), Limits(query_rows=7, block_bytes=6 * 8 * 40)], ids=["broadcast", "cells"])
def test_lists_and_a_parent_with_a_third_of_all_children(spark, limits):
    """Over lists, a parent's best child among the visited lists counts, wherever its children lie."""
    from vicinal.operators.encoders import nearest_centroids
    from vicinal.operators.training import fit_ivf
    from vicinal.spec import VectorSpec

    rng = np.random.default_rng(12)
    vecs, parents = rng.random((450, 6)).astype(np.float32), np.r_[np.zeros(150, int), rng.integers(1, 40, 300)]
    asked = rng.random((25, 6)).astype(np.float32)
    pos = {}
    rows = [(int(p), pos.setdefault(int(p), []).append(0) or len(pos[int(p)]) - 1, [float(x) for x in v]) for p, v in zip(parents, vecs)]
    df = spark.createDataFrame(rows, "parent_id bigint, child_pos int, vec array<float>").repartition(5)
    centroids = fit_ivf(df.selectExpr("parent_id * 1000 + child_pos as id", "vec"), 8)
    from vicinal.sources.models import Model

    model = Model(VectorSpec(6, method="ivf", params={"nlist": 8}), None, centroids)
    got = nested_knn(query(spark, *asked), Index(model.encode(df), model), 4, mode="ivf", nprobes=3, limits=limits)
    mine, lists = nearest_centroids(vecs, centroids, 1)[:, 0], nearest_centroids(asked, centroids, 3)
    want = []
    for i, x in enumerate(asked.astype(float)):
        best = {}
        for (p, at, _), v, home in zip(rows, vecs.astype(float), mine):
            if home in lists[i]:
                best[p] = min(best.get(p, (9e9, 0)), (((x - v) ** 2).sum(), at))
        want += [(i, p, at) for (_, at), p in sorted((v, p) for p, v in best.items())[:4]]
    out = got.toPandas().sort_values(["query_id", "rank"])
    assert list(zip(out.query_id, out.parent_id, out.child_pos)) == want
    assert sum(p == 0 for _, p, _ in want) > 10


def test_radius_by_query_with_conditions_and_columns(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i // 3), int(i % 3), [float(x) for x in rng.random(4)], int(i % 4)) for i in range(120)]
    df = spark.createDataFrame(rows, "parent_id bigint, child_pos int, vec array<float>, kind int")
    q = spark.createDataFrame([(n, [float(x) for x in rng.random(4)], n % 4, 0.1 + n / 20) for n in range(8)], "query_id bigint, query_vec array<float>, want int, reach double")
    want = {}
    for n, x, kind, reach in q.collect():
        for p, at, v, k in rows:
            far = sum((np.float32(a).astype(float) - np.float32(b).astype(float)) ** 2 for a, b in zip(x, v))
            if k != kind and far <= reach:
                want[n, p] = min(want.get((n, p), (9e9, 0, 0)), (far, at, k))
    for limits in (Limits(), GRID):
        got = nested_radius(q, df, max_distance="reach", on=[("want", "!=", "kind")], keep=["kind"], limits=limits).collect()
        assert {(r.query_id, r.parent_id): (r.child_pos, r.kind) for r in got} == {k: v[1:] for k, v in want.items()}


def test_winners_beyond_the_broadcast_limit(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i // 4), int(i % 4), [float(x) for x in rng.random(5)], int(i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "parent_id bigint, child_pos int, vec array<float>, kind int")
    q = query(spark, *rng.random((11, 5)).astype(np.float32))
    key = lambda r: (r.query_id, r.rank, r.child_pos)
    want = sorted(nested_knn(q, df, 3, expand=True, child_filter="kind <> 1", keep=["kind"]).collect(), key=key)
    got = nested_knn(q, df, 3, expand=True, child_filter="kind <> 1", keep=["kind"], limits=Limits(join_rows=5))
    assert sorted(got.collect(), key=key) == want and len(want) > 33


def test_many_winners_take_their_queries_to_the_children(spark):
    """The pairs with all children, vectors on both sides, are made by the last join and not dealt again."""
    rows = table(spark, uniform(200, 6, 71)).select(F.floor(F.col("id") / 4).alias("parent_id"), (F.col("id") % 4).alias("child_pos"), "vec")
    q = query(spark, *uniform(20, 6, 72))
    got = nested_knn(q, rows, 3, expand=True, limits=Limits(join_rows=5))
    joins = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert "parent_id" in joins[0]
    assert got.exceptAll(nested_knn(q, rows, 3, expand=True)).count() == 0 and got.count() == 20 * 3 * 4


def _grouped(n, dim, labels, batch, seed=3):
    """A comparison of 40 queries with n children, five a parent, in batches; brute force beside it."""
    import pyarrow as pa

    from vicinal.operators.blocks import list_array
    from vicinal.operators.scan import Scan, _Comparison

    c, q = uniform(n, dim, seed), uniform(40, dim, seed + 1)
    want = np.arange(40) % 3
    block = pa.table({"query_id": np.arange(40), "query_vec": list_array(q), "want": want})
    parts = [pa.RecordBatch.from_pydict({"parent": pa.array(np.arange(s, min(n, s + batch)) // 5), "pos": pa.array(np.arange(s, min(n, s + batch)) % 5),
                                         "vec": list_array(c[s:s + batch]), "label": pa.array(labels[s:s + batch])}) for s in range(0, n, batch)]
    scan = Scan("l2", "l2", "query_id", "query_vec", "parent", "vec", ("parent", "pos"), ("parent", "pos"), k=3, group="parent", conds=(("want", "!=", "label"),))
    both = _Comparison(scan, block)
    assert not list(both.feed(parts))
    found = next(both.finish())
    d = np.where(want[:, None] != labels[None], distances("l2", q, c), np.inf)
    best = d.reshape(40, -1, 5).min(axis=2)
    order = np.argsort(best, axis=1, kind="stable")[:, :3]
    return found, [(i, int(p), best[i, p]) for i in range(40) for p in order[i] if np.isfinite(best[i, p])]


def test_conditions_are_tested_on_candidates(monkeypatch):
    """Once every query has its parents, only pairs near enough are held against the conditions."""
    from vicinal.operators import blocks

    seen = []
    whole = blocks.allowed_pairs
    monkeypatch.setattr(blocks, "allowed_pairs", lambda conds, q, c: seen.append(q.num_rows * c.num_rows) or whole(conds, q, c))
    found, best = _grouped(20_000, 8, np.arange(20_000) % 3, 2_000)
    assert [(q, p) for q, p in zip(found["_q"].to_pylist(), found["parent"].to_pylist())] == [b[:2] for b in best]
    assert found["_raw"].to_pylist() == pytest.approx([b[2] for b in best])
    assert sum(seen) <= 40 * 4_000


def test_first_groups_may_be_excluded():
    """A third of the queries may not meet the first 400 parents: their bounds come from all the others."""
    labels = np.r_[np.ones(2_000, int), np.full(2_020, 3)]
    found, best = _grouped(4_020, 8, labels, 4_020)
    assert len(best) == 120
    assert [(q, p) for q, p in zip(found["_q"].to_pylist(), found["parent"].to_pylist())] == [b[:2] for b in best]


def test_set_places():
    from vicinal.operators.blocks import set_places

    rng = np.random.default_rng(0)
    for shape, part in (((0, 5), 0.5), ((1, 3), 1.0), ((7, 13), 0.0), ((40, 1001), 0.002), ((16, 64), 0.7)):
        ok = rng.random(shape) < part
        assert set_places(ok).tolist() == np.flatnonzero(ok).tolist()


def test_vectors_are_dealt_as_bytes(spark, monkeypatch):
    """Compared vectors reach the query blocks as bytes; a null or ragged one is refused as ever."""
    from vicinal.operators import scan as S

    kinds, plain = [], S._meet
    monkeypatch.setattr(S, "_meet", lambda scan, left, right, *rest: kinds.append(dict(right.dtypes)["vec"]) or plain(scan, left, right, *rest))
    c, q = uniform(60, 6, 1), uniform(30, 6, 2)
    for kind in ("float", "double"):
        rows = spark.createDataFrame([(i // 3, i % 3, c[i].tolist()) for i in range(60)], f"parent_id bigint, child_pos int, vec array<{kind}>")
        got = nested_knn(table(spark, q, "query_id", "query_vec", kind), rows, 4, limits=GRID).collect()
        best = distances("l2", q.astype(float), c.astype(float)).reshape(30, 20, 3).min(axis=2)
        assert {(r.query_id, r["rank"]): r.parent_id for r in got} == {(i, n + 1): p for i in range(30) for n, p in enumerate(np.argsort(best[i], kind="stable")[:4])}
    assert kinds == ["binary"] * 2
    with pytest.raises(Exception, match="same length"):
        nested_knn(table(spark, q, "query_id", "query_vec"), rows.union(spark.sql("select 99L, 0, array(1d)")), 4, limits=GRID).collect()


def nearest_children(q, rows, far):
    """{(query id, parent): (distance, position, kind)} by brute force; ids and parents may repeat or be null."""
    best = {}
    for who, a in q:
        for parent, pos, kind, b in rows:
            d = float(((np.asarray(a) - np.asarray(b)) ** 2).sum())
            least = (round(d, 9), pos, (kind is not None, kind or ""))
            if d <= far and (who, parent) not in best or d <= far and least < best[who, parent]:
                best[who, parent] = least
    return best


@pytest.mark.parametrize("repeated", [False, True], ids=["ids once", "ids twice"])
@pytest.mark.parametrize("batch", [7, 10_000])
def test_radius_beyond_a_block_shuffles_no_match(spark, batch, repeated):
    """Parents lie in any partition and batch, one holds a third of all children; ties, repeated rows and nulls count as they did."""
    rng = np.random.default_rng(41)
    q = [(i % 30 if repeated else i, rng.integers(0, 4, 3).tolist()) for i in range(60)] + [(None, [1, 1, 1])]
    rows = [(0 if i < 100 else None if i < 110 else i // 5, int(rng.integers(0, 6)), "a" if i % 3 else None, rng.integers(0, 4, 3).tolist()) for i in range(300)]
    qdf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in q], "query_id bigint, query_vec array<float>")
    df = spark.createDataFrame([(p, j, k, [float(x) for x in v]) for p, j, k, v in rows], "parent_id bigint, child_pos int, kind string, vec array<float>").repartition(5)
    want = nearest_children(q, rows, 3.0)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = nested_radius(qdf, df, max_distance=3.0, keep=["kind"], limits=GRID)
        assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()
        for found in (got, nested_radius(qdf, df, max_distance=3.0, keep=["kind"])):
            mine = [((r.query_id, r.parent_id), (round(r.distance, 9), r.child_pos, (r.kind is not None, r.kind or ""))) for r in found.collect()]
            assert len(mine) == len(want) and dict(mine) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_radius_beyond_a_block_with_parents_grouped_by_spark(spark):
    """Parents whose equality is Spark's own are grouped there."""
    rows = [(float("nan") if i % 2 else -0.0 if i % 4 else 0.0, i, [float(i % 3)]) for i in range(40)]
    df = spark.createDataFrame(rows, "parent_id double, child_pos int, vec array<float>")
    got = nested_radius(query(spark, *[[0.0]] * 20), df, max_distance=0.5, limits=GRID).collect()
    assert len(got) == 40 and {(str(r.parent_id), r.child_pos) for r in got} == {("0.0", 0), ("nan", 3)}

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import distances, ids, nearest, query, table, uniform
from vicinal.operators import scan as S
from vicinal.operators.knn import combine_knn, knn, knn_join, page, radius_join, rescore, score_all
from vicinal.plans.limits import Limits
from vicinal.spec import SpecError

SPACES = ["l2", "l1", "linf", "cosinesimil", "innerproduct"]
GRID = Limits(query_rows=30, block_bytes=12 * 8 * 70)


@pytest.fixture(scope="module")
def data(spark):
    c, q = uniform(400, 12, 1) - 0.5, uniform(90, 12, 2) - 0.5
    return q, c, query(spark, *q), table(spark, c).repartition(5)


@pytest.mark.parametrize("space", SPACES)
@pytest.mark.parametrize("limits", [Limits(), GRID], ids=["broadcast", "grid"])
def test_join_equals_brute_force(data, space, limits):
    q, c, qdf, cdf = data
    assert ids(knn_join(qdf, cdf, 7, space, limits=limits)) == nearest(space, q, c, 7).tolist()


@pytest.mark.parametrize("scale", [1e-9, 1e-3, 1e4, 1e12])
@pytest.mark.parametrize("offset", [0.0, 100.0])
def test_join_is_exact_at_any_magnitude(spark, scale, offset):
    # The float32 candidate test must never lose a neighbour, also where values nearly cancel.
    c, q = (uniform(300, 8, 3) + offset) * np.float32(scale), (uniform(40, 8, 4) + offset) * np.float32(scale)
    hits = knn_join(query(spark, *q), table(spark, c).repartition(3), 5).toPandas().sort_values(["query_id", "rank"])
    want = np.sort(distances("l2", q, c), axis=1)[:, :5]
    assert np.allclose(hits.distance.to_numpy().reshape(40, 5), want, rtol=1e-9)


def test_copies_and_ties_resolve_by_id(spark):
    # A third of the corpus is one vector, spread over all partitions.
    c = uniform(900, 6, 5)
    c[::3] = c[0]
    q = np.concatenate([c[:20], uniform(10, 6, 6)])
    for limits in (Limits(), Limits(query_rows=10, block_bytes=6 * 8 * 100)):
        assert ids(knn_join(query(spark, *q), table(spark, c).repartition(7), 8, limits=limits)) == nearest("l2", q, c, 8).tolist()


def test_k_beyond_the_table_and_missing_vectors(spark):
    rows = {0: [1, 0], 1: None, 2: [0, 1], 3: None}
    assert ids(knn_join(query(spark, [1, 0]), table(spark, rows), 10)) == [[0, 2]]
    empty = table(spark, {0: None})
    assert knn_join(query(spark, [1, 0]), empty, 3).count() == 0
    assert knn_join(query(spark, None), table(spark, rows), 3).count() == 0


def test_lengths_must_agree(spark):
    with pytest.raises(Exception, match="lengths differ"):
        knn_join(query(spark, [1, 0, 0]), table(spark, {0: [1, 0]}), 1).collect()
    with pytest.raises(Exception, match="length"):
        knn_join(query(spark, [1, 0]), table(spark, {0: [1, 0], 1: [1, 0, 0]}).coalesce(1), 1).collect()


def test_zero_query_is_refused_for_cosine(spark):
    with pytest.raises(Exception, match="zero vector"):
        knn_join(query(spark, [0, 0]), table(spark, {0: [1, 0]}), 1, "cosinesimil").collect()
    with pytest.raises(SpecError):
        knn(table(spark, {0: [1, 0]}), [0, 0], 1, "cosinesimil")


def test_settings_are_checked(spark):
    c, q = table(spark, {0: [1, 0]}), query(spark, [1, 0])
    for bad in (dict(k=0), dict(k=10_001), dict(k=1, space="far"), dict(k=1, vec="nope"), dict(k=1, on=[("a", "~", "b")])):
        with pytest.raises(SpecError):
            knn_join(q, c, **bad)
    out = knn_join(q, c, 1, vec="nope", ignore_unmapped=True)
    assert out.count() == 0 and out.columns == ["query_id", "id", "rank", "distance", "score"]


def test_filters_before_and_after(spark):
    rows = spark.createDataFrame([(i, [float(i)] * 3, "ab"[i % 2]) for i in range(1, 6)] + [(6, None, "a")],
                                 "id bigint, vec array<float>, category string")
    q = query(spark, [3, 3, 3])
    assert ids(knn_join(q, rows, 2, filter="category = 'a'")) == [[2, 4]]
    after = knn_join(q, rows, 2, keep=["category"]).where("category = 'a'")
    assert [r.id for r in after.collect()] == [2]
    assert knn_join(q, rows, 2, filter="category = 'z'").count() == 0


def test_per_query_conditions(spark):
    q, c = uniform(40, 5, 7), uniform(200, 5, 8)
    qdf = query(spark, *q).withColumn("want", F.when(F.col("query_id") == 0, None).otherwise(F.concat(F.lit("t"), F.col("query_id") % 3)))
    cdf = table(spark, c).withColumn("tag", F.concat(F.lit("t"), F.col("id") % 3)).repartition(3)
    d = distances("l2", q, c)
    d[np.arange(40)[:, None] % 3 != np.arange(200)[None] % 3] = np.inf
    want = np.argsort(d, axis=1, kind="stable")[1:, :4].tolist()
    for limits in (Limits(), Limits(query_rows=9, block_bytes=5 * 8 * 60)):
        assert ids(knn_join(qdf, cdf, 4, on=[("want", "tag")], limits=limits)) == want
    # Every query under a key of its own: compared under a mask.
    many = query(spark, *np.repeat(q, 8, axis=0)).withColumn("want", F.col("query_id"))
    own = knn_join(many, cdf.withColumn("one", F.col("id") + 0), 4, on=[("want", "one")])
    assert own.count() == 200 and own.where("query_id <> id").count() == 0
    low = knn_join(qdf, cdf, 4, on=[("query_id", "<=", "id")]).toPandas()
    assert (low.id >= low.query_id).all() and len(low) == 160


RADIUS = [
    ("l2", [(1, 0), (1, .5), (0, 0), (0, 3)], dict(max_distance=.5), 2), ("l2", [(1, 0), (1, .5), (0, 0), (0, 3)], dict(max_distance=2.0), 3),
    ("l2", [(1, 0), (1, .5), (0, 0), (0, 3)], dict(min_score=.9), 1), ("l2", [(1, 0), (1, .5), (0, 0), (0, 3)], dict(min_score=.75), 2),
    ("cosinesimil", [(1, 0), (3, 1), (1, 1), (0, 1)], dict(max_distance=.1), 2),
    ("cosinesimil", [(1, 0), (3, 1), (1, 1), (0, 1)], dict(max_distance=.5), 3),
    ("cosinesimil", [(1, 0), (3, 1), (1, 1), (0, 1)], dict(min_score=.99), 1),
    ("cosinesimil", [(1, 0), (3, 1), (1, 1), (0, 1)], dict(min_score=.8), 3),
    ("innerproduct", [(1, 0), (.8, .1), (.3, .3), (0, 1)], dict(max_distance=-.5), 2),
    ("innerproduct", [(1, 0), (.8, .1), (.3, .3), (0, 1)], dict(max_distance=-.1), 3),
    ("innerproduct", [(1, 0), (.8, .1), (.3, .3), (0, 1)], dict(max_distance=.1), 4),
    ("innerproduct", [(1, 0), (.8, .1), (.3, .3), (0, 1)], dict(min_score=1.9), 1),
    ("innerproduct", [(1, 0), (.8, .1), (.3, .3), (0, 1)], dict(min_score=1.4), 2),
    ("innerproduct", [(1, 0), (.8, .1), (.3, .3), (0, 1)], dict(min_score=1.01), 3),
    ("innerproduct", [(1, 0), (.5, .5), (-.3, .5), (-.8, .2), (-1, 0)], dict(max_distance=-.4), 2),
    ("innerproduct", [(1, 0), (.5, .5), (-.3, .5), (-.8, .2), (-1, 0)], dict(max_distance=.4), 3),
    ("innerproduct", [(1, 0), (.5, .5), (-.3, .5), (-.8, .2), (-1, 0)], dict(max_distance=.9), 4),
    ("innerproduct", [(1, 0), (.5, .5), (-.3, .5), (-.8, .2), (-1, 0)], dict(max_distance=1.1), 5),
    ("innerproduct", [(1, 0), (.5, .5), (-.3, .5), (-.8, .2), (-1, 0)], dict(min_score=.55), 4),
    ("innerproduct", [(.5, 0), (0, 1), (-.5, 0), (-1, 0)], dict(min_score=.6), 3),
    ("l2", [(1, 0), (1, .5), (1, 1), (0, 0), (0, 2)], dict(min_score=.45), 4),
    ("l2", [(1, 0), (1, .5), (1, 1), (0, 0), (0, 2)], dict(min_score=.15), 5),
]


@pytest.mark.parametrize("space,rows,limit,want", RADIUS)
def test_radius_counts(spark, space, rows, limit, want):
    assert radius_join(query(spark, (1, 0)), table(spark, rows), space=space, **limit).count() == want


def test_radius_in_both_forms_and_capped(data):
    q, c, qdf, cdf = data
    d = distances("l2", q, c)
    want = int((d <= 1.0).sum())
    for limits in (Limits(), GRID):
        assert radius_join(qdf, cdf, max_distance=1.0, limits=limits).count() == want
    capped = radius_join(qdf, cdf, max_distance=1.0, max_results=3)
    got = {k: list(g.sort_values("rank").id) for k, g in capped.toPandas().groupby("query_id")}
    for i, row in enumerate(d):
        best = [j for j in np.argsort(row, kind="stable") if row[j] <= 1.0][:3]
        assert got.get(i, []) == best
    own = radius_join(qdf.withColumn("far", F.col("query_id") / 90.0), cdf, max_distance="far")
    assert own.count() == int((d <= (np.arange(90) / 90.0)[:, None]).sum())


def test_radius_contains_the_top_k_above_the_threshold(data):
    q, c, qdf, cdf = data
    top = knn_join(qdf, cdf, 5).where("score >= 0.6").select("query_id", "id")
    assert top.join(radius_join(qdf, cdf, min_score=0.6), ["query_id", "id"], "left_anti").count() == 0


def test_hamming_codes_in_long_columns(spark):
    codes = {0: 8, 1: 1, 2: -9223372036818523493, 3: 10 ** 15, 4: None, 5: None, 6: None}
    df = spark.createDataFrame(list(codes.items()), "id bigint, code bigint")
    for value, order, want in ((-9223372036818526181, [2, 0, 1, 3], [1 / 4, 1 / 10, 1 / 10, 1 / 31]), (10, [0, 1, 2, 3], [1 / 2, 1 / 4, 1 / 12, 1 / 23])):
        got = score_all(df, value, "hammingbit", vec="code").orderBy(F.desc("score"), "id").limit(4).collect()
        assert [r.id for r in got] == order and [r.score for r in got] == pytest.approx(want)
    assert score_all(df, 10, "hammingbit", vec="code").where("code is null and score = 0").count() == 3


def test_scored_scan(spark):
    df = table(spark, {0: [1, 0], 1: None, 2: [3, 4]})
    assert [r.score for r in score_all(df, [3, 4], "l2").orderBy("id").collect()] == pytest.approx([1 / 21, 0.0, 1.0])
    bytes_ = table(spark, {0: [3, 4], 1: [-3, -4]}, kind="tinyint")
    assert [r.score for r in score_all(bytes_, [3, 4], "cosinesimil").orderBy("id").collect()] == pytest.approx([2.0, 0.0])
    floats = table(spark, {0: [3, 4], 1: [-3, -4]})
    assert [r.score for r in score_all(floats, [3, 4], "cosinesimil").orderBy("id").collect()] == pytest.approx([1.0, 0.0])


def test_single_query_agrees_with_the_join(data, spark):
    q, c, qdf, cdf = data
    one = [r.id for r in knn(cdf, q[0].tolist(), 9).orderBy("distance", "id").collect()]
    assert one == nearest("l2", q[:1], c, 9)[0].tolist()


def test_binary_and_byte_vectors(spark):
    rng = np.random.default_rng(9)
    c, q = rng.integers(0, 256, (300, 5)).astype(np.uint8), rng.integers(0, 256, (30, 5)).astype(np.uint8)
    cdf = spark.createDataFrame([(i, bytearray(r.tobytes())) for i, r in enumerate(c)], "id bigint, vec binary").repartition(3)
    qdf = spark.createDataFrame([(i, bytearray(r.tobytes())) for i, r in enumerate(q)], "query_id bigint, query_vec binary")
    d = np.bitwise_count(q[:, None] ^ c[None]).sum(-1)
    for limits in (Limits(), Limits(query_rows=7, block_bytes=5 * 8 * 90)):
        assert ids(knn_join(qdf, cdf, 6, "hamming", limits=limits)) == np.argsort(d, axis=1, kind="stable")[:, :6].tolist()
    cb, qb = c.astype(np.int8), q.astype(np.int8)
    hits = knn_join(query(spark, *qb, kind="tinyint"), table(spark, cb, kind="tinyint").repartition(3), 6)
    assert ids(hits) == nearest("l2", qb, cb, 6).tolist()


def test_string_ids_and_shards(spark):
    c = uniform(60, 4, 10)
    df = table(spark, c).select(F.concat(F.lit("doc-"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("id"), "vec")
    got = knn_join(query(spark, c[5]), [df.where("id < 'doc-030'"), df.where("id >= 'doc-030'")], 3)
    assert ids(got) == [[f"doc-{j:03d}" for j in nearest("l2", c[5:6], c, 3)[0]]]


def test_combine_page_boost_and_explain(data):
    q, c, qdf, cdf = data
    a, b = knn_join(qdf, cdf, 5), knn_join(qdf, cdf, 5, "innerproduct")
    both = combine_knn([a, b]).toPandas()
    pa, pb = (h.toPandas().set_index(["query_id", "id"]).score for h in (a, b))
    want = pa.add(pb, fill_value=0)
    assert len(both) == len(want) and np.allclose(both.set_index(["query_id", "id"]).score.sort_index(), want.sort_index())
    assert ids(page(knn_join(qdf, cdf, 10), 4, 3)) == nearest("l2", q, c, 10)[:, 4:7].tolist()
    assert np.allclose(knn_join(qdf, cdf, 3, boost=2).toPandas().score.sort_values(), 2 * knn_join(qdf, cdf, 3).toPandas().score.sort_values())
    x = knn_join(qdf, cdf, 3, explain=True, metrics=True).first()
    assert x.explain.search_type == "Exact" and x.explain.cardinality == 400 == x.exact_count and x.explain.raw == x.distance


def test_more_results_only_extend_fewer(data):
    q, c, qdf, cdf = data
    assert [r[:4] for r in ids(knn_join(qdf, cdf, 9))] == ids(knn_join(qdf, cdf, 4))
    assert ids(knn_join(qdf, cdf.repartition(2), 4)) == ids(knn_join(qdf, cdf.repartition(9), 4))


@pytest.mark.parametrize("space", SPACES)
def test_kernel_and_column_functions_agree(data, space):
    from vicinal.functions.scores import to_score
    from vicinal.functions.vectors import raw_distance

    q, c, qdf, cdf = data
    hits = knn_join(qdf, cdf, 5, space, keep=["vec"]).join(qdf, "query_id")
    raw = raw_distance("query_vec", "vec", space)
    off = hits.where((F.abs(raw - F.col("distance")) > 1e-9) | (F.abs(to_score(raw, space) - F.col("score")) > 1e-9))
    assert off.count() == 0


def test_rescore(data):
    q, c, qdf, cdf = data
    every, want = knn_join(qdf, cdf, 400, "linf"), nearest("l2", q, c, 5).tolist()
    assert ids(rescore(every, qdf, cdf, 5)) == want
    assert ids(rescore(every, qdf, cdf, 5, per_query=400)) == want
    assert ids(rescore(every, qdf, cdf, 5, limits=GRID)) == want
    some = knn_join(qdf, cdf, 3, "innerproduct")
    pairs = {(r.query_id, r.id) for r in rescore(some, qdf.where("query_id < 50"), cdf, 5).collect()}
    assert pairs == {(r.query_id, r.id) for r in some.where("query_id < 50").collect()}


def test_plan_shape(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, uniform(50, 4, 11)).withColumn("label", F.lit(1)).withColumn("unused", F.lit("x")).write.parquet(path)
    hits = knn_join(query(spark, [1, 0, 0, 0]), spark.read.parquet(path), 3, filter="label = 1")
    plan = hits._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "WindowGroupLimit" in plan and "EqualTo(label,1)" in plan and "unused" not in plan.split("== Physical Plan ==")[1]


def test_two_step_merge(data, monkeypatch):
    # As on a cluster with very many tasks: a first round over task groups comes before the final ranking.
    from vicinal.operators import knn as knn_module
    from vicinal.operators import scan

    for module in (scan, knn_module):
        monkeypatch.setattr(module, "parallelism", lambda spark: 10 ** 6)
    q, c, qdf, cdf = data
    hits = knn_join(qdf, cdf, 7)
    assert "_salt" in hits._jdf.queryExecution().toString()
    assert ids(hits) == nearest("l2", q, c, 7).tolist()
    assert [r.id for r in knn(cdf, q[0].tolist(), 9).orderBy("distance", "id").collect()] == nearest("l2", q[:1], c, 9)[0].tolist()


def test_many_queries_leave_the_corpus_where_it_is(spark, tmp_path):
    """Query blocks come to the corpus: the jobs that compare have no exchange below them, only that of the few merged hits."""
    c, q = uniform(600, 6, 1), uniform(90, 6, 2)
    table(spark, c).write.parquet(f"{tmp_path}/c")
    cdf = spark.read.parquet(f"{tmp_path}/c")
    from vicinal.operators.knn import exact_scan
    from vicinal.operators import scan as S

    plans, plain = [], S._broadcast_scan
    S._broadcast_scan = lambda *a: plans.append(plain(*a)[0]._jdf.queryExecution().executedPlan().toString()) or plain(*a)
    try:
        hits = exact_scan(query(spark, *q), cdf, 5, "l2", query_id="query_id", query_vec="query_vec", id="id", vec="vec", limits=GRID)
    finally:
        S._broadcast_scan = plain
    assert len(plans) >= 3 and not any("Exchange" in p for p in plans)
    assert hits.count() == 90 * 5


def test_a_dense_radius_streams_out(spark):
    c, q = uniform(3000, 4, 3), uniform(200, 4, 4)
    got = radius_join(query(spark, *q), table(spark, c), max_distance=100.0, limits=Limits(query_rows=60, block_bytes=4 * 8 * 500))
    assert got.count() == 600_000
    keyed = radius_join(query(spark, *q).selectExpr("*", "query_id % 2 as half"), table(spark, c).selectExpr("*", "id % 2 as part"), max_distance=100.0,
                        on=[("half", "part")], limits=Limits(query_rows=60, block_bytes=4 * 8 * 500))
    assert keyed.count() == 300_000


def test_very_many_keys_and_one_hot_key(spark):
    from pyspark.sql import functions as F

    rows = spark.range(150_000).select("id", F.array((F.col("id") % 97).cast("float"), F.lit(1.0).cast("float")).alias("vec"),
                                       F.when(F.col("id") < 50_000, 0).otherwise(F.col("id") - 49_999).alias("tag"))
    asked = rows.where("id >= 49000 and id % 7 <> 1").select(F.col("id").alias("query_id"), F.col("vec").alias("query_vec"), F.col("tag").alias("want"))
    got = knn_join(asked, rows, 1, on=[("want", "tag")], limits=Limits(query_rows=500, block_bytes=2 * 8 * 9000))
    out = got.agg(F.count("*").alias("n"), F.sum((F.col("query_id") == F.col("id")).cast("int")).alias("own"), F.max("distance").alias("far")).first()
    assert out.n == asked.count() and out.far == 0.0
    # Keys of one row find that row; the hot key's queries find the smallest id with the same vector.
    assert out.own == asked.where("want > 0").count()


@pytest.mark.parametrize("limits", [Limits(), GRID], ids=["broadcast", "blocks"])
@pytest.mark.parametrize("on", [None, [("want", "!=", "tag")], [("want", "==", "tag")], [("low", "<=", "tag")]])
def test_counts_are_measured(spark, limits, on):
    """Rows compared with each query, by the tasks that compared them."""
    c = table(spark, uniform(300, 5, 1)).selectExpr("*", "id % 7 as tag")
    q = query(spark, *uniform(70, 5, 2)).selectExpr("*", "query_id % 7 as want", "query_id % 9 as low")
    got = knn_join(q, c, 4, filter="id % 5 <> 0", on=on, metrics=True, limits=limits).groupBy("query_id").agg({"exact_count": "max", "filtered_rows": "max", "ann_count": "max"}).collect()
    rows = [i % 7 for i in range(300) if i % 5]
    test = {None: lambda n, t: True, "want!=": lambda n, t: n % 7 != t, "want==": lambda n, t: n % 7 == t, "low<=": lambda n, t: n % 9 <= t}[on and "".join(on[0][:2])]
    want = {n: sum(test(n, t) for t in rows) for n in range(70)}
    assert {r.query_id: r["max(exact_count)"] for r in got} == {n: k for n, k in want.items() if k}
    assert {(r["max(filtered_rows)"], r["max(ann_count)"]) for r in got} == {(240, 0)}


def test_no_rows_are_counted_while_the_plan_is_built(spark):
    c = table(spark, uniform(50, 5, 1))
    got = knn_join(query(spark, *uniform(3, 5, 2)), c, 4, explain=True, metrics=True)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and got.select("explain.cardinality").distinct().collect()[0][0] == 50


def test_matches_of_query_blocks_are_not_written(spark, monkeypatch):
    def never(*_):
        raise AssertionError("matches or queries of a block were written")

    monkeypatch.setattr("vicinal.operators.scan.scratch_dir", never)
    q, c = uniform(90, 12, 61), uniform(200, 12, 62)
    got = {(r.query_id, r.id) for r in radius_join(query(spark, *q), table(spark, c), max_distance=1.5, limits=GRID).collect()}
    assert got == {(i, j) for i, j in zip(*np.nonzero(distances("l2", q, c) <= 1.5))}


@pytest.mark.parametrize("space", ["l1", "linf"])
@pytest.mark.parametrize("make, fine", [(lambda x: x, True), (lambda x: x * 1e-6, True), (lambda x: x + 100, True), (lambda x: x + 1e14, False),
                                        (lambda x: np.where(np.arange(len(x))[:, None] == 5, 1e6, x), False), (lambda x: x * 0, False)])
def test_bounds_on_a_grid_hold(space, make, fine):
    from vicinal.operators import blocks as B

    x = make(np.random.default_rng(3).standard_normal((300, 24)))
    asked = x[:100].copy()
    asked[0] += 0.5 * (asked[0] - x.mean(axis=0))
    q, c = B.Prepared(space, asked), B.Prepared(space, x[100:] if fine else x)
    assert (B._grid(q, c) is not None) == fine
    raw = distances(space, q.wide, c.wide)
    for part, want in ((q.take(0, 1), raw[:1]), (q.take(50, 100), raw[50:]), (q, raw)):
        low, eq, ec = B.lower_bounds(part, c)
        slack = 1e-6 * np.abs(want) + 1e-30
        assert (low <= want + slack).all() and (want <= low.astype(float) + eq[:, None] + ec[None] + slack).all()


def test_query_blocks_read_a_corpus_that_is_computed_once(spark, monkeypatch):
    """Derived columns are not computed for each block, and vectors of hits do not travel to the merge; ids may repeat or be null."""
    from pyspark.sql import functions as F

    from vicinal.operators import scan as S

    c, q = uniform(300, 6, 1), uniform(90, 6, 2)
    rows = table(spark, c).withColumn("id", F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 200))
    derived = rows.groupBy("id", "vec").agg(F.count("*").alias("n")).withColumn("name", F.concat(F.lit("x"), F.col("id").cast("string")))
    plans, columns, plain = [], [], S._broadcast_scan
    monkeypatch.setattr(S, "_broadcast_scan", lambda *a: plans.append(a[3]._jdf.queryExecution().optimizedPlan().toString()) or columns.append(a[0].columns) or plain(*a))
    got = knn_join(query(spark, *q), derived, 4, keep=["vec", "name", "n"], limits=GRID)
    assert len(plans) >= 3 and not any("Aggregate" in p for p in plans) and not any("vec" in x or "name" in x for x in columns)
    one = knn_join(query(spark, *q), derived, 4, keep=["vec", "name", "n"])
    assert got.columns == one.columns and got.count() == 90 * 4
    assert sorted(map(str, got.collect())) == sorted(map(str, one.collect()))


def test_matches_beyond_a_block_go_out_by_distance(spark):
    """Equal values stand side by side, so a written result takes less space; no match is lost."""
    q, c = uniform(50, 6, 31), uniform(400, 6, 32)
    for space, far in (("l2", 0.8), ("cosinesimil", 0.1), ("innerproduct", -1.5)):
        got = radius_join(query(spark, *q), table(spark, c), space=space, max_distance=far, limits=GRID)
        rows = got.withColumn("task", F.spark_partition_id()).collect()
        for task in {r.task for r in rows}:
            mine = [r.distance for r in rows if r.task == task]
            assert len(mine) > 1 and mine == sorted(mine)
        want = np.argwhere(distances(space, q, c) <= far)
        assert sorted((r.query_id, r.id) for r in rows) == [(i, j) for i, j in want.tolist()]


def test_a_task_holds_matches_up_to_its_limits(monkeypatch):
    q, c = uniform(20, 6, 33), uniform(300, 6, 34)
    block = pa.table({"query_id": pa.array(range(20)), "query_vec": pa.array(q.tolist(), pa.list_(pa.float32()))})
    rows = pa.table({"id": pa.array(range(300)), "vec": pa.array(c.tolist(), pa.list_(pa.float32()))})
    scan = S.Scan("l2", "l2", "query_id", "query_vec", "id", "vec", ("id",), ("id",), max_distance=0.9)
    whole = sorted((distances("l2", q, c) <= 0.9).sum(axis=1).tolist())
    for rows_held, bytes_held in ((100, 1 << 20), (10**6, 2000)):
        monkeypatch.setattr(S, "MATCHES", rows_held)
        monkeypatch.setattr(S, "MATCH_BYTES", bytes_held)
        found = list(S._compare(scan, block, rows.to_batches(max_chunksize=10)))
        assert len(found) > 1 and max(t.num_rows for t in found) <= 300
        assert sorted(np.bincount(np.concatenate([t.column("_q").to_numpy() for t in found]), minlength=20).tolist()) == whole

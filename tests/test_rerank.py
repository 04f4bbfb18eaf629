import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import query, table, uniform
from vicinal.functions.scores import score_array
from vicinal.operators.knn import knn_join
from vicinal.operators.rerank import late_interaction, late_interaction_join, mmr, resolve_vector_path
from vicinal.plans.limits import Limits
from vicinal.spec import SpecError


def test_worked_diversity_example(spark):
    rows = {**{i: [1, 1] for i in range(8)}, 8: [1, 2], 9: [2, 1]}
    hits = knn_join(query(spark, [1, 1]), table(spark, rows), 10, keep=["vec"])
    got = mmr(hits, size=3, candidates=9, diversity=0.9, explain=True).orderBy("mmr_rank").collect()
    assert [(r.id, r.score) for r in got] == [(0, 1.0), (8, 0.5), (1, 1.0)]
    assert "vec" not in got[0].asDict()
    assert got[1].explain.original_score == 0.5 and got[1].explain.max_similarity_to_selected == 0.5
    assert got[1].explain.mmr_formula == "(1 - 0.9000) * 0.5000 - 0.9000 * 0.5000 = -0.4000"


def greedy(scores, sims, size, lam):
    left, out = list(range(len(scores))), []
    while left and len(out) < size:
        value = [(1 - lam) * scores[i] - lam * max([0.0] + [sims[i, j] for j in out]) for i in left]
        out.append(left.pop(int(np.argmax(value))))
    return out


@pytest.mark.parametrize("space", ["l2", "cosinesimil", "innerproduct"])
@pytest.mark.parametrize("lam", [0.0, 0.5, 1.0])
def test_equals_a_plain_greedy_loop(spark, space, lam):
    from tests.conftest import distances

    c, q = uniform(60, 5, 1) - 0.3, uniform(6, 5, 2) - 0.3
    hits = knn_join(query(spark, *q), table(spark, c), 12, space, keep=["vec"])
    got = mmr(hits, size=4, candidates=12, diversity=lam, space=space).toPandas().sort_values(["query_id", "mmr_rank"])
    plain = hits.toPandas().sort_values(["query_id", "rank"])
    for i, group in plain.groupby("query_id"):
        v = np.stack(group.vec)
        want = group.id.to_numpy()[greedy(group.score.to_numpy(), score_array(distances(space, v, v), space), 4, lam)]
        assert list(got[got.query_id == i].id) == list(want)


def test_diversity_settings_and_paths(spark):
    hits = knn_join(query(spark, [1, 1]), table(spark, {0: [1, 1]}), 1, keep=["vec"])
    for bad in (dict(diversity=1.5), dict(size=0), dict(size=5, candidates=4), dict(vector_path="a.b")):
        with pytest.raises(SpecError):
            mmr(hits, **bad)
    deep = hits.withColumn("a", F.struct(F.col("vec").alias("b")))
    assert "a" not in mmr(deep, vector_path="a.b").columns
    wide = deep.withColumn("a", F.struct(F.col("vec").alias("b"), F.lit(5).alias("c")))
    assert mmr(wide, vector_path="a.b").first().a.asDict() == {"c": 5}
    with pytest.raises(SpecError):
        resolve_vector_path([deep, deep.withColumn("a", F.struct(F.col("vec").cast("array<tinyint>").alias("b")))], "a.b")
    with pytest.raises(SpecError):
        resolve_vector_path([deep], "a.b", ["l2", "innerproduct"])
    assert mmr(hits.drop("rank"), size=1, keep_vector=True).first().vec == [1.0, 1.0]


def docs(spark):
    return spark.createDataFrame([(1, [[.3, .4]]), (2, [[.1, .2]])], "id bigint, vecs array<array<double>>")


@pytest.mark.parametrize("space,want", [("l2", [1 / 1.65, 1 / 1.85]), ("innerproduct", [1.3, 1.1]),
                                        ("cosinesimil", [.8, (1 + .1 / .05 ** .5) / 2])])
def test_late_interaction_examples(spark, space, want):
    got = docs(spark).select("id", late_interaction([[1.0, 0.0]], "vecs", space).alias("s")).orderBy("id").collect()
    assert [r.s for r in got] == pytest.approx(want)


def test_late_interaction_edges(spark):
    for space in ("l1", "linf", "hamming"):
        with pytest.raises(SpecError):
            late_interaction([[1.0]], "vecs", space)
    with pytest.raises(SpecError):
        late_interaction([], "vecs")
    gaps = spark.createDataFrame([(1, [[1.0, 0.0], None, []])], "id bigint, vecs array<array<double>>")
    assert gaps.select(late_interaction([[1.0, 0.0]], "vecs").alias("s")).first().s == 1.0
    none = spark.createDataFrame([(1, [])], "id bigint, vecs array<array<double>>")
    with pytest.raises(Exception, match="must not be null or empty"):
        none.select(late_interaction([[1.0, 0.0]], "vecs")).collect()


@pytest.mark.parametrize("space", ["l2", "innerproduct", "cosinesimil"])
@pytest.mark.parametrize("limits", [Limits(), Limits(query_rows=5, block_bytes=6 * 8 * 40)], ids=["broadcast", "grid"])
def test_late_interaction_join(spark, space, limits):
    from tests.conftest import distances

    rng = np.random.default_rng(3)
    sets = [rng.random((rng.integers(1, 6), 6)) - 0.3 for _ in range(70)]
    asks = [rng.random((rng.integers(1, 5), 6)) - 0.3 for _ in range(12)]
    d = spark.createDataFrame([(i, s.tolist()) for i, s in enumerate(sets)], "id bigint, vecs array<array<double>>").repartition(4)
    q = spark.createDataFrame([(i, s.tolist()) for i, s in enumerate(asks)], "query_id bigint, query_vecs array<array<double>>")
    total = np.array([[score_array(distances(space, a, s), space).max(axis=1).sum() for s in sets] for a in asks])
    got = late_interaction_join(q, d, 4, space, limits=limits).toPandas().sort_values(["query_id", "rank"])
    assert np.array_equal(got.id.to_numpy().reshape(12, 4), np.argsort(-total, axis=1, kind="stable")[:, :4])
    assert np.allclose(got.score.to_numpy().reshape(12, 4), -np.sort(-total, axis=1)[:, :4])
    pairs = q.where("query_id = 3").select("query_vecs").join(d.where("id = 9"), F.lit(True))
    assert pairs.select(late_interaction("query_vecs", "vecs", space).alias("s")).first().s == pytest.approx(total[3, 9])


@pytest.mark.parametrize("space", ["l2", "innerproduct", "cosinesimil"])
def test_ragged_documents_equal_a_loop(spark, space, monkeypatch):
    from vicinal.operators import rerank as R
    from vicinal.operators.tokens import token_scores
    from vicinal.operators.blocks import METRIC_OF_SPACE

    monkeypatch.setattr(R, "TOKENS", 50)
    monkeypatch.setattr(R, "PAIRS", 90)
    rng = np.random.default_rng(8)
    asked = [rng.normal(size=(int(rng.integers(1, 6)), 5)) for _ in range(120)]
    held = [rng.normal(size=(int(rng.integers(0, 30)), 5)) for _ in range(120)]
    held[7] = np.zeros((0, 5))
    list_of = lambda m: [[float(v) for v in r] for r in m]
    # A document of nothing but null or empty vectors counts as one without tokens.
    rows = [(i, list_of(q), list_of(d) + [None] if i % 5 == 0 else list_of(d) or [[]]) for i, (q, d) in enumerate(zip(asked, held))]
    df = spark.createDataFrame(rows, "id int, q array<array<double>>, d array<array<double>>").coalesce(1)
    fixed = asked[3]
    got = df.select("id", late_interaction("q", "d", space).alias("own"), late_interaction([r for r in fixed], "d", space).alias("one")).collect()
    metric = METRIC_OF_SPACE[space]
    for r in got:
        d = held[r.id]
        plain = lambda q: token_scores(q, d, metric, space).max(axis=1).sum() if len(d) else 0.0
        assert r.own == pytest.approx(plain(asked[r.id])) and r.one == pytest.approx(plain(fixed))


@pytest.mark.parametrize("space", ["l2", "cosinesimil", "innerproduct"])
def test_vectors_are_fetched_for_candidates_only(spark, space, monkeypatch):
    from vicinal.operators import rerank as R
    from vicinal.operators.knn import knn_join
    from tests.conftest import query, table, uniform

    c = table(spark, uniform(300, 6, 3))
    q = query(spark, *uniform(12, 6, 4))
    carried = mmr(knn_join(q, c, 30, space, keep=["vec"]), size=5, candidates=20, diversity=0.7, space=space)
    bare = knn_join(q, c, 30, space)
    fetched = mmr(bare, size=5, candidates=20, diversity=0.7, space=space, source=c)
    assert "vec" not in bare.columns and fetched.columns == carried.columns
    key = lambda r: (r.query_id, r.mmr_rank)
    assert [(r.query_id, r.id) for r in sorted(fetched.collect(), key=key)] == [(r.query_id, r.id) for r in sorted(carried.collect(), key=key)]
    vectors = np.random.default_rng(1).normal(size=(40, 6))
    plain = R._similarities(vectors, space)
    monkeypatch.setattr(R, "SMALL", 10)
    assert np.allclose(plain, R._similarities(vectors, space))

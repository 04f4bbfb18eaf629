"""The exact pass over candidates: where vectors travel, and that every form gives the same."""

import re

import numpy as np
import pytest

from tests.conftest import ids, nearest, query, table, uniform
from vicinal.operators.approx import Index
from vicinal.operators.knn import knn_join, rescore
from vicinal.plans.limits import Limits
from vicinal.sources.models import fit_model
from vicinal.spec import VectorSpec

BITS = VectorSpec(12, encoder="binary", mode="on_disk", compression="32x", params={"bits": 1})


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    c = table(spark, uniform(900, 12, 1))
    model = fit_model(c, BITS)
    path = f"{tmp_path_factory.mktemp('second')}/c"
    model.encode(c).write.parquet(path)
    return Index(spark.read.parquet(path), model)


def exchanged(df):
    """The columns below every exchange of the plan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    physical = df._jdf.queryExecution().executedPlan().toString()
    return plan, re.findall(r"Exchange hashpartitioning\((\w+)#", physical)


def test_vectors_stay_where_they_are(spark, index):
    got = knn_join(query(spark, *uniform(40, 12, 2)), index, 5, mode="binary")
    plan, keys = exchanged(got)
    assert "Join" not in plan and keys == ["query_id"]


def test_beyond_the_limit_a_filter_stands_before_the_shuffle(spark, index):
    q = query(spark, *uniform(40, 12, 2))
    hits = knn_join(q, index, 30, mode="binary", rescore=False)
    small = Limits(state_rows=40 * 12)
    got = rescore(hits, q, index.df, 5, limits=small)
    plan, _ = exchanged(got)
    join = plan[plan.index("Join"):]
    assert re.search(r"Filter .*test\(xxhash64\(id", join) or "ArrowEvalPython" in join
    assert ids(got) == ids(rescore(hits, q, index.df, 5))


@pytest.mark.parametrize("limits", [Limits(), Limits(query_rows=11), Limits(state_rows=40 * 30)], ids=["one block", "blocks", "many candidates"])
@pytest.mark.parametrize("space", ["l2", "cosinesimil", "innerproduct"])
def test_all_candidates_give_the_exact_result(spark, index, limits, space):
    q, c = uniform(40, 12, 2), uniform(900, 12, 1)
    got = knn_join(query(spark, *q), index, 7, space, mode="binary", candidates=900, limits=limits)
    assert ids(got) == nearest(space, q, c, 7).tolist()


def test_text_ids_equal_hashes_and_kept_columns(spark):
    """Ids of any type; a filter, repeated ids in the corpus, columns that come along."""
    rows = [(f"n{i % 300}", [float(x) for x in v], i) for i, v in enumerate(uniform(320, 12, 5))]
    df = spark.createDataFrame(rows, "id string, vec array<float>, place int")
    model = fit_model(df, BITS)
    q = query(spark, *uniform(9, 12, 6))
    got = knn_join(q, Index(model.encode(df), model), 4, mode="binary", candidates=320, keep=["place"], filter="place % 2 = 0")
    want = knn_join(q, df, 4, keep=["place"], filter="place % 2 = 0")
    key = lambda r: (r.query_id, r.rank)
    assert [(r.query_id, r.id, round(r.distance, 9)) for r in sorted(got.collect(), key=key)] == [
        (r.query_id, r.id, round(r.distance, 9)) for r in sorted(want.collect(), key=key)]


def test_nothing_to_compare(spark, index):
    assert knn_join(query(spark, *uniform(3, 12, 2)), index, 5, mode="binary", filter="id < 0").count() == 0
    assert knn_join(query(spark, *uniform(3, 12, 2)).where("query_id < 0"), index, 5, mode="binary").count() == 0
    assert rescore(spark.createDataFrame([], "query_id bigint, id bigint"), query(spark, *uniform(3, 12, 2)), index.df, 5).count() == 0


def test_more_queries_than_a_block_join_no_vectors(spark, index):
    q = uniform(40, 12, 2)
    got = knn_join(query(spark, *q), index, 7, mode="binary", candidates=60, limits=Limits(query_rows=11))
    assert "Join" not in exchanged(got)[0]
    assert ids(got) == ids(knn_join(query(spark, *q), index, 7, mode="binary", candidates=60))

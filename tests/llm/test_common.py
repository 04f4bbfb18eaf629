import random

import pyarrow as pa

from vicinal.llm.common import Forest, cells, components, whole_groups
from .conftest import frame, least_reachable


def test_components_of_chains_stars_and_loops(spark):
    random.seed(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [(500, 500), (900, 1), (7, 7)]
    edges += [(random.randint(1000, 1100), random.randint(1000, 1100)) for _ in range(60)]
    random.shuffle(edges)
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    linked = {frozenset(e) for e in edges}
    want = least_reachable(len(nodes), lambda i, j: frozenset((nodes[i], nodes[j])) in linked)
    got = {r.node: r.root for r in components(frame(spark, edges, "a long, b long"), "test").collect()}
    assert got == {n: nodes[w] for n, w in zip(nodes, want)}


def test_no_edges(spark):
    assert components(frame(spark, [], "a long, b long"), "test").count() == 0


def test_every_pair_of_a_bucket_meets_once(spark):
    rows = [(1, i) for i in range(40)] + [(2, i) for i in range(3)] + [(3, 0)]
    got = cells(frame(spark, rows, "key int, x long"), ["key"], __import__("pyspark").sql.functions.col("x"), 7).collect()
    met, sizes = {}, {}
    for r in got:
        sizes.setdefault((r.key, r.cell_i, r.cell_j), []).append(r)
    for cell in sizes.values():
        for i, a in enumerate(cell):
            for b in cell[:i]:
                if a.side == 0 or a.side != b.side:
                    met[a.key, frozenset((a.x, b.x))] = met.get((a.key, frozenset((a.x, b.x))), 0) + 1
    assert set(met.values()) == {1} and len(met) == 40 * 39 // 2 + 3
    assert max(map(len, sizes.values())) < 30


def test_groups_stay_whole_across_batches():
    keys = [1, 1, 2, 2, 2, 2, 3, 4, 4, 4]
    batches = [pa.record_batch([pa.array(keys[i:i + 3], pa.int64())], ["k"]) for i in range(0, 10, 3)]
    seen = []
    for table, bounds in whole_groups(iter([batches[0].slice(0, 0), *batches]), ["k"]):
        seen += [table.column("k").to_pylist()[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    assert seen == [[1, 1], [2, 2, 2, 2], [3], [4, 4, 4]]


def test_forest_keeps_what_joins():
    f = Forest(4)
    for a, b in ((0, 1), (1, 0), (2, 3), (1, 3), (0, 2)):
        f.link(a, b)
    assert f.kept == [(0, 1), (2, 3), (1, 3)] and {f.root(i) for i in range(4)} == {0}

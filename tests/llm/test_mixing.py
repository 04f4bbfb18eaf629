import random
from collections import defaultdict

import pytest

from vicinal.llm.mixing import mix, mixed
from .conftest import frame

SCHEMA = "doc_id long, text string, source string, target string, p string"


def shared(sizes, cap=3.0):
    """Targets by resharing the excess until none is above, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > cap * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        for s in over:
            target[s] = cap * sizes[s]
        free -= over
        left = sum(sizes.values()) - sum(target.values())
    return target


def corpus():
    random.seed(5)
    rows = []
    for n in range(900):
        source = random.choice(["hot"] * 6 + ["a", "b", "é", "z", "", None])
        rows.append((n, "w " * random.choice((0, 1, 20, 20, 50)), source, "clash", "clash"))
    return rows + [(1000, None, "a", "", ""), (None, "x y", None, "", ""), (5, "x y", "b", "", ""), (5, "x y", "b", "", ""), (7, " \n", "blank", "", "")]


def test_targets_sizes_and_copies(spark):
    rows = corpus()
    sizes = defaultdict(int)
    for _, text, source, *_ in rows:
        sizes[source] += len((text or "").split())
    want = shared(sizes)
    docs = frame(spark, rows, SCHEMA)
    got = mixed(docs).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-12)
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60, s
    again = mixed(docs.repartition(7, "text")).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    out = mix(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in got)


def test_preferences_change_the_odds(spark):
    rows = [(i, "a b c d", s, float(i % 2) * 2) for s in ("a", "b", "c") for i in range(400)]
    got = mixed(frame(spark, rows, "doc_id long, text string, source string, liked double"), preference="liked").collect()
    assert not sum(r.taken for r in got if r.doc_id % 2 == 0)
    for s in "abc":
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 4


def test_one_source_empty_table_and_no_words(spark):
    assert {r.taken for r in mixed(frame(spark, [(1, "a b", "s"), (2, "c", "s")], "doc_id long, text string, source string")).collect()} == {2, 1}
    assert {(r.target, r.taken) for r in mixed(frame(spark, [(1, "", "s"), (2, None, "t")], "doc_id long, text string, source string")).collect()} == {(0.0, 0)}
    assert mixed(frame(spark, [], "doc_id long, text string, source string")).collect() == []

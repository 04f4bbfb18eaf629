import random

import pytest

from vicinal.llm.topk import nearest, sign_code
from .conftest import frame

SCHEMA = "id long, code binary, distance string"


def far(a, b):
    return (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count()


@pytest.mark.parametrize("size, k, block, shard", [(8, 10, 65_536, 1 << 20), (8, 3, 2, 60), (16, 5, 4, 100), (3, 7, 9, 1 << 20), (1, 400, 9, 50)])
def test_equals_a_scan(spark, size, k, block, shard):
    random.seed(size)
    rows = [(i, random.randbytes(size), "x") for i in range(250)]
    rows += [(300 + i, rows[7][1], "x") for i in range(30)]                        # ties
    odd = [(900, None, "x"), (901, b"", "x"), (None, rows[0][1], "x"), (902, b"\1" * (size + 1), "x"), rows[3]]
    asked = rows[:12] + odd + [(5000, random.randbytes(size), "x")]
    got = nearest(frame(spark, asked, SCHEMA), frame(spark, rows + odd, SCHEMA), k, block=block, shard=shard)
    want = []
    for q in {a[0]: a for a in asked if a[0] is not None and a[1]}.values():
        hits = sorted((far(q[1], r[1]), r[0]) for r in rows + odd if r[0] is not None and r[1] and len(r[1]) == len(q[1]))[:k]
        want += [(q[0], n + 1, i, d) for n, (d, i) in enumerate(hits)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_codes_of_signs(spark):
    from pyspark.sql import functions as F

    got = frame(spark, [([1.0, -1.0, 0.0, None, 2.0],), (None,)], "v array<float>").select(sign_code(F.col("v")).alias("c")).collect()
    assert bytes(got[0].c) == (0b10001).to_bytes(8, "big") and got[1].c is None


def test_codes_beyond_64_components(spark):
    from pyspark.sql import functions as F

    random.seed(3)
    rows = [(i, [random.choice((-1.0, 1.0)) for _ in range(150)]) for i in range(40)] + [(99, [])]
    codes = frame(spark, rows, "id long, v array<float>").select("id", sign_code(F.col("v")).alias("code"))
    held = {r.id: bytes(r.code) for r in codes.collect()}
    assert {len(c) for i, c in held.items() if i < 99} == {24} and held[99] == bytes(8)
    assert all(far(held[i], held[j]) == sum(a != b for a, b in zip(rows[i][1], rows[j][1])) for i in range(40) for j in range(i))
    assert {(r.query_id, r.id) for r in nearest(codes, codes, 1).collect()} == {(i, i) for i in held}


def test_empty_sides(spark):
    some, none = frame(spark, [(1, b"a", "x")], SCHEMA), frame(spark, [], SCHEMA)
    assert nearest(some, none).collect() == [] and nearest(none, some).collect() == []

"""Vector codes against a plain search over all entries."""

import numpy as np
import pytest

from vicinal.llm import codes
from .conftest import frame

SCHEMA = "vec_id long, embedding array<float>, code string, error string"


def plain_nearest(book, x):
    far = ((x[None] - book) ** 2).sum(axis=1)
    return int(far.argmin()), int(far.min())


def plain_books(rows, parts, entries, rounds):
    good = sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is None, r[0] or 0, list(r[1])))
    v = np.floor(256 * np.array([r[1] for r in good], np.float32).astype(np.float64)).astype(np.int64)
    cut_up = v.reshape(len(v), parts, -1)
    books = cut_up[:entries].swapaxes(0, 1).copy()
    for _ in range(rounds):
        got = [[plain_nearest(books[p], x[p])[0] for p in range(parts)] for x in cut_up]
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = [x[p] for x, g in zip(cut_up, got) if g[p] == e]
                if mine:
                    books[p, e] = [sum(int(x[d]) for x in mine) // len(mine) for d in range(books.shape[2])]
    return books


def some_rows(n, dim, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim)).astype(np.float32)
    base[5] = base[4]
    base[n // 2] = np.round(base[n // 2])
    rows = [(i, base[i].tolist()) for i in range(n)]
    return [*rows, (7, rows[7][1]), (None, rows[8][1])]


@pytest.mark.parametrize("n, dim, parts, entries", [(300, 32, 16, 64), (200, 12, 4, 5), (40, 16, 16, 64)])
def test_equals_plain_search(spark, n, dim, parts, entries):
    rows = some_rows(n, dim, n)
    odd = [(1000, None), (1001, [float("nan")] * dim), (1002, [None] * dim), (1003, [float("inf")] + [0.0] * (dim - 1)), (1004, []), (1005, [1.0]), (1006, [3e30] * dim)]
    table = frame(spark, [(*r, "c", "e") for r in rows + odd], SCHEMA).repartition(3)
    books = codes.train(table, parts=parts, entries=entries)
    want = plain_books(rows, parts, entries, 2)
    assert (books.books == want).all()
    got = codes.encode(table, books, keep=["vec_id"])
    assert got.columns == ["vec_id", "code", "error"]
    plain = []
    for i, v in rows:
        x = np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(np.int64).reshape(parts, -1)
        found = [plain_nearest(want[p], x[p]) for p in range(parts)]
        plain.append((i, bytes(f[0] for f in found).hex(), sum(f[1] for f in found)))
    assert sorted(((r.vec_id, r.code.hex(), r.error) for r in got.collect()), key=str) == sorted(plain, key=str)
    back = codes.decode(got.where("vec_id = 3"), books).first()
    assert back.embedding == pytest.approx(np.concatenate([want[p, c] for p, c in enumerate(back.code)]) / 256)


def test_the_box_holds_the_nearest_and_prunes():
    rng = np.random.default_rng(2)
    for width in (1, 2, 4, 9):
        book = codes.Slices(rng.integers(-300, 300, (64, width)))
        rows = np.concatenate([rng.integers(-400, 400, (500, width)), book.entries])
        far = ((rows[:, None] - book.entries[None]) ** 2).sum(-1)
        entry, least = book.nearest(rows)
        assert (entry == far.argmin(axis=1)).all() and (least == far.min(axis=1)).all()
        mask = book.box(rows, book.radius(rows))
        held = (mask[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        inside = (np.abs(rows[:, None] - book.entries[None]).max(-1) <= book.radius(rows)[:, None])
        assert (held.astype(bool) == inside).all()
        assert width > 2 or held.mean() < 0.3


def test_ties_go_to_the_lower_entry():
    book = codes.Slices(np.array([[5, 5], [1, 1], [1, 1], [3, 3]]))
    assert book.nearest(np.array([[1, 1], [4, 4], [2, 2]]))[0].tolist() == [1, 0, 1]


def test_nothing_to_code_and_bad_settings(spark):
    empty = frame(spark, [(1, None, "c", "e")], SCHEMA)
    assert codes.train(empty) is None and codes.encode(empty, None, keep=["vec_id"]).collect() == []
    with pytest.raises(ValueError):
        codes.train(frame(spark, [(1, [1.0, 2.0, 3.0], "c", "e")], SCHEMA), parts=2)
    with pytest.raises(ValueError):
        codes.train(empty, entries=65)

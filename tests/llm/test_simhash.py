import random
import re

import pytest
import xxhash

from vicinal.llm.simhash import BKTree, close_fingerprints, fingerprint, keep_one, near_duplicates
from .conftest import frame, least_reachable


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("text", ["", " \n\t", "One", "two Words", "a b c", "É È A\x0bb\x1cc  d e f", "x " * 500, "w" * 100_000])
def test_fingerprints(text):
    assert fingerprint(text.encode()) & (1 << 64) - 1 == plain(text)


def test_tree_equals_scan():
    random.seed(2)
    fps = [random.getrandbits(12) for _ in range(300)]
    tree = BKTree()
    for i, f in enumerate(fps):
        tree.add(f, i)
    for q in fps[:40]:
        assert sorted(tree.near(q, 3)) == [i for i, f in enumerate(fps) if (f ^ q).bit_count() <= 3]


def documents(spark):
    random.seed(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for n in range(40):
        base = [random.choice(words) for _ in range(random.choice((5, 120, 400)))]
        for c in range(random.choice((1, 1, 2, 6))):
            text = base[:]
            if c:
                text[random.randrange(len(text))] = "changed"
            rows.append((len(rows) * 3 % 97, " ".join(text), "clash", "x"))
    rows += [(500, None, "a", "b"), (501, "", "a", "b"), (502, " \t", "a", "b"), (None, "lonely text here", "a", "b"), (None, rows[0][1], "a", "b")]
    rows += [rows[5], rows[5]]
    return rows, frame(spark, rows, "doc_id long, text string, fp string, component_id string")


@pytest.mark.parametrize("tree", [2048, 3])
def test_components_equal_brute_force(spark, tree):
    rows, docs = documents(spark)
    fps = [plain(r[1]) for r in rows]
    roots = least_reachable(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    best = {r: min((x[0] for x, o in zip(rows, roots) if o == r and x[0] is not None), default=None) for r in roots}
    want = sorted(((r[0], f, best[o]) for r, f, o in zip(rows, fps, roots)), key=str)
    got = near_duplicates(docs, tree=tree)
    assert got.columns == ["doc_id", "fp", "component_id"]
    assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got.collect()), key=str) == want
    kept = keep_one(docs, tree=tree)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({b for b in best.values() if b is not None}) and None in ids


def test_more_blocks_find_the_same(spark):
    random.seed(4)
    fps = list({(b := random.getrandbits(63)) ^ (1 << random.randrange(60)) ^ (1 << random.randrange(60)) for _ in range(30)})
    fps += [f ^ 0b101 for f in fps]
    table = frame(spark, [(f,) for f in fps], "fp long")
    found = [{frozenset((r.a, r.b)) for r in close_fingerprints(table, blocks=n).collect()} for n in (4, 5, 6)]
    assert found[0] == found[1] == found[2] and len(found[0]) >= 30


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).collect() == [] and keep_one(frame(spark, [])).collect() == []


def test_rows_are_told_by_id_and_text(spark):
    text = [" ".join(f"{c}{i}" for i in range(300)) for c in "abcde"]
    rows = [(None, text[0]), (1, text[1]), (None, text[1]), (5, text[2]), (5, text[3]), (3, text[3]), (5, text[2]), (7, text[4]), (7, "other words " * 30)]
    got = keep_one(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([rows[0], rows[1], rows[3], rows[5], rows[7], rows[8]], key=str)

"""Exact duplicates against a plain grouping."""

import hashlib
import random
import re

import pytest

from vicinal.llm import common, exact
from .conftest import frame

SCHEMA = "doc_id long, text string, n long, sha256 string, id string"


def odd_rows():
    random.seed(3)
    parts = ["", " ", "a b", "ab", "a\tb\n", "é\x0b", "é", "é ", "x" * 300 + "1", "x" * 300 + " 2", "x" * 300 + "2", "long " * 60_000, None]
    rows = [(n, random.choice(parts)) for n in range(300)]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, "ab"), (None, "a  b  "), (None, None), (400, "only"), (401, "x" * 300 + "3")]
    return [(*r, 1, "s", "i") for r in rows]


def brute(rows):
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r[1] or ""), []).append(i)
    out = []
    for short, members in groups.items():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0))
        for i in members:
            same = (rows[i][0], len(rows[i][1] or "")) == (rows[best][0], len(rows[best][1] or ""))
            out.append((rows[i][0], rows[best][0], len(members), same, hashlib.sha256(short.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [4096, 3])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT", hot)
    rows = odd_rows()
    got = exact.duplicates(frame(spark, rows, SCHEMA).repartition(4), digest=True).collect()
    want = brute(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.sha256.hex()) for r in got), key=str) == sorted(((*w[:3], w[4]) for w in want), key=str)
    # Exactly one of a group stays, and it is one that the rule names.
    kept = sorted((r.sha256.hex(), str(r.doc_id)) for r in got if r.kept)
    assert kept == sorted({(w[4], str(w[0])) for w in want if w[3]})


def test_rows_that_stay(spark):
    rows = odd_rows()
    docs = frame(spark, rows, SCHEMA)
    out = exact.without_duplicates(docs)
    assert out.columns == docs.columns
    shorts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in out.collect()]
    assert len(set(shorts)) == len(shorts) == len({re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in rows})


def test_only_survivors_are_read_whole(spark):
    got = exact.duplicates(frame(spark, [(1, "a b"), (2, "ab"), (3, "xy"), (4, "other")])).collect()
    assert {r.doc_id for r in got if r.sha256 is not None} == {1, 2}


def test_empty_table(spark):
    assert exact.duplicates(frame(spark, [])).collect() == [] and exact.without_duplicates(frame(spark, [])).collect() == []

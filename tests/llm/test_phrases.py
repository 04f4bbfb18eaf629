"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from vicinal.llm import phrases
from .conftest import frame

SCHEMA = "doc_id long, text string, lang string, word string, n long, phrase string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts():
    random.seed(4)
    words = ["a", "b", "c", "the", "The", "a\x01", "é", "É", "w'x", "\x00", "long" * 500] + [f"w{i}" for i in range(12)]
    ends = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "! ", "\x0b"]
    rows = []
    for n in range(160):
        t = "".join(random.choice(words[:8] if random.random() < 0.7 else words) + random.choice(ends) for _ in range(random.randint(0, 80)))
        if n % 3 == 0:
            t += " THE very common line of every text. x y x y x y"
        rows.append((n, t, random.choice(["en", "de", None, "und", ""])))
    rows += [(5, rows[5][1], rows[5][2]), (None, "a b c", "en"), (200, None, "en"), (201, "", None), (202, " .,;", "xx"), (203, "a " * 3000, "en")]
    return [(*r, "w", 1, "p") for r in rows]


def brute(rows, least, longest, first):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang if lang is not None else "und"] += len(w)
            for k in range(1, longest + 1):
                f[lang if lang is not None else "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {(p[i:j], a) for p, a in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p)}
        scored = []
        for p, a in found.items():
            if (p, a) not in inside:
                s, _, l, r = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:first])]
    return sorted(out)


@pytest.mark.parametrize("least, longest, piece, budget, first", [(4, 5, 8 << 20, 1 << 20, 2000), (3, 5, 900, 30, 40), (2, 3, 5000, 4, 2000), (9, 6, 1, 1, 2000)])
def test_equals_plain_counting(spark, monkeypatch, least, longest, piece, budget, first):
    monkeypatch.setattr(phrases, "SLICE", piece)
    rows = texts()
    docs = frame(spark, rows, SCHEMA).repartition(3)
    got = phrases.collocations(docs, least=least, longest=longest, first=first, budget=budget)
    assert sorted(map(tuple, got.collect())) == brute(rows, least, longest, first)


def test_hash_is_spark_s(spark):
    row = frame(spark, [(1, "wörd")]).select(F.xxhash64(F.lit("de").cast("binary"), F.col("text").cast("binary")).alias("h")).first()
    assert row.h % (1 << 64) == phrases.word_hash(b"de", "wörd".encode())


def test_products_beyond_64_bits(spark):
    cases = [(10 ** 13, 10 ** 14, 10 ** 13, 10 ** 13 + 7), (99_999_999_999, 10 ** 15 + 3, 10 ** 12 + 1, 10 ** 14 + 9), (100, 1000, 100, 100), (7 * 10 ** 15, 9 * 10 ** 15, 8 * 10 ** 15, 7 * 10 ** 15)]
    got = spark.createDataFrame(cases, "a long, n long, l long, r long").select("*", phrases.quotient(*map(F.col, "anlr"), 1000).alias("q")).collect()
    assert [r.q for r in got] == [1000 * r.a * r.n // (r.l * r.r) for r in got]


def test_no_texts(spark):
    assert phrases.collocations(frame(spark, [], SCHEMA)).collect() == []
    assert phrases.collocations(frame(spark, [(1, None, None, "w", 1, "p")], SCHEMA)).collect() == []

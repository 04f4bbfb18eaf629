import random
import zlib

import numpy as np

from vicinal.llm.toxicity import Settings, drop_toxic, fit_ftrl, hashed, held_out, score, train
from .conftest import frame


def plain_ftrl(rows, labels, s):
    """One coordinate at a time."""
    from math import exp, sqrt

    z, n, zb, nb = {}, {}, 0.0, 0.0
    w = lambda i: 0.0 if abs(z.get(i, 0)) <= s.l1 else ((1 if z[i] > 0 else -1) * s.l1 - z[i]) / ((s.beta + sqrt(n[i])) / s.alpha + s.l2)
    for _ in range(s.epochs):
        for x, y in zip(rows, labels):
            now = {int(i): w(int(i)) for i in x}
            wb = -zb / ((s.beta + sqrt(nb)) / s.alpha)
            g = 1 / (1 + exp(-(sum(now.values()) + wb))) - y
            for i, v in now.items():
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (sqrt(old + g * g) - sqrt(old)) / s.alpha * v
                n[i] = old + g * g
            zb += g - (sqrt(nb + g * g) - sqrt(nb)) / s.alpha * wb
            nb += g * g
    return {i: w(i) for i in z if w(i)}, -zb / ((s.beta + sqrt(nb)) / s.alpha)


def test_equals_the_plain_algorithm():
    random.seed(8)
    rows = [np.array(sorted(random.sample(range(60), 8)), np.uint32) for _ in range(150)]
    labels = np.array([int(3 in r or 7 in r) for r in rows])
    s = Settings(bits=6, l1=0.5, epochs=3)
    model = fit_ftrl(rows, labels, s)
    weights, bias = plain_ftrl(rows, labels.tolist(), s)
    assert dict(zip(model.index.tolist(), model.weight.tolist())).keys() == weights.keys()
    assert np.allclose(model.weight, [weights[i] for i in model.index.tolist()]) and np.isclose(model.bias, bias)


def test_features_see_words_pairs_and_skips():
    s = Settings()
    a, b = set(hashed("You, are SUCH_fools", s).tolist()), set(hashed("you are such fools", s).tolist())
    assert a == b and len(hashed("a b c", s)) == 3 + 3 + 2 + 1 and not len(hashed(" .,! ", s))


def corpus(n=600):
    random.seed(9)
    words, bad = [f"word{i}" for i in range(200)], ["idiotic", "stupidest", "trashy"]
    rows, labels = [], []
    for i in range(n):
        text = random.choices(words, k=random.randint(20, 80))
        if i % 5 == 0:
            for b in random.sample(bad, 2):
                text.insert(random.randrange(len(text)), b)
        rows.append((i, " ".join(text), "clash"))
        labels.append((i, int(i % 5 == 0)))
    return rows, labels


def test_learns_and_keeps_the_hold_out_apart(spark):
    rows, labels = corpus()
    docs = frame(spark, rows + [(9000, None, ""), (9001, "", ""), (None, "word1", ""), (9002, "word1 " * 50_000, "")], "doc_id long, text string, score string")
    table = frame(spark, labels + [(5, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    model = train(docs, table)
    assert model.rows == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, _ in labels)
    got = {r.doc_id: r.score for r in score(docs, model).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((got[i] >= 0.5) == (i % 5 == 0) for i in held) and all(0 <= x <= 1 for x in got.values())
    assert all(got[i] < 0.5 for i in (9000, 9001, None, 9002))
    assert {r.doc_id for r in docs.where(held_out(docs.doc_id)).collect()} >= set(held)
    kept = drop_toxic(docs, model)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}
    # Labels of the hold-out change nothing.
    other = train(docs, frame(spark, [(i, 1 - y if i in held else y) for i, y in labels] + [(5, 1)], "doc_id long, toxic int"))
    assert np.array_equal(other.weight, model.weight)


def test_the_sample_is_bounded(spark):
    rows, labels = corpus(200)
    docs = frame(spark, [r[:2] for r in rows])
    assert train(docs, frame(spark, labels, "doc_id long, toxic int"), settings=Settings(max_rows=50)).rows == 50


def test_without_labels_nothing_is_toxic(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    model = train(docs, frame(spark, [], "doc_id long, toxic int"))
    assert all(r.score < 1e-6 for r in score(docs, model).collect()) and drop_toxic(docs, model).count() == 2
    assert score(frame(spark, []), model).collect() == []

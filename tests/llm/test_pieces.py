import itertools
import os
import random

import numpy as np
import pytest

from vicinal.llm import pieces as P
from .conftest import frame

pytestmark = pytest.mark.skipif(not os.path.exists(P.MODEL), reason="vocabulary files are not here")
ALPHABET = "abcdefghijklmnopqrstuvwxyz ABC  \n\t\r.,;:-_(){}'\"0123456789éüß中文字😀▁ﬁ　"


@pytest.fixture(scope="module")
def vocabulary():
    return P.load()


def texts():
    random.seed(6)
    made = ["".join(random.choice(ALPHABET) for _ in range(random.randint(0, 120))) for _ in range(400)]
    return made + ["", " ", "  a", "a" * 700, "ab" * 300, " " * 90, "\0x", "<s> </s> <unk> <0x0A>", "e" * 64, "x" * 33, "\n\n\n"]


def test_equals_the_library_and_decodes_back(vocabulary):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    encoder, decoder = P.Encoder(vocabulary.prepare()), P.Decoder(vocabulary)
    for some in (texts(), texts()[::-1]):           # the second time all words are remembered
        offsets, ids = encoder.encode(some)
        for i, t in enumerate(some):
            mine = ids[offsets[i]:offsets[i + 1]]
            assert mine.tolist() == sp.encode(t)
            assert decoder.decode(mine) == sp.decode(mine.tolist()) == t.replace("▁", " ")


def test_unigram_pass_is_the_best_division():
    random.seed(7)
    names = sorted({"".join(random.choice("abc") for _ in range(random.randint(1, 4))) for _ in range(25)} - {"c"})
    texts = ["<unk>", *names, P.SPACE]
    scores = np.array([0.0, *(-random.random() * 10 for _ in names), -1.0], np.float32)
    made = P.Pieces(texts, scores, ["unknown"] + ["normal"] * (len(texts) - 1), P.UNIGRAM, prefix=False, fallback=False)
    encoder, value = P.Encoder(made.prepare()), dict(zip(texts[1:], scores[1:]))
    low = min(value.values()) - 10
    for n in range(1, 8):
        for word in map("".join, itertools.islice(itertools.product("abc", repeat=n), 0, None, 11)):
            best = max(sum(value.get(word[a:b], low if b - a == 1 else -1e9) for a, b in zip((0, *cut), (*cut, n)))
                       for k in range(n) for cut in itertools.combinations(range(1, n), k))
            _, ids = encoder.encode([word])
            runs = sum(len(r) for r in [word]) - sum(len(texts[i]) for i in ids if i)      # characters behind unknown pieces
            assert sum(scores[i] for i in ids if i) + low * runs == pytest.approx(best, abs=1e-3)


def test_texts_without_spaces_equal_the_library_and_are_quick(vocabulary):
    import time

    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    random.seed(12)
    han = "".join(chr(random.randint(0x4E00, 0x9FA5)) for _ in range(20_000))
    made = [han, han[:300] + "abc" * 40 + han[300:400], "".join(random.choice(ALPHABET.replace(" ", "")) for _ in range(3000)),
            "".join(random.choice("的一是在不了有和人这中大为上个国我以要他") for _ in range(500)), "thequickbrownfox" * 30, "".join(random.choice("ab") for _ in range(400))]
    tables = vocabulary.prepare()
    for t in made:
        offsets, ids = P.Encoder(tables).encode([t])
        assert ids.tolist() == sp.encode(t)
    start = time.perf_counter()
    P.Encoder(tables).encode([han])
    assert time.perf_counter() - start < 0.6


@pytest.mark.parametrize("long", [0, 1, 3])
def test_cuts_change_nothing(monkeypatch, long):
    """With and without unknown characters, on words of every length."""
    random.seed(13)
    names = sorted({"".join(random.choice("abcd") for _ in range(random.randint(1, 3))) for _ in range(14)} - {"d"})
    texts = ["<unk>", *names]
    scores = np.array([0.0, *(-random.random() * 10 for _ in names)], np.float32)
    made = P.Pieces(texts, scores, ["unknown"] + ["normal"] * len(names), P.UNIGRAM, prefix=False, fallback=False)
    words = ["".join(random.choice("abcdxy") for _ in range(random.randint(1, 30))) for _ in range(300)]
    plain = [P.Encoder(made.prepare()).encode([w])[1].tolist() for w in words]
    monkeypatch.setattr(P, "LONG", long)
    assert [P.Encoder(made.prepare()).encode([w])[1].tolist() for w in words] == plain


def test_bounded_memory_forgets_words(vocabulary, monkeypatch):
    encoder = P.Encoder(vocabulary.prepare())
    first = encoder.encode(["one two three"])
    monkeypatch.setattr(P, "REMEMBERED", 2)
    again = encoder.encode(["one two three"])
    assert first[1].tolist() == again[1].tolist() and len(encoder.known) == 3


def test_tables(spark, vocabulary):
    rows = [(1, None, "x"), (2, "", "y"), (3, "Hello  world", "z"), (3, "Hello  world", "z"), (None, "long " * 30_000, "w")]
    docs = frame(spark, rows, "doc_id long, text string, ids string")
    got = P.decode(P.encode(docs, vocabulary), vocabulary)
    assert got.columns == ["doc_id", "ids", "text"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(((r[0], r[1] or "") for r in rows), key=str)
    one = P.encode(docs, vocabulary, decoded="back", room=10).collect()
    assert {r.doc_id: r.back for r in one} == {r[0]: r[1] or "" for r in rows}
    assert P.encode(frame(spark, []), vocabulary, decoded="back").collect() == []

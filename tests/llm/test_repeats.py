"""Repeated substrings (by bytes) and repeated paragraphs (by shingles)."""

import hashlib
import random
import re

import pytest

from vicinal.llm import paragraphs, substrings
from .conftest import frame, least_reachable, needs_data

NONE = -(1 << 63)


def brute_substrings(rows, length=100):
    first, out = {}, []
    given = [(NONE if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    for i, b in given:
        for s in range(len(b) - length + 1):
            k = b[s:s + length]
            first[k] = min(first.get(k, (1 << 64, 0)), (i, s))
    for i, b in given:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if (i, s) > first[b[s:s + length]]:
                gone[s:s + length] = b"\1" * length
        spans = sum(1 for j in range(len(gone)) if gone[j] and not (j and gone[j - 1]))
        out.append((None if i == NONE else i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def odd_texts():
    random.seed(10)
    parts = ["".join(random.choice("ab \n") for _ in range(random.randint(80, 260))) for _ in range(6)]
    rows = [(n, "".join(random.choice(parts + ["x" * random.randint(0, 150), "é" * 30, str(n)]) for _ in range(random.randint(0, 9)))) for n in range(50)]
    rows += [(5, rows[6][1]), (7, rows[7][1]), (None, parts[0]), (None, parts[0]), (99, None), (100, ""), (101, "a" * 5000), (102, "ab" * 2000),
             (103, "\0" * 300), (104, "\0" * 299 + "a"), (-5, parts[1] + "\0" * 120), (106, parts[2][:99]), (107, parts[2][:99])]
    return [(*r, "x", "y") for r in rows]


@pytest.mark.parametrize("chunk, piece", [(4 << 20, 1 << 15), (1000, 50)])
def test_substrings_equal_brute_force(spark, monkeypatch, chunk, piece):
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    monkeypatch.setattr(substrings, "SLICE", piece)
    rows = odd_texts()
    docs = frame(spark, rows, "doc_id long, text string, id string, tag string").repartition(3)
    got = substrings.without_repeats(docs).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute_substrings(rows)


def test_a_filter_that_lets_all_through_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(substrings, "FILTER_BITS", 64)
    rows = odd_texts()
    got = substrings.without_repeats(frame(spark, rows, "doc_id long, text string, id string, tag string"), with_text=True).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute_substrings(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def crowded_texts():
    random.seed(21)
    letters = lambda n: "".join(random.choice("abcdefgh") for _ in range(n))
    line, exact, near = letters(60), letters(100), letters(90)
    rows = []
    for n in range(220):
        kind = n % 4
        middle = {0: line, 1: exact, 2: near + random.choice("xy") + letters(20), 3: letters(30) + line + letters(9)}[kind]
        rows.append((n, letters(random.randint(0, 150)) + middle + letters(random.randint(0, 150))))
    rows += [(300 + n, random.choice("xy") + line + random.choice("xyz") + near[:38] + letters(5)) for n in range(30)]
    return [(*r, "x", "y") for r in rows]


@pytest.mark.parametrize("crowd", [200_000, 40, 5, 1])
def test_crowded_grams_are_dealt_further(spark, monkeypatch, crowd):
    """Short lines, one exact string and overlapping passages in very many places: the same result however small a bucket must be."""
    monkeypatch.setattr(substrings, "CROWD", crowd)
    rows = crowded_texts() + (odd_texts() if crowd == 5 else [])
    got = substrings.without_repeats(frame(spark, rows, "doc_id long, text string, id string, tag string").repartition(4)).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute_substrings(rows)


def test_no_bucket_of_a_crowded_gram_is_large(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CROWD", 12)
    docs = frame(spark, crowded_texts(), "doc_id long, text string, id string, tag string")
    sizes = substrings.bucket_rows(docs, "doc_id", "text", 100).where("right >= 0").groupBy("gram").count().agg({"count": "max"}).first()[0]
    monkeypatch.setattr(substrings, "CROWD", 200_000)
    before = substrings.bucket_rows(docs, "doc_id", "text", 100).where("right >= 0").groupBy("gram").count().agg({"count": "max"}).first()[0]
    assert sizes <= 12 < 50 < before


def test_no_documents(spark):
    assert substrings.without_repeats(frame(spark, [])).collect() == [] and paragraphs.repeats(frame(spark, [])).collect() == []


def wrapped(words, width):
    return "\n".join(" ".join(words[i:i + width]) for i in range(0, len(words), width))


def some_texts():
    random.seed(11)
    words = [f"w{i}" for i in range(400)]
    base = [[random.choice(words) for _ in range(random.randint(6, 70))] for _ in range(25)]
    rows = []
    for n in range(120):
        lines = []
        for _ in range(random.randint(0, 5)):
            line = random.choice(base)[:] if random.random() < 0.5 else [random.choice(words) for _ in range(random.randint(1, 60))]
            if random.random() < 0.5:
                line[random.randrange(len(line))] = "edit"
            kind = random.random()
            lines.append(" ".join(line).upper() if kind < 0.1 else "  ".join(line) if kind < 0.2 else wrapped(line, random.choice((4, 11, 30))) if kind < 0.5 else " ".join(line))
        rows.append((n, random.choice(("\n", "\n\n", "\n \n")).join(lines)))
    rows += [(500, None), (501, ""), (502, "\n\n"), (None, " ".join(base[0])), (3, rows[3][1]), (503, ("\n".join([" ".join(base[1])] * 300))), (504, "Licence: MIT\n\nsmall")]
    return [(*r, "x", "y") for r in rows]


def plain_passages(text, least):
    """(first line, lines, words): long lines, and what is left between them and blank lines."""
    lines = [x.split() for x in (text or "").encode().lower().split(b"\n")]
    short = "".join("s" if 0 < len(w) < least else "-" for w in lines)
    out = [(i, 1, w) for i, w in enumerate(lines)]
    out += [(m.start(), len(m[0]), sum(lines[m.start():m.end()], [])) for m in re.finditer("ss+", short)]
    return [x for x in out if len(x[2]) >= least]


@pytest.mark.parametrize("least, cell, size", [(20, 1024, 1 << 25), (20, 4, 1 << 25), (20, 1024, 500), (6, 1024, 1 << 25)])
def test_paragraphs_equal_brute_force(spark, least, cell, size):
    rows = some_texts()
    places, sets = [], []
    for r in rows:
        for at, n, w in plain_passages(r[1], least):
            places.append((r[0], at, n))
            sets.append({b" ".join(w[i:i + 5]) for i in range(len(w) - 4)})
    root = least_reachable(len(places), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    members = {}
    for i, p in enumerate(places):
        members.setdefault(root[i], []).append(p)
    want = []
    for mine in members.values():
        if len({p[:2] for p in mine}) > 1:
            first = min(mine, key=lambda p: (p[0] is not None, p[0] or 0, p[1]))
            want += [(*p, *first[:2], p[:2] != first[:2]) for p in mine]
    assert sum(w[2] > 1 for w in want) > 5
    docs = frame(spark, rows, "doc_id long, text string, id string, node string")
    s = paragraphs.Settings(least=least, recall=0.999999)
    got = [(r.doc_id, r.paragraph, r.lines, r.first_id, r.first_paragraph, r.removed) for r in paragraphs.repeats(docs, settings=s, cell=cell, size=size).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    if (cell, size) != (1024, 1 << 25):
        return
    gone = {(w[0], line) for w in want if w[5] for line in range(w[1], w[1] + w[2])}
    clean = paragraphs.without_repeats(docs, settings=s)
    assert clean.columns == docs.columns
    new = sorted((("" if r.doc_id is None else r.doc_id, r.text) for r in clean.collect()), key=str)
    assert new == sorted((("" if r[0] is None else r[0], None if r[1] is None else "\n".join(x for n, x in enumerate(r[1].split("\n")) if (r[0], n) not in gone)) for r in rows), key=str)


def test_bands_follow_the_wanted_recall():
    s = paragraphs.Settings()
    assert 1 - (1 - s.similarity ** s.rows) ** s.bands() >= s.recall > 1 - (1 - s.similarity ** s.rows) ** (s.bands() - 1)


def test_a_passage_is_found_however_it_is_wrapped(spark):
    words = [f"word{i}" for i in range(60)]
    rows = [(1, "x\n\n" + wrapped(words, 9) + "\n\nend"), (2, wrapped(words, 12)), (3, " ".join(words)), (4, wrapped(words[:15], 5)), (5, wrapped(words[20:30] + ["other"] * 40, 9))]
    got = paragraphs.repeats(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.paragraph, r.lines, r.first_id, r.first_paragraph, r.removed) for r in got) == [
        (1, 2, 7, 1, 2, False), (2, 0, 5, 1, 2, True), (3, 0, 1, 1, 2, True)]


def test_headings_are_no_part_of_a_long_line(spark):
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(1, f"title\nmore\n{words}"), (2, f"other\n{words[:300]}\ntitle\nmore")]
    assert paragraphs.repeats(frame(spark, rows)).collect() == []


def test_short_lines_are_counted_apart(spark):
    ten = " ".join("abcdefghij")
    rows = [(1, f"Licence: MIT\nalone here\n{ten}"), (2, f"x\n\nlicence:  mit\n{ten.upper()} k"), (3, f"Licence: MIT\nLICENCE: mit\n\t{ten}"), (None, "x"), (4, None), (5, "w " * 25 + "\n" + "w " * 25)]
    docs = frame(spark, rows)
    assert sorted(map(tuple, paragraphs.short_lines(docs).collect())) == [(ten, 10, 2, 2, 1), ("licence: mit", 2, 4, 3, 1), ("x", 1, 2, 2, 2)]
    assert {r.doc_id for r in paragraphs.repeats(docs).collect()} == {5}


@pytest.mark.parametrize("least, near, batch", [(51, 12, 1 << 20), (12, 5, 300), (7, 1, 1)])
def test_runs_inside_other_text(spark, monkeypatch, least, near, batch):
    """Against every window of the texts: all of ``least`` words that two documents share are covered, and all that is covered is shared."""
    monkeypatch.setattr(paragraphs, "BATCH", batch)
    random.seed(12)
    words = [f"w{i}" for i in range(300)]
    some = lambda a, b: [random.choice(words) for _ in range(random.randint(a, b))]
    planted = [some(n, n) for n in (5, 11, 12, 30, 50, 51, 52, 90)]
    rows = []
    for n in range(80):
        text = some(0, 60) + random.choice(planted) + some(0, 60) + (random.choice(planted) if n % 3 else ["so"] * random.choice((3, 60))) + some(0, 9)
        rows.append((n, "".join(w.upper() + random.choice((" ", " ", " ", "\n", "\t ", "\n\n")) for w in text)))
    rows += [(None, " ".join(planted[-1])), (None, "x " + " ".join(planted[-1])), (90, None), (91, ""), (92, " ".join(planted[-1][:-1] + ["end"])), (93, "one"), (7, " ".join(planted[5]))]
    gram, split, owners, grams = least - near + 1, {}, {}, {}
    for i, text in rows:
        split.setdefault(i, []).append([(w, n) for n, line in enumerate((text or "").encode().lower().split(b"\n")) for w in line.split()])
    for i, texts in split.items():
        for t in texts:
            for size, seen in ((least, owners), (gram, grams)):
                for at in range(len(t) - size + 1):
                    seen.setdefault(tuple(w for w, _ in t[at:at + size]), set()).add(i)
    got = paragraphs.shared_runs(frame(spark, rows).repartition(3), least=least, near=near).collect()
    covered = {}
    for r in got:
        covered.setdefault(r.doc_id, set()).update(range(r.word, r.word + r.n_words))
        if len(split[r.doc_id]) > 1:
            continue
        t = next(t for t in split[r.doc_id] if len(t) >= r.word + r.n_words and t[r.word][1] == r.paragraph and t[r.word + r.n_words - 1][1] == r.paragraph + r.lines - 1)
        there = grams[tuple(w for w, _ in t[r.word:r.word + gram])]
        assert len(there) > 1 and r.first_id in there and (r.first_id is None or r.doc_id is not None and r.first_id <= r.doc_id) and r.removed == (r.doc_id != r.first_id)
        assert len(grams[tuple(w for w, _ in t[r.word + r.n_words - gram:r.word + r.n_words])]) > 1
    pairs = 0
    for i, texts in split.items():
        for t in texts:
            for at in range(len(t) - least + 1):
                if len(owners[tuple(w for w, _ in t[at:at + least])]) > 1:
                    pairs += 1
                    assert len(covered[i] & set(range(at, at + least))) >= gram
    assert pairs > 100 and len(got) > 40


def test_the_query_finds_a_passage_inside_longer_lines(spark, tmp_path):
    from vicinal.llm.queries import op9_paragraph_dedup

    one = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    rows = [(1, one("a", 90) + " " + one("same", 51) + " " + one("b", 90)), (2, one("c", 40) + "\n" + one("d", 70) + "\t" + one("same", 51).upper()),
            (3, one("e", 90) + " " + one("same", 39) + " " + one("f", 30))]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [r for r in op9_paragraph_dedup(spark, str(tmp_path)).collect() if r.word is not None]
    assert {(r.doc_id, r.paragraph, r.first_id, r.first_paragraph, r.removed) for r in got if r.doc_id < 3} == {(1, 0, 1, 0, False), (2, 1, 1, 0, True)}
    assert all(40 <= r.n_words <= 51 and r.word >= 90 for r in got if r.doc_id < 3)


@needs_data
def test_shared_passages_are_caught_and_clean_documents_left_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held, owners = {}, {}
    for r in docs.collect():
        w = (r.text or "").lower().split()
        held[r.doc_id] = {hash(tuple(w[i:i + 51])) for i in range(len(w) - 50)}
        for h in held[r.doc_id]:
            owners.setdefault(h, set()).add(r.doc_id)
    sharing = {d for d, hs in held.items() if any(len(owners[h]) > 1 for h in hs)}
    found = {r.doc_id for r in paragraphs.repeats(docs).select("doc_id").distinct().collect()}
    assert len(sharing) > 100
    assert len(found & sharing) >= 0.95 * len(sharing) and len(found - sharing) <= 0.1 * (len(held) - len(sharing))

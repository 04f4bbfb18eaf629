"""Collocations: phrases whose words stand together more often than their parts would by chance.

Phrases are counted with a suffix tree of words that is cut off at ``longest`` words and built piecewise, by vertical partitioning. Words are
counted first. A pair of neighbours that is rarer than ``least`` cannot be inside a frequent phrase, so a suffix ends before its first rare
pair; pairs are counted to know that. The prefixes of the remaining suffixes are then grouped by a memory budget: all suffixes of a word
go to one group while they are at most ``BUDGET``; a heavier word is extended by the next one, and a pair that is still too heavy by all
words of the suffix. Each group is a Spark partition, whose task builds its subtrees one after another from the sorted suffixes and
reads every node's count from the totals of its leaves. Nodes above a group's prefixes get a part of their count from
each group, and Spark adds the parts up.

Tasks read texts in slices, as arrays of word numbers, and combine equal suffixes of a slice before anything is shuffled: a line that stands in
a third of all texts is one suffix a slice. A slice sends the suffixes of one group as one row. What is known of words and pairs comes back to the next scan as Bloom filters of bounded
size, which may let a rare pair through; counts are taken from the words themselves and stay exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vicinal.plans import bloom
from .common import cut, partitions

SLICE = 2 << 20          # bytes of text that a task looks at together
BUDGET = 1 << 20         # suffixes that one group of prefixes may bring to a task, about
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"

KIND = np.zeros(256, np.uint8)
KIND[list(BLANKS)], KIND[list(ENDS)] = 1, 2
MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hash(lang: bytes, word: bytes) -> int:
    """What ``xxhash64(lang, word)`` gives in Spark, as an unsigned number."""
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang, 42))


def mixed_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a * MIX) ^ b
    h ^= h >> np.uint64(29)
    h *= MIX
    return h ^ (h >> np.uint64(32))


class Words:
    """The words of a slice of texts as numbers: ``ids`` by place, ``first`` where a piece begins, and per number its word, language and hash."""

    def __init__(self, langs: list[bytes], texts: list[bytes]):
        joined = np.frombuffer(b"\n".join(texts), np.uint8)
        kind = KIND[joined]
        word = kind == 0
        edge = np.diff(word.view(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
        flat = pa.py_buffer(joined[word].tobytes())
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), flat]).dictionary_encode()
        piece = np.searchsorted(np.flatnonzero(kind == 2), start)
        self.first = np.append(True, piece[1:] != piece[:-1]) if len(start) else np.empty(0, bool)
        names = sorted(set(langs))
        number = {n: i for i, n in enumerate(names)}
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        doc = np.searchsorted(begins, start, "right") - 1
        lang = np.array([number[n] for n in langs], np.int64)[doc]
        v = len(coded.dictionary)
        both = lang * v + coded.indices.to_numpy().astype(np.int64)
        there = np.bincount(both, minlength=len(names) * v) if len(both) else np.zeros(0, np.int64)
        known = np.flatnonzero(there)
        self.counts = there[known]
        place = np.zeros(len(there), np.int64)
        place[known] = np.arange(len(known))
        self.ids = place[both]
        self.words = coded.dictionary.take(pa.array(known % max(v, 1))).cast(pa.binary())
        self.langs = [names[i] for i in (known // max(v, 1)).tolist()]
        self.hashes = np.array([word_hash(n, w) for n, w in zip(self.langs, self.words.to_pylist())], np.uint64)

    def linked(self, words: bloom.Bloom) -> np.ndarray:
        """Places whose word and next word may both be frequent, in one piece."""
        good = words.has(self.hashes)[self.ids]
        return np.flatnonzero(good[:-1] & good[1:] & ~self.first[1:])


def slices(batches):
    """``Words`` of a task's rows (lang, text), about ``SLICE`` bytes at a time."""
    langs, texts, size = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            langs.append(lang.as_buffer().to_pybytes())
            texts.append(text.as_buffer().to_pybytes().lower())
            size += len(texts[-1]) + 1
            if size >= SLICE:
                yield Words(langs, texts)
                langs, texts, size = [], [], 0
    if texts:
        yield Words(langs, texts)


def _counted(batches):
    for s in slices(batches):
        yield pa.record_batch([pa.array(s.langs, pa.binary()), s.words, pa.array(s.counts)], ["lang", "word", "n"])


def _paired(words: bloom.Bloom):
    def run(batches):
        for s in slices(batches):
            at = s.linked(words)
            pair, n = np.unique(s.ids[at] * len(s.hashes) + s.ids[at + 1], return_counts=True)
            h = mixed_hash(s.hashes[pair // max(len(s.hashes), 1)], s.hashes[pair % max(len(s.hashes), 1)])
            yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(n)], ["pair", "n"])
    return run


def _suffixed(words, pairs, heavy_words, heavy_pairs, longest: int, groups: int):
    """(group, and lists of route, deep, lang, suffix, n): the distinct suffixes of each slice that belong to a group, every word closed by
    a line break. ``deep`` is the number of words of the prefix that a suffix is grouped by, ``route`` that prefix's hash."""
    def run(batches):
        for s in slices(batches):
            at = s.linked(words)
            pair = mixed_hash(s.hashes[s.ids[at]], s.hashes[s.ids[at + 1]])
            at = at[pairs.has(pair)]
            tied = np.zeros(len(s.ids) + longest, bool)
            tied[at] = True
            v = len(s.hashes) + 1
            one, same = np.arange(len(at)), s.ids[at]
            alive = np.ones(len(at), bool)
            for k in range(1, longest):
                alive &= tied[at + k - 1]
                step = np.where(alive, s.ids[np.minimum(at + k, len(s.ids) - 1)] + 1, 0)
                _, one, same = np.unique(same * v + step, return_index=True, return_inverse=True)
            at, n = at[one], np.bincount(same, minlength=len(one))
            alive = np.ones(len(at), bool)
            columns, hashes = [s.words.take(pa.array(s.ids[at]))], [s.hashes[s.ids[at]]]
            for k in range(1, longest):
                alive = alive & tied[at + k - 1]
                ids = s.ids[np.minimum(at + k, len(s.ids) - 1)]
                columns.append(s.words.take(pa.array(ids, mask=~alive)))
                hashes.append(np.where(alive, mixed_hash(hashes[-1], s.hashes[ids]), hashes[-1]))
            heavy = heavy_words.has(hashes[0])
            heavier = heavy & heavy_pairs.has(hashes[1])
            route = np.where(heavier, hashes[-1], np.where(heavy, hashes[1], hashes[0]))
            deep = np.where(heavier, longest, np.where(heavy, 2, 1))
            closed = pa.array([b""] * len(at), pa.binary())
            suffix = pc.binary_join_element_wise(*columns, closed, b"\n", null_handling="skip")
            group = (route % np.uint64(groups)).astype(np.int32)
            order = np.argsort(group, kind="stable")
            there, starts = np.unique(group[order], return_index=True)
            offsets = pa.array(np.append(starts, len(order)).astype(np.int32))
            lang = pa.array(s.langs, pa.binary()).take(pa.array(s.ids[at]))
            lists = [c.take(pa.array(order)) for c in (pa.array(route.view(np.int64)), pa.array(deep, pa.int32()), lang, suffix, pa.array(n))]
            yield pa.record_batch([pa.array(there, pa.int32()), *[pa.ListArray.from_arrays(offsets, c) for c in lists]], ["group", *PARTS])
    return run


PARTS = ["route", "deep", "lang", "suffix", "n"]


def _sorted(table: pa.Table) -> pa.Table:
    """The suffixes of a group in order, equal ones added up."""
    table = table.take(pc.sort_indices(table, [("route", "ascending"), ("lang", "ascending"), ("suffix", "ascending")])).combine_chunks()
    other = np.ones(table.num_rows, bool)
    other[1:] = False
    for name in ("route", "lang", "suffix"):
        c = table.column(name)
        other[1:] |= ~pc.equal(c[1:], c[:-1]).to_numpy()
    at = np.flatnonzero(other)
    n = np.add.reduceat(table.column("n").to_numpy(), at)
    return table.take(pa.array(at)).set_column(4, "n", pa.array(n)).combine_chunks()


def _gathered(batches, room: int):
    """One table of sorted suffixes a group. Suffixes that many slices share are added up before they take more than ``room`` rows."""
    group, held, size = None, [], 0
    for batch in batches:
        for i, g in enumerate(batch.column(0).to_pylist()):
            if g != group and held:
                yield _sorted(pa.concat_tables(held))
                held, size = [], 0
            group = g
            row = batch.slice(i, 1)
            held.append(pa.table([row.column(name).flatten() for name in PARTS], PARTS))
            size += held[-1].num_rows
            if size > room:
                held = [_sorted(pa.concat_tables(held))]
                size, room = held[0].num_rows, max(room, 2 * held[0].num_rows)
    if held:
        yield _sorted(pa.concat_tables(held))


def _subtrees(least: int, longest: int, room: int):
    """(lang, phrase, words, n): the nodes of two words and more of the subtrees of a group. A node below its group's prefix is
    whole, and left out if it is rarer than ``least``; one above it is a part."""
    def run(batches):
        for table in _gathered(batches, room):
            suffix = table.column("suffix").combine_chunks()
            suffix = suffix.chunk(0) if isinstance(suffix, pa.ChunkedArray) else suffix
            offsets = np.frombuffer(suffix.buffers()[1], np.int32)[suffix.offset:suffix.offset + len(suffix) + 1]
            flat = np.frombuffer(suffix.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
            close = np.flatnonzero(flat == 10) + 1
            row_end = offsets[1:] - offsets[0]
            sizes = np.diff(np.searchsorted(close, row_end, "right"), prepend=0)
            ends = np.concatenate([[0], close]).astype(np.int64)
            numbers = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(close), [None, pa.py_buffer(ends), pa.py_buffer(flat.tobytes())])
            numbers = numbers.dictionary_encode().indices.to_numpy()
            path = np.full((len(suffix), longest), -1, np.int64)
            row = np.repeat(np.arange(len(suffix)), sizes)
            nth = np.arange(len(numbers)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            path[row, nth] = numbers
            stop = np.zeros((len(suffix), longest), np.int64)
            stop[row, nth] = close
            lang = table.column("lang").combine_chunks().dictionary_encode()
            lang = lang.chunk(0) if isinstance(lang, pa.ChunkedArray) else lang
            speech = lang.indices.to_numpy()
            n, deep = table.column("n").to_numpy(), table.column("deep").to_numpy()
            fresh = np.append(True, (speech[1:] != speech[:-1]) | (path[1:, 0] != path[:-1, 0]))
            data, begins = flat.tobytes(), (offsets[:-1] - offsets[0]).tolist()
            out = [], [], [], []
            for d in range(2, longest + 1):
                fresh[1:] |= path[1:, d - 1] != path[:-1, d - 1]
                at = np.flatnonzero(fresh)
                total = np.add.reduceat(n, at)
                some = (path[at, d - 1] >= 0) & ((total >= least) | (d < deep[at]))
                for i, t in zip(at[some].tolist(), total[some].tolist()):
                    out[0].append(i)
                    out[1].append(data[begins[i]:stop[i, d - 1] - 1])
                    out[2].append(d)
                    out[3].append(t)
            yield pa.record_batch([lang.dictionary.take(pa.array(speech[out[0]] if out[0] else [], pa.int32())), pa.array(out[1], pa.binary()),
                                   pa.array(out[2], pa.int32()), pa.array(out[3], pa.int64())], ["lang", "phrase", "words", "n"])
    return run


def counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(lang, n) with the number of words of each language, and (lang, phrase, words, f) for every phrase of up to ``longest`` words that
    occurs ``least`` times or more, its words closed by single line breaks but the last."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).cast("binary").alias("l"),
                       F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("t"))
    words = cut(rows.mapInArrow(_counted, "lang binary, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrase-words")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    singles = words.where(F.col("n") >= least)
    h = F.xxhash64(F.col("lang"), F.col("word"))
    good = bloom.build(singles.select(h.alias("h")))
    pairs = cut(rows.mapInArrow(_paired(good), "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "phrase-pairs")
    tied = bloom.build(pairs.select(F.col("pair").alias("h")))
    heavy = bloom.build(singles.where(F.col("n") > budget).select(h.alias("h")))
    heavier = bloom.build(pairs.where(F.col("n") > budget).select(F.col("pair").alias("h")))
    mass = pairs.agg(F.sum("n")).first()[0] or 0
    groups = max(partitions(spark), -(-mass // budget))
    suffixes = rows.mapInArrow(_suffixed(good, tied, heavy, heavier, longest, groups), "group int, route array<bigint>, deep array<int>, lang array<binary>, suffix array<binary>, n array<bigint>")
    dealt = suffixes.repartition(groups, "group").sortWithinPartitions("group")
    nodes = dealt.mapInArrow(_subtrees(least, longest, budget), "lang binary, phrase binary, words int, n bigint")
    long = nodes.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    short = singles.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), F.col("n").alias("f"))
    return sizes, cut(short.union(long.select("lang", "phrase", "words", "f")), "phrase-counts")


def quotient(a: Column, n: Column, l: Column, r: Column, scale: int) -> Column:
    """floor(scale * a * n / (l * r)) in whole numbers: products of counts up to 10^17 have 38 digits."""
    wide = [x.cast("decimal(17,0)") for x in (a, n, l, r)]
    return F.call_function("div", F.lit(scale).cast("decimal(4,0)") * wide[0] * wide[1], wide[2] * wide[3])


def _joined(words: Column) -> Column:
    return F.array_join(words, "\n").cast("binary")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5, first: int = 2000,
                 scale: int = 1000, budget: int = BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``first`` collocations by score, then count, then phrase.

    A-Z are lower-cased; texts are cut at punctuation and line ends into pieces, pieces at blanks into words. A phrase of 2 to ``longest``
    words has ``a`` occurrences, ``least`` at least. Of its cuts in two parts, with ``l`` and ``r`` occurrences, the one with the
    smallest ``floor(scale * a * n / (l * r))`` counts (ties: the shorter first part), ``n`` being the language's words. Phrases inside
    a longer one that occurs as often are left out. Null texts are empty, a null language is ``und``; repeated rows count again. The
    ``first`` limits the report, not what is counted."""
    sizes, found = counts(docs, text, lang, least, longest, budget)
    cuts = found.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    each = F.split(F.col("phrase").cast("string"), "\n")
    part = cuts.select("lang", "phrase", "words", "a", "k", _joined(F.slice(each, F.lit(1), F.col("k"))).alias("left"),
                       _joined(F.slice(each, F.col("k") + 1, F.col("words") - F.col("k"))).alias("right"))
    known = found.select(F.col("lang").alias("__lang"), F.col("phrase").alias("__phrase"), "f")
    part = part.join(known, (F.col("lang") == F.col("__lang")) & (F.col("left") == F.col("__phrase"))).select(
        "lang", "phrase", "words", "a", "k", "right", F.col("f").alias("l"))
    part = part.join(known, (F.col("lang") == F.col("__lang")) & (F.col("right") == F.col("__phrase"))).select(
        "lang", "phrase", "words", "a", "k", "l", F.col("f").alias("r"))
    part = part.join(sizes, "lang").withColumn("score", quotient(F.col("a"), F.col("n"), F.col("l"), F.col("r"), scale))
    best = part.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    # A longer phrase that occurs as often has one word more at one end: what lies between occurs as often too.
    inner = F.array(_joined(F.slice(each, F.lit(1), F.col("words") - 1)), _joined(F.slice(each, F.lit(2), F.col("words") - 1)))
    held = found.where("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("f").alias("a")).distinct()
    open_ = best.join(held, ["lang", "phrase", "a"], "left_anti")
    shown = open_.select("lang", F.translate(F.col("phrase").cast("string"), "\n", " ").alias("phrase"), "a", "b.l", "b.r", "n", "b.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = shown.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.select(F.col("lang").cast("string").alias("lang"), F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


# The same for DuckDB: every phrase spelled out and counted.
PHRASES_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
s AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, array_to_string(list_slice(w, i, i + k - 1), chr(10)) AS phrase, k AS words FROM w, range(1, 6) t(k), unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) u(i)),
f AS MATERIALIZED (SELECT lang, phrase, words, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, words, f AS a, k, array_to_string(list_slice(string_split(phrase, chr(10)), 1, k), chr(10)) AS lft,
      array_to_string(list_slice(string_split(phrase, chr(10)), k + 1, words), chr(10)) AS rgt FROM f, unnest(range(1, words)) t(k)),
x AS (SELECT c.lang, c.phrase, c.words, a, k, l.f AS l, r.f AS r, n, CAST((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
      FROM c JOIN f l ON l.lang = c.lang AND l.phrase = c.lft JOIN f r ON r.lang = c.lang AND r.phrase = c.rgt JOIN s ON s.lang = c.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM x),
h AS (SELECT DISTINCT lang, f AS a, unnest([array_to_string(list_slice(string_split(phrase, chr(10)), 1, words - 1), chr(10)),
      array_to_string(list_slice(string_split(phrase, chr(10)), 2, words), chr(10))]) AS phrase FROM f WHERE words > 2),
o AS (SELECT b.lang, replace(b.phrase, chr(10), ' ') AS phrase, b.a, l, r, n, score FROM b LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase AND h.a = b.a WHERE cut = 1 AND h.a IS NULL)
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o) WHERE rank <= 2000
"""

"""Repeated passages by paragraph MinHash banding.

A passage is a line of ``least`` words or more, lower-cased, or a block: two or more shorter lines that follow each other without a blank one,
taken as one run of words of that length, so that a hard-wrapped passage is found however its lines are broken. Equal passages are one
class; classes are compared as sets of five-word shingles. Bands are tuned to a wanted recall at the threshold: with r minima a band, b bands
find a pair of similarity s with probability 1 - (1 - s^r)^b. Classes that share a band's minima meet in cells of bounded rows and bytes, where
their exact Jaccard similarity is computed from the words themselves. Only the words of classes that meet another are read again, by a scan
that a Bloom filter of their digests tells which; documents are not shuffled. Verified links make components, and of each component the
first passage (smallest document, then line) stays.

A passage that stands in the middle of other text, wherever the lines break, is none of these: ``shared_runs`` finds runs of ``RUN`` words or more
that two documents share, by grams that are least among their neighbours (a band of one minimum) and so are the same in both.

Shorter lines (headings, licence tags) are no passages: that two documents share one says nothing about either. ``short_lines`` counts
them apart."""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vicinal.plans import bloom
from .common import Forest, components, cut, in_cells, met_in, whole_groups

SHINGLE = 5
CELL = 1024       # classes of a bucket that one chunk holds, about
BATCH = 1 << 20   # words hashed at once
CELL_BYTES = 32 << 20   # of words that one chunk holds, about
RUN = 51          # words that make a shared run a repeat, wherever it stands
NEAR = 12         # neighbours of which the least gram is compared


@dataclass(frozen=True)
class Settings:
    least: int = 20             # words that make a line or block a passage
    similarity: float = 0.8
    rows: int = 2               # minima a band
    recall: float = 0.995       # wanted at the threshold

    def bands(self) -> int:
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.similarity ** self.rows))


def passages(text: bytes, least: int):
    """(first line, number of lines, words) of every line of ``least`` words or more, and of every run of two or more shorter ones that have as
    many together; ``\\n`` ends a line, a line without words ends a run."""
    begin, block = 0, []
    for at, line in enumerate([*text.lower().split(b"\n"), b""]):
        words = line.split()
        if 0 < len(words) < least:
            if not block:
                begin = at
            block.append(words)
            continue
        if len(block) > 1 and sum(map(len, block)) >= least:
            yield begin, len(block), [w for line in block for w in line]
        block = []
        if words:
            yield at, 1, words


def shingles(words: list[bytes]) -> set[bytes]:
    return {b" ".join(words[i:i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(9).integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(words: list[list[bytes]], rows: int, bands: int) -> np.ndarray:
    """(paragraph, band): the minima of each band of every paragraph, mixed into one number."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    h = np.fromiter((zlib.crc32(w) for p in words for w in p), np.uint64, int(sizes.sum()))
    k = np.uint64(0x9E3779B97F4A7C15)
    n = len(h) - SHINGLE + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        mixed = mixed * k + h[i:n + i] + np.uint64(1)
    mixed ^= mixed >> np.uint64(29)
    starts = np.cumsum(sizes) - sizes
    inside = np.ones(n, bool)
    for back in range(1, SHINGLE):
        over = starts[1:] - back
        inside[over[over < n]] = False
    mixed = mixed[inside]
    first = np.cumsum(sizes - SHINGLE + 1) - (sizes - SHINGLE + 1)
    out = np.zeros((len(words), bands), np.uint64)
    factors = _multipliers(rows * bands)
    for b in range(bands):
        for r in range(rows):
            value = mixed * factors[b * rows + r]
            low = np.minimum.reduceat(value ^ (value >> np.uint64(32)), first)
            out[:, b] = (out[:, b] ^ low) * k + np.uint64(b + 1)
    return out.view(np.int64)


def band_lists(words: list[list[bytes]], rows: int, bands: int) -> pa.Array:
    """The band keys of every paragraph as a list, empty for one of fewer words than a shingle has."""
    long = [i for i, w in enumerate(words) if len(w) >= SHINGLE]
    keys = band_keys([words[i] for i in long], rows, bands).ravel() if long else np.empty(0, np.int64)
    sizes = np.zeros(len(words), np.int32)
    sizes[long] = bands
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(keys))


def paragraphs(docs: DataFrame, id: str, text: str, s: Settings) -> DataFrame:
    """(id, paragraph, lines, n_words, size, node, bands) of every passage; ``node`` is a 128-bit digest of its words, ``size`` their bytes."""
    bands = s.bands()

    def flush(held):
        listed = band_lists([h[3] for h in held], s.rows, bands)
        whole = [pa.array([h[i] for h in held], k) for i, k in enumerate((pa.int64(), pa.int32(), pa.int32()))]
        joined = [b" ".join(h[3]) for h in held]
        return pa.record_batch([*whole, pa.array([len(h[3]) for h in held], pa.int32()), pa.array([len(j) for j in joined], pa.int32()),
                                pa.array([xxhash.xxh3_128_digest(j) for j in joined], pa.binary()), listed],
                               ["id", "paragraph", "lines", "n_words", "size", "node", "bands"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for at, lines, words in passages(text.as_py() or b"", s.least):
                    held.append((id, at, lines, words))
                    size += len(words)
                if size >= BATCH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).cast("binary").alias("t"))
    return rows.mapInArrow(run, "id bigint, paragraph int, lines int, n_words int, size int, node binary, bands array<bigint>")


def _half(node: Column) -> Column:
    """The first eight bytes of a digest as a number."""
    return F.conv(F.hex(F.substring(node, 1, 8)), 16, -10).cast("bigint")


def _fetch(s: Settings, wanted: bloom.Bloom):
    """(node, words) of the passages that may be wanted; a task sends most of them once."""
    def run(batches):
        sent = set()
        for batch in batches:
            texts, nodes, marks = [], [], []
            for text in batch.column(0):
                for _, _, words in passages(text.as_py() or b"", s.least):
                    texts.append(b" ".join(words))
                    nodes.append(xxhash.xxh3_128_digest(texts[-1]))
            for i in np.flatnonzero(wanted.has(np.array([int.from_bytes(n[:8], "big") for n in nodes], np.uint64))).tolist():
                if nodes[i] not in sent:
                    sent.add(nodes[i])
                    marks.append(i)
            if len(sent) > BATCH:
                sent = set()
            yield pa.record_batch([pa.array([nodes[i] for i in marks], pa.binary()), pa.array([texts[i] for i in marks], pa.binary())], ["node", "words"])
    return run


def _links(s: Settings):
    def run(batches):
        for table, bounds in whole_groups(batches, ["band", "value", "cell_i", "cell_j"]):
            nodes = table.column("node").to_pylist()
            side = table.column("side").to_numpy()
            words = table.column("words")
            out = [[], []]
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                sets = [shingles(words[i].as_py().split()) for i in range(lo, hi)]
                forest = Forest(hi - lo)
                for i in range(hi - lo):
                    for j in range(i):
                        if side[lo] and side[lo + i] == side[lo + j] or forest.root(i) == forest.root(j):
                            continue
                        a, b = sets[i], sets[j]
                        both = len(a & b)
                        if both >= s.similarity * (len(a) + len(b) - both):
                            forest.link(j, i)
                out[0] += [nodes[lo + x] for x, _ in forest.kept]
                out[1] += [nodes[lo + y] for _, y in forest.kept]
            yield pa.record_batch([pa.array(c, pa.binary()) for c in out], ["a", "b"])
    return run


def repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings(), cell: int = CELL, size: int = CELL_BYTES) -> DataFrame:
    """One row for each passage that has an equal or near-equal one anywhere, its own document included: id, paragraph (number of its first
    line, from 0), lines, n_words, first_id and first_paragraph (the component's passage that stays), removed. Documents without such
    passages have no row.

    Null and empty texts have no passages. A null id sorts first. Rows repeated with one id count as the same place: a
    passage at the same line of both is not removed. Ids are longs; other columns are not read."""
    s = settings
    found = cut(paragraphs(docs, id, text, s), "paragraphs")
    place = F.struct("id", "paragraph")
    classes = cut(found.groupBy("node").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.first("size").alias("size"), F.first("bands").alias("bands")), "paragraph-classes")
    keyed = classes.select("node", "size", F.posexplode("bands").alias("band", "value"))
    crowded = keyed.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band", "value")
    keyed = cut(keyed.join(crowded, ["band", "value"]), "paragraph-buckets")
    wanted = bloom.build(keyed.select("node").distinct().select(_half(F.col("node")).alias("h")))
    words = docs.select(F.col(text).cast("binary").alias("t")).mapInArrow(_fetch(s, wanted), "node binary, words binary").dropDuplicates(["node"])
    placed = met_in(keyed, ["band", "value"], F.col("node"), cell, F.col("size"), size).drop("size").join(words, "node")
    links = in_cells(placed, ["band", "value"]).mapInArrow(_links(s), "a binary, b binary")
    roots = components(links, "paragraph-links")
    rooted = classes.select("node", "first", "last").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    whole = rooted.groupBy("root").agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first < last")
    shared = rooted.select("node", "root").join(whole, "root").select("node", "first")
    return found.join(shared, "node").select(
        F.col("id").alias(id), "paragraph", "lines", "n_words", F.col("first.id").alias("first_id"), F.col("first.paragraph").alias("first_paragraph"),
        (place != F.col("first")).alias("removed"))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _window_hashes(h: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash of every ``size`` neighbours: differences of the running sum of a polynomial, whose factor has an inverse modulo 2^64."""
    k = int(np.random.default_rng(seed).integers(1, 1 << 60)) * 8 + 5
    up, down = np.full(len(h), k, np.uint64), np.full(len(h), pow(k, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * np.cumprod(up), dtype=np.uint64)])
    return _mixed((sums[size:] - sums[:-size]) * np.cumprod(down)[:len(h) - size + 1])


def _least_of(h: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` neighbours."""
    wide = 1
    while 2 * wide <= size:
        h, wide = np.minimum(h[:-wide], h[wide:]), 2 * wide
    return np.minimum(h[:len(h) - (size - wide)], h[size - wide:])


def _grams(batches, gram: int, near: int):
    """(id, first word, first and last line, hash) of every gram of ``gram`` words whose hash is least among some ``near`` neighbours, as arrays
    of some texts each: two texts that share ``gram + near - 1`` words have one of them in common there."""
    def flush(held):
        h = np.concatenate([x[1] for x in held])
        line = np.concatenate([x[2] for x in held])
        sizes = np.array([len(x[1]) for x in held])
        start, doc = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(held)), sizes)
        hashes = _window_hashes(h, gram, 5)
        least = _least_of(hashes, near)
        inside = doc[:len(least)] == doc[gram + near - 2:]
        chosen = np.zeros(len(hashes), bool)
        for i in range(near):
            chosen[i:i + len(least)] |= inside & (hashes[i:i + len(least)] == least)
        at = np.flatnonzero(chosen)
        ids = pa.array([x[0] for x in held], pa.int64()).take(pa.array(doc[at]))
        return ids, (at - start[doc[at]]).astype(np.int32), line[at], line[at + gram - 1], _mixed(hashes[at]).view(np.int64)

    held, size = [], 0
    for batch in batches:
        for id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            lines = [line.split() for line in (text.as_py() or b"").lower().split(b"\n")]
            n = [len(line) for line in lines]
            if sum(n) < gram + near - 1:
                continue
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for line in lines for w in line), np.uint64, sum(n))
            held.append((id, hashes, np.repeat(np.arange(len(lines), dtype=np.int32), n)))
            size += len(hashes)
            if size >= BATCH:
                yield flush(held)
                held, size = [], 0
    if held:
        yield flush(held)


def shared_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = RUN, near: int = NEAR) -> DataFrame:
    """Passages that two documents share wherever they stand, one row for each stretch of a document that overlapping shared grams cover and
    that stands first in one document: id, paragraph and lines (first line and number of lines), n_words (words of the stretch), first_id
    and first_paragraph (smallest document of which its first gram is compared, and line there), removed (in another document), word (number of its first word, from 0).

    Grams have ``least - near + 1`` words; those are compared whose hash is least among some ``near`` neighbours. So every passage of ``least`` words or
    more that two documents share has a row, one of fewer words than a gram has none, and one in between may have one. Words are as
    in ``repeats``, line breaks are white space like any other. Documents shorter than ``least`` have no rows. A null id sorts first, and rows repeated with one id are
    one document."""
    gram = least - near + 1
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).cast("binary").alias("t"))

    def named(batches):
        for ids, _, _, _, h in _grams(batches, gram, near):
            yield pa.record_batch([pa.array(h), ids], ["h", "id"])

    without = F.max(F.col("id").isNull()).alias("without")
    names = rows.mapInArrow(named, "h bigint, id bigint").groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("b"), without)
    shared = cut(names.where("a < b or without and b is not null").select("h", F.when(~F.col("without"), F.col("a")).alias("first_id")), "run-grams")
    wanted = bloom.build(shared)

    def held(batches):
        for ids, word, line, last, h in _grams(batches, gram, near):
            some = np.flatnonzero(wanted.has(h))
            if len(some):
                yield pa.record_batch([pa.array(h[some]), ids.take(pa.array(some)), *[pa.array(x[some]) for x in (word, line, last)]], ["h", "id", "word", "line", "last"])

    found = cut(rows.mapInArrow(held, "h bigint, id bigint, word int, line int, last int").join(shared, "h"), "run-places")
    there = found.where(F.col("id").eqNullSafe(F.col("first_id"))).groupBy("h").agg(F.min("line").alias("there"))
    by = Window.partitionBy("id", "first_id").orderBy("word")
    begins = F.coalesce(F.col("word") - F.lag("word").over(by) > gram, F.lit(True)).cast("int")
    runs = found.withColumn("begins", begins).withColumn("run", F.sum("begins").over(by.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = runs.groupBy("id", "first_id", "run").agg(F.min("word").alias("word"), F.min("line").alias("line"), F.min_by("h", F.struct("word", "h")).alias("h"),
                                                     F.max("word").alias("end"), F.max("last").alias("last"))
    return whole.join(there, "h").select(
        F.col("id").alias(id), F.col("line").alias("paragraph"), (F.col("last") - F.col("line") + 1).alias("lines"), (F.col("end") - F.col("word") + gram).alias("n_words"),
        "first_id", F.col("there").alias("first_paragraph"), (~F.col("id").eqNullSafe(F.col("first_id"))).alias("removed"), "word")


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with the removed passages' lines taken out of its texts, row for row."""
    lines = F.explode(F.sequence("paragraph", F.col("paragraph") + F.col("lines") - 1)).alias("line")
    gone = repeats(docs, id, text, settings).where("removed").select(F.col(id).alias("__id"), lines).groupBy("__id").agg(F.collect_set("line").alias("__gone"))
    with_gone = docs.join(gone.hint("shuffle_hash"), docs[id].cast("bigint").eqNullSafe(F.col("__id")), "left")
    kept = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda line, i: ~F.array_contains(F.coalesce("__gone", F.array().cast("array<int>")), i)), "\n")
    return with_gone.select(*[(F.when(F.col("__gone").isNull(), F.col(text)).otherwise(kept).alias(c) if c == text else docs[c]) for c in docs.columns])


def _words(line: Column) -> Column:
    return F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def short_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Every line of fewer words than a passage has that stands in more than one place: line (its words, A-Z lower-cased, joined by
    spaces), n_words, n (places), n_ids (documents), first_id. Lines without words are none. Counted by partial sums: a line of every
    document is no task's list."""
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.explode(F.split(F.col(text), "\n")).alias("raw"))
    lower = F.translate("raw", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = rows.select("id", _words(lower).alias("w")).where(F.size("w").between(1, settings.least - 1))
    each = rows.groupBy(F.array_join("w", " ").alias("line"), F.size("w").alias("n_words"), "id").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("line", "n_words").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_ids"), F.min("id").alias("first_id")).where("n > 1")

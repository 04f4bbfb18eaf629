"""Exact duplicates by progressive refinement: length, then a hash of the first bytes, then a hash of everything.

A first scan notes every text's length and the hash of its first bytes. Texts are grouped by length; those whose length is not their own are
grouped by both; and only rows in a group of two or more have their whole content hashed by the second scan. What survives a step is
kept as a Bloom filter of bounded size, so texts are never shuffled: a filter that lets a row too many through costs one hash. The
last grouping, by length and whole hash, is over narrow rows and combined before the shuffle."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vicinal.plans import bloom
from .common import attach, cut

BLANKS = b" \t\n\x0b\x0c\r"
CONTINUED = bytes(range(0x80, 0xC0))      # bytes inside a code point of UTF-8
FIRST = 256      # bytes of a text that the second step looks at


def normal(text: bytes | None) -> bytes:
    """The text in UTF-8 without ASCII white space; a missing one is empty."""
    return (text or b"").translate(None, BLANKS)


def code_points(text: bytes | None) -> int:
    return len((text or b"").translate(None, CONTINUED))


def _begin(text: bytes) -> tuple[int, int]:
    """(length, hash of the first bytes and the length) of a normalised text."""
    return len(text), xxhash.xxh3_64_intdigest(text[:FIRST], len(text)) - (1 << 63)


def _noted(batches):
    for batch in batches:
        got = [_begin(normal(t.as_py())) for t in batch.column(0)]
        yield pa.record_batch([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64())], ["n", "begin"])


def candidates(docs: DataFrame, text: str) -> bloom.Bloom:
    """The filter of (length, first bytes) that more than one text has."""
    notes = cut(docs.select(F.col(text).cast("binary").alias("t")).mapInArrow(_noted, "n bigint, begin bigint"), "exact-begin")
    lengths = bloom.build(notes.groupBy("n").count().where("count > 1").select(F.xxhash64("n").alias("h")))
    begins = notes.where(lengths.column(F.xxhash64("n"))).groupBy("n", "begin").count().where("count > 1")
    return bloom.build(begins.select(F.col("begin").alias("h")))


def duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: list[str] | None = None, digest: bool = False) -> DataFrame:
    """One row for each row of ``docs``: id, keep_id (id of the row that stays of its group), group_size, kept, sha256 (binary, of the normalised
    text), and the columns ``keep``. ``sha256`` is null for rows that no other could equal, unless ``digest`` asks for every row's.

    Texts are equal when they are after deleting ASCII white space; null counts as empty. Of a group the row with the most
    code points stays, then the one with the smallest id (null ids last). Of repeated rows that tie in both exactly one stays. An
    empty table gives an empty one. Columns in ``keep`` may have any names but the first five."""
    keep = list(keep or [])
    asked = candidates(docs, text)

    def hashed(batches):
        for batch in batches:
            points, sizes, again, full = [], [], [], []
            for t in batch.column(1):
                raw = t.as_py()
                short = normal(raw)
                n, begin = _begin(short)
                sizes.append(n)
                again.append(begin)
                points.append(code_points(raw))
                full.append(short)
            hit = asked.has(pa.array(again, pa.int64()).to_numpy())
            full = [hashlib.sha256(s).digest() if digest or h else None for s, h in zip(full, hit.tolist())]
            new = [pa.array(points, pa.int64()), pa.array(sizes, pa.int64()), pa.array(hit, pa.bool_()), pa.array(full, pa.binary())]
            yield pa.record_batch([batch.column(0), *batch.columns[2:], *new], [f"c{i}" for i in range(len(keep) + 5)])

    given = docs.select(F.col(f"`{id}`"), F.col(f"`{text}`").cast("binary"), *[F.col(f"`{c}`") for c in keep])
    given = given.toDF(*[f"g{i}" for i in range(len(keep) + 2)])
    kinds = [given.schema[0].dataType, *[f.dataType for f in given.schema[2:]], T.LongType(), T.LongType(), T.BooleanType(), T.BinaryType()]
    rows = given.mapInArrow(hashed, T.StructType([T.StructField(f"c{i}", k) for i, k in enumerate(kinds)]))
    rows = rows.toDF("id", *[f"k{i}" for i in range(len(keep))], "points", "n", "again", "sha256")
    # The mark only tells repeated rows apart; once written it is fixed.
    rows = cut(rows.withColumn("mark", F.monotonically_increasing_id()), "exact-rows")
    best = F.min(F.struct((-F.col("points")).alias("points"), F.col("id").isNull().alias("none"), "id", "mark")).alias("best")
    groups = cut(rows.where("again").groupBy("n", "sha256").agg(F.count(F.lit(1)).alias("group_size"), best).where("group_size > 1"), "exact-groups")
    met = attach(rows.where("again"), groups, ["n", "sha256"], "group_size", how="left")
    more = ["sha256", *[f"k{i}" for i in range(len(keep))]]
    found = met.select("id", F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
                       F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                       F.coalesce(F.col("mark") == F.col("best.mark"), F.lit(True)).alias("kept"), *more)
    alone = rows.where("not again").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *more)
    return found.union(alone).toDF(id, "keep_id", "group_size", "kept", "sha256", *keep)


def without_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with its columns. Only rows of groups travel."""
    names = [f"k{i}" for i in range(len(docs.columns))]
    named = docs.toDF(*names)
    got = duplicates(named, names[docs.columns.index(id)], names[docs.columns.index(text)], keep=names)
    return got.toDF("__id", "__keep", "__size", "__kept", "__sha", *names).where("__kept").select(*names).toDF(*docs.columns)


# The same rule for DuckDB.
EXACT_SQL = r"""
WITH n AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS short FROM documents),
g AS (SELECT *, count(*) OVER (PARTITION BY short) AS group_size, row_number() OVER (PARTITION BY short ORDER BY length(text) DESC, doc_id) AS place,
      first_value(doc_id) OVER (PARTITION BY short ORDER BY length(text) DESC, doc_id) AS keep_id FROM n)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept, sha256(short) AS text_sha256 FROM g
"""

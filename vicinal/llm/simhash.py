"""SimHash near-duplicates, found with BK-trees.

Fingerprints are computed where the texts lie; from then on only (id, 64 bits) move. Equal fingerprints become one
class. Two fingerprints that differ in at most ``radius`` bits agree on all but ``radius`` of ``blocks`` bit blocks, so
the classes are dealt to shards by every choice of ``blocks - radius`` blocks, and close ones share a shard. A shard's
BK-tree (children keyed by their Hamming distance to the parent) answers each member by following only edges within the
radius. A shard beyond ``TREE`` fingerprints is cut into chunks; each chunk's tree, bounded in size, goes to every
chunk of queries of its shard. A cell returns a spanning forest of the links it verified, which loses no connection and
stays linear in the cell, and the forests meet in ``components``."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Forest, cells, components, cut, whole_groups

TREE = 2048      # fingerprints in one tree at most, about
CROWD = 64       # fingerprints that a shard should have when they are spread evenly


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a UTF-8 text; as a signed number. See ``fingerprints``."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        shingles = [line]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.append(0, ends[:-1])[: len(words) - width + 1]
        shingles = [line[a:b] for a, b in zip(starts.tolist(), (ends[width - 1:] - 1).tolist())]
    total = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, len(shingles), 65536):
        part = b"".join([digest(s, seed) for s in shingles[at:at + 65536]])
        total += np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(shingles)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(id, fp): the SimHash of every row. A-Z are lower-cased, words are runs of anything but ASCII white space, features
    are ``width`` words joined by spaces, repeats included (a shorter text is one feature). A bit is set if over half of
    the features' XXH64 values have it. A text without words, empty or null, gets fingerprint 0."""
    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            got = [fingerprint(t.as_py() or b"", width, seed) for t in texts]
            yield pa.record_batch([batch.column(0), pa.array(got, pa.int64())], ["id", "fp"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("t")).mapInArrow(run, f"id {kind}, fp bigint")


class BKTree:
    """Children are keyed by their Hamming distance to the parent."""

    def __init__(self):
        self.root = None

    def add(self, fp: int, mark) -> None:
        if self.root is None:
            self.root = (fp, mark, {})
            return
        node = self.root
        while True:
            d = (node[0] ^ fp).bit_count()
            if d not in node[2]:
                node[2][d] = (fp, mark, {})
                return
            node = node[2][d]

    def near(self, fp: int, radius: int) -> list:
        """Marks of all members within the radius."""
        out, todo = [], [self.root] if self.root else []
        while todo:
            at, mark, children = todo.pop()
            d = (at ^ fp).bit_count()
            if d <= radius:
                out.append(mark)
            if len(children) > 2 * radius + 1:
                todo.extend(children[x] for x in range(d - radius, d + radius + 1) if x in children)
            else:
                todo.extend(c for x, c in children.items() if d - radius <= x <= d + radius)
        return out


def shard_keys(fp: Column, blocks: int, radius: int, bits: int = 64) -> Column:
    """Array of (shard, value): the bits left by every choice of blocks - radius of the blocks."""
    edges = [bits * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    out = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = 0
        for c in chosen:
            mask |= masks[c]
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        out.append(F.struct(F.lit(n).alias("shard"), fp.bitwiseAND(F.lit(mask)).alias("value")))
    return F.array(*out)


def _links(radius: int):
    def run(batches):
        full = (1 << 64) - 1
        for table, bounds in whole_groups(batches, ["shard", "value", "cell_i", "cell_j"]):
            fps = table.column("fp").to_pylist()
            sides = table.column("side").to_pylist()
            a, b = [], []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                tree, forest = BKTree(), Forest(hi - lo)
                members = [(i, fps[i] & full, sides[i]) for i in range(lo, hi)]
                for i, fp, side in members:
                    if side == 1:
                        tree.add(fp, i - lo)
                for i, fp, side in members:
                    if side != 1:
                        for other in tree.near(fp, radius):
                            forest.link(other, i - lo)
                    if side == 0:
                        tree.add(fp, i - lo)
                a.extend(fps[lo + x] for x, _ in forest.kept)
                b.extend(fps[lo + y] for _, y in forest.kept)
            if a:
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def close_fingerprints(classes: DataFrame, radius: int = 3, blocks: int | None = None, tree: int = TREE) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` at most ``radius`` bits apart, enough of them to connect all
    that are connected. ``blocks`` only changes how much work is done: by default it grows until a shard of evenly spread
    fingerprints has about ``CROWD``."""
    if blocks is None:
        n, blocks = classes.count(), radius + 1
        while n >> (64 * (blocks - radius) // blocks) > CROWD and blocks < radius + 5:
            blocks += 1
    keyed = classes.select("fp", F.explode(shard_keys(F.col("fp"), blocks, radius)).alias("k")).select("k.shard", "k.value", "fp")
    return cells(keyed, ["shard", "value"], F.col("fp"), tree).mapInArrow(_links(radius), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", radius: int = 3, width: int = 3, seed: int = 42,
                    tree: int = TREE) -> DataFrame:
    """One row for each row of ``docs``: id, fp, component_id (smallest id that links of at most ``radius`` differing bits
    reach, itself included).

    Rows with equal fingerprints are linked, repeated rows and rows without words among them. A null id is never the
    smallest unless nothing else is reached. An empty table gives an empty one. Other columns are not read."""
    got = _rooted(docs, id, text, radius, width, seed, tree)
    return got.select(F.col("id").alias(id), "fp", "component_id")


def _rooted(docs: DataFrame, id: str, text: str, radius: int = 3, width: int = 3, seed: int = 42, tree: int = TREE) -> DataFrame:
    """(id, tag, fp, root, component_id): as ``near_duplicates``, with what tells rows of one id apart."""
    def run(batches):
        for batch in batches:
            got = [fingerprint(t.as_py() or b"", width, seed) for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(got, pa.int64())], ["id", "tag", "fp"])

    kind = docs.schema[id].dataType.simpleString()
    prints = cut(tagged(docs, id, text).mapInArrow(run, f"id {kind}, tag bigint, fp bigint"), "simhash")
    classes = prints.groupBy("fp").agg(F.min("id").alias("rep"))
    found = components(close_fingerprints(classes.select("fp"), radius, tree=tree), "simhash-links")
    rooted = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    best = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(best, "root")
    return prints.join(by_fp, "fp").select("id", "tag", "fp", "root", "component_id")


def tagged(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, tag, t) of every row; ``tag`` is a hash of its text, which tells rows of one id apart."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("t"))
    return rows.select("id", F.xxhash64("t").alias("tag"), "t")


def kept(docs: DataFrame, got: DataFrame, id: str, text: str) -> DataFrame:
    """Of each component of ``got`` (id, tag, root, component_id), the row of ``docs`` whose id is the component's. Rows are told by id and
    text. Of several rows of that id in the component one stays (the smallest by text); of several with a null id each stays."""
    mine = got.where(F.col("id").eqNullSafe(F.col("component_id")))
    sizes = mine.groupBy("root").agg(F.count(F.lit(1)).alias("__rows"))
    stay = mine.select("id", "tag", "root").distinct().join(sizes, "root").select(
        F.col("id").alias("__id"), F.col("tag").alias("__tag"), F.col("root").alias("__root"), "__rows").hint("shuffle_hash")
    tag = F.xxhash64(docs[text].cast("binary"))
    rows = docs.join(stay, docs[id].eqNullSafe(stay["__id"]) & (tag == stay["__tag"]))
    single = rows.where(F.col("__id").isNull() | (F.col("__rows") == 1)).select(docs.columns)
    several = rows.where(F.col("__id").isNotNull() & (F.col("__rows") > 1))
    order = [F.col(c) for c in docs.columns if docs.schema[c].dataType.typeName() not in ("map", "variant")]
    first = several.withColumn("__first", F.row_number().over(Window.partitionBy("__root").orderBy(*order))).where("__first = 1")
    return single.union(first.select(docs.columns))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component, the row whose id is the component's. Of repeated rows of
    that id in the component one stays (the smallest by text). Rows with a null id stay where nothing else of their component has
    one; of several such rows in one component each stays, because nothing tells which is first."""
    return kept(docs, _rooted(docs, id, text, **how), id, text)

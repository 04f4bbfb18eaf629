"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Training uses a bounded sample of labelled rows (``Settings.max_rows``, the rows of smallest hash); their distinct hashed
features, not their texts, reach the driver. Per-coordinate rates and L1 leave a sparse weight vector of at most
``2 ** bits`` entries, which is broadcast; scoring is one pass over whole texts without a shuffle."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BREAKS = re.compile(r"[\W_]+")


@dataclass(frozen=True)
class Settings:
    bits: int = 20            # size of the hashed feature space
    stem: int = 4             # bytes of a word that its truncated form keeps
    max_rows: int = 8192      # labelled rows trained on, at most
    epochs: int = 4
    alpha: float = 1.0        # learning rate of a coordinate
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 1.0


@dataclass(frozen=True)
class Model:
    bias: float
    index: np.ndarray         # features with a weight, ascending
    weight: np.ndarray
    settings: Settings
    rows: int                 # rows trained on


def hashed(text: str, s: Settings) -> np.ndarray:
    """Feature numbers of a whole text, repeats included: words, truncated words, pairs of neighbours, and pairs with
    one word between (skip-grams). Words are runs of letters and digits in lower case."""
    words = BREAKS.sub(" ", text.lower()).encode("utf-8", "surrogatepass").split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint32)
    w = np.fromiter(map(zlib.crc32, words), np.uint32, n).astype(np.uint64)
    stem = s.stem
    t = np.fromiter(map(zlib.crc32, [x[:stem] for x in words]), np.uint32, n).astype(np.uint64)
    # Fixed odd multipliers (multiplicative hashing); the top bits of the product number the feature.
    k1, k2, k3, k4 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
    parts = [w * k1, (t + np.uint64(1)) * k2, (w[:-1] * k2 + w[1:]) * k3, (w[:-2] * k3 + w[2:]) * k4]
    return (np.concatenate(parts) >> np.uint64(64 - s.bits)).astype(np.uint32)


def fit_ftrl(rows: list[np.ndarray], labels: np.ndarray, s: Settings) -> Model:
    """Per-coordinate FTRL-proximal on binary features, one row at a time in the given order. The bias has no L1.
    Without rows of both labels nothing can be learnt: every score is then (about) 0."""
    if not len(rows) or labels.min() == labels.max():
        return Model(-40.0, np.empty(0, np.uint32), np.empty(0), s, len(rows))
    z, n = np.zeros(1 << s.bits), np.zeros(1 << s.bits)
    zb = nb = 0.0
    for _ in range(s.epochs):
        for x, y in zip(rows, labels.tolist()):
            zx, nx = z[x], n[x]
            root = np.sqrt(nx)
            w = np.where(np.abs(zx) <= s.l1, 0.0, (np.sign(zx) * s.l1 - zx) / ((s.beta + root) / s.alpha + s.l2))
            wb = -zb / ((s.beta + nb ** 0.5) / s.alpha)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + wb, -35, 35))) - y
            z[x] = zx + g - (np.sqrt(nx + g * g) - root) / s.alpha * w
            n[x] = nx + g * g
            zb += g - ((nb + g * g) ** 0.5 - nb ** 0.5) / s.alpha * wb
            nb += g * g
    w = np.where(np.abs(z) <= s.l1, 0.0, (np.sign(z) * s.l1 - z) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))
    at = np.flatnonzero(w)
    return Model(float(-zb / ((s.beta + nb ** 0.5) / s.alpha)), at.astype(np.uint32), w[at], s, len(rows))


def held_out(id: Column, folds: int = 5) -> Column:
    """Rows that training never sees: crc32 of the id as text is divisible by ``folds`` (a null id counts as '')."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
          settings: Settings = Settings()) -> Model:
    """Fit on the labelled rows outside the hold-out. Rows without an id or label are left out; an id labelled twice
    counts with its larger label, an id with several texts with one of them."""
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(id)))
    known = known.groupBy(F.col(id).alias("id")).agg(F.max(label).cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("id", F.lit(6)), "id").limit(settings.max_rows)

    def run(batches):
        for batch in batches:
            feats = [np.unique(hashed(t.as_py() or "", settings)).astype("<u4").tobytes() for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(feats, pa.binary())], ["id", "y", "x"])

    kind = known.schema["id"].dataType.simpleString()
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("t")).join(F.broadcast(known), "id").select("id", "y", "t")
    rows = texts.mapInArrow(run, f"id {kind}, y int, x binary").groupBy("id").agg(F.min("y").alias("y"), F.min("x").alias("x"))
    got = rows.toArrow()
    ids, y, x = got.column("id").to_pylist(), got.column("y").to_numpy(), got.column("x").to_pylist()
    del got
    order = sorted(range(len(ids)), key=lambda i: (zlib.crc32(str(ids[i]).encode()), str(ids[i])))
    return fit_ftrl([np.frombuffer(x[i], "<u4") for i in order], y[order] if order else y, settings)


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(columns ``keep``, by default the id; score): the probability of label 1 for every row, null and empty texts
    included (they score by the bias alone). Only whether a text has a feature counts, not how often."""
    keep = [id] if keep is None else keep
    sent = docs.sparkSession.sparkContext.broadcast((model.index, model.weight, model.bias))
    s = model.settings

    def run(batches):
        index, weight, bias = sent.value
        dense = np.zeros(1 << s.bits)
        dense[index] = weight
        live = dense != 0
        for batch in batches:
            out = []
            for t in batch.column(batch.num_columns - 1):
                x = hashed(t.as_py() or "", s)
                x = np.unique(x[live[x]])
                out.append(1.0 / (1.0 + np.exp(-np.clip(dense[x].sum() + bias, -35, 35))))
            yield pa.record_batch([*batch.columns[:-1], pa.array(out, pa.float64())], names)

    frame = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("__text"))
    names = [*keep, "score"]
    schema = frame.select(*keep).schema.add("score", "double")
    return frame.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows whose score is below ``limit``, with the columns of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast((model.index, model.weight, model.bias))
    s, at = model.settings, docs.columns.index(text)

    def run(batches):
        index, weight, bias = sent.value
        dense = np.zeros(1 << s.bits)
        dense[index] = weight
        live = dense != 0
        cutoff = np.log(limit / (1 - limit)) - bias
        for batch in batches:
            keep = []
            for t in batch.column(at):
                x = hashed(t.as_py() or "", s)
                keep.append(bool(dense[np.unique(x[live[x]])].sum() < cutoff))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

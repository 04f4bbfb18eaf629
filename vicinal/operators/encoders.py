"""Compact encodings of vectors. Each encoder is a small picklable object holding its trained arrays:

* ``encode(matrix) -> bytes`` per row and ``decode(codes) -> matrix`` for the distance step,
* ``query(matrix)`` puts query vectors into the form that the decoded rows are compared with,
* ``metric(space)`` names the comparison, so every encoder runs through the same scan.
"""

from __future__ import annotations

import io
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from vicinal.operators.blocks import METRIC_OF_SPACE, as_bytes, as_matrix, binary_array, list_array, to_words, where_valid
from vicinal.spec import FP16_MAX, ROTATION_SEED, SpecError


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return rows / np.where(norm > 0, norm, 1.0)[:, None]


class Encoder:
    name = ""

    def metric(self, space: str) -> str:
        return METRIC_OF_SPACE[space]

    def query(self, rows: np.ndarray, space: str) -> np.ndarray:
        return rows

    def encode_rows(self, rows: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def decode_rows(self, codes: np.ndarray, space: str) -> np.ndarray:
        raise NotImplementedError

    def column(self, vec) -> Column:
        """The code of a vector column, as a binary column; null stays null."""
        encode = self.encode_rows

        @F.arrow_udf("binary")
        def run(values: pa.Array) -> pa.Array:
            return where_valid(values, pa.binary(), lambda v: binary_array(encode(as_matrix(v).astype(np.float64))))

        return run(F.col(vec) if isinstance(vec, str) else vec)

    def decoded(self, code, space: str = "l2") -> Column:
        """The approximate vector of a code column; null stays null."""
        decode = self.decode_rows

        @F.arrow_udf("array<double>")
        def run(codes: pa.Array) -> pa.Array:
            return where_valid(codes, pa.list_(pa.float64()), lambda v: list_array(decode(as_bytes(v), space).astype(np.float64)))

        return run(F.col(code) if isinstance(code, str) else code)


@dataclass
class BitQuantizer(Encoder):
    """b thresholds per dimension; bit i of dimension j is set where the value exceeds threshold i.

    Bits are laid out plane after plane, most significant bit first, zero-filled to whole bytes.
    ``below``/``above`` are the means on either side of the single threshold (1 bit only). With ``unit`` rows and queries are
    scaled to length 1 first, as thresholds for cosine are trained.
    """

    thresholds: np.ndarray
    below: np.ndarray | None = None
    above: np.ndarray | None = None
    rotation: np.ndarray | None = None
    unit: bool = False
    name = "binary"

    @property
    def bits(self) -> int:
        return self.thresholds.shape[0]

    def rotate(self, rows: np.ndarray) -> np.ndarray:
        return rotated(_unit(rows.astype(np.float64)) if self.unit else rows, self.rotation)

    def encode_rows(self, rows):
        rows = self.rotate(rows)
        planes = rows[:, None, :] > self.thresholds[None]
        return np.packbits(planes.reshape(len(rows), -1), axis=1)

    def decode_rows(self, codes, space):
        """One value a bit: all planes, ``bits * dim`` of them."""
        return np.unpackbits(codes, axis=1)[:, :self.thresholds.size].astype(np.float32)

    def metric(self, space):
        return "hamming"

    def query(self, rows, space):
        return self.encode_rows(rows)

    def adc_query(self, rows: np.ndarray, space: str) -> np.ndarray:
        """Query moved to the scale on which a code reads 0 or 1; a dimension with equal means counts as 0.5."""
        if self.bits != 1 or self.below is None:
            raise SpecError("asymmetric distance needs 1-bit codes with below/above means")
        rows = self.rotate(rows).astype(np.float64)
        gap = self.above - self.below
        safe = np.where(gap != 0, gap, 1.0)
        moved = np.where(gap != 0, (rows - self.below) / safe, 0.5)
        if space == "l2":
            moved = gap * gap * (moved - 0.5) + 0.5
        return moved


ADC_METRIC = {"l2": "l2", "innerproduct": "ip", "cosinesimil": "ip_gap"}


def adc_column(quantizer: BitQuantizer, vec, space: str) -> Column:
    """The asymmetric-distance form of a query column."""
    if space not in ADC_METRIC:
        raise SpecError(f"space {space!r} is not supported with asymmetric distance")

    @F.arrow_udf("array<double>")
    def run(values: pa.Array) -> pa.Array:
        return where_valid(values, pa.list_(pa.float64()), lambda v: list_array(quantizer.adc_query(as_matrix(v), space)))

    return run(F.col(vec) if isinstance(vec, str) else vec)


@dataclass
class Fp16(Encoder):
    clip: bool = False
    name = "fp16"

    def encode_rows(self, rows):
        if self.clip:
            rows = np.clip(rows, -FP16_MAX, FP16_MAX)
        elif len(rows) and np.abs(rows).max() > FP16_MAX:
            raise ValueError(f"a value lies outside +-{FP16_MAX}; pass clip=True to cut it off")
        return np.ascontiguousarray(rows.astype("<f2")).view(np.uint8)

    def decode_rows(self, codes, space):
        return np.ascontiguousarray(codes).view("<f2").astype(np.float32)


@dataclass
class ByteCode(Encoder):
    """Integer-valued vectors in -128..127, one byte per dimension."""

    name = "byte"

    def encode_rows(self, rows):
        if len(rows) and (np.any(rows != np.rint(rows)) or rows.min() < -128 or rows.max() > 127):
            raise ValueError("byte vectors must hold whole numbers in -128..127")
        return rows.astype(np.int8).view(np.uint8)

    def decode_rows(self, codes, space):
        return codes.view(np.int8).astype(np.float32)


@dataclass
class Sq7(Encoder):
    """7-bit linear codes between two bounds shared by all dimensions."""

    low: float
    high: float
    name = "sq7"

    def encode_rows(self, rows):
        span = (self.high - self.low) or 1.0
        return np.rint((np.clip(rows, self.low, self.high) - self.low) / span * 127).astype(np.uint8)

    def decode_rows(self, codes, space):
        return self.low + codes.astype(np.float64) * ((self.high - self.low) / 127)


def fit_interval(rows: np.ndarray, bits: int, rounds: int = 5):
    """Per-row interval [low, high] whose 2**bits even levels fit the row best, and the level numbers.

    Alternates between assigning levels and the least-squares line through them.
    """
    top = (1 << bits) - 1
    if bits == 1:
        mean, std = rows.mean(axis=1), rows.std(axis=1)
        low, high = mean - std, mean + std
    else:
        low, high = rows.min(axis=1), rows.max(axis=1)
    for _ in range(rounds):
        step = np.where(high > low, (high - low) / top, 1.0)
        level = np.clip(np.rint((rows - low[:, None]) / step[:, None]), 0, top)
        mid = level.mean(axis=1)
        spread = ((level - mid[:, None]) ** 2).sum(axis=1)
        slope = np.where(spread > 0, ((level - mid[:, None]) * rows).sum(axis=1) / np.where(spread > 0, spread, 1.0), 0.0)
        base = rows.mean(axis=1) - slope * mid
        fits = slope > 0
        low, high = np.where(fits, base, low), np.where(fits, base + slope * top, high)
    step = np.where(high > low, (high - low) / top, 1.0)
    level = np.clip(np.rint((rows - low[:, None]) / step[:, None]), 0, top).astype(np.uint8)
    return low, high, level


@dataclass
class Sq1(Encoder):
    """1-bit codes of centred vectors with per-row corrections; queries take 4 bits.

    A code is the packed bits, then float32 lower and upper level, float32 correction, float32 length of what the
    levels leave over, int32 count of set bits.
    The distance estimate is an inner product of the rebuilt vectors plus the corrections, so the rows are
    extended by two columns and run through the ordinary inner-product scan.
    """

    centroid: np.ndarray
    space: str
    name = "sq1"

    def _centred(self, rows):
        rows = rows.astype(np.float64)
        return (_unit(rows) if self.space == "cosinesimil" else rows), self.centroid

    def encode_rows(self, rows):
        rows, centre = self._centred(rows)
        moved = rows - centre
        low, high, level = fit_interval(moved, 1)
        extra = (moved * moved).sum(axis=1) if self.space == "l2" else rows @ centre
        low, high = low.astype("<f4"), high.astype("<f4")
        rebuilt = low.astype(np.float64)[:, None] + level * (high.astype(np.float64) - low)[:, None]
        left = np.sqrt(((moved - rebuilt) ** 2).sum(axis=1))
        tail = np.stack([low, high, extra, np.nextafter(left.astype("<f4"), np.float32(np.inf))], axis=1).astype("<f4")
        count = level.sum(axis=1).astype("<i4")[:, None]
        return np.concatenate([np.packbits(level, axis=1), np.ascontiguousarray(tail).view(np.uint8),
                               np.ascontiguousarray(count).view(np.uint8)], axis=1)

    def _rebuilt(self, codes):
        dim = len(self.centroid)
        width = -(-dim // 8)
        level = np.unpackbits(codes[:, :width], axis=1)[:, :dim].astype(np.float64)
        tail = np.ascontiguousarray(codes[:, width:width + 16]).view("<f4").astype(np.float64)
        low, high = tail[:, 0:1], tail[:, 1:2]
        return low + level * (high - low), tail[:, 2:3], tail[:, 3:4]

    def decode_rows(self, codes, space):
        rebuilt, extra, _ = self._rebuilt(codes)
        return np.concatenate([rebuilt, extra, np.ones_like(extra)], axis=1)

    def bound_rows(self, codes, space):
        """Rows whose product with ``bound_query`` never exceeds the true distance: what the levels leave over can
        bring a pair closer by at most the product of its length and the centred query's."""
        rebuilt, extra, left = self._rebuilt(codes)
        rounding = 2e-7 * np.abs(extra)  # of the float32 correction
        extra = extra - rounding if self.space == "l2" else extra + rounding
        return np.concatenate([rebuilt, extra, np.ones_like(extra), left], axis=1)

    def bound_query(self, rows, space):
        rows, centre = self._centred(rows)
        moved = rows - centre
        size = (moved * moved).sum(axis=1)[:, None]
        one = np.ones((len(rows), 1))
        if self.space == "l2":
            return np.concatenate([2 * moved, -one, -size, 2 * np.sqrt(size)], axis=1)
        return np.concatenate([moved, one, (rows @ centre - centre @ centre)[:, None], np.sqrt(size)], axis=1)

    def metric(self, space):
        if space != self.space:
            raise SpecError("the codes were made for another space")
        return "ip_gap" if space == "cosinesimil" else "ip"

    def query(self, rows, space):
        rows, centre = self._centred(rows)
        moved = rows - centre
        low, high, level = fit_interval(moved, 4)
        rebuilt = low[:, None] + level * ((high - low) / 15)[:, None]
        one = np.ones((len(rows), 1))
        if self.space == "l2":
            return np.concatenate([2 * rebuilt, -one, -(moved * moved).sum(axis=1)[:, None]], axis=1)
        return np.concatenate([rebuilt, one, (rows @ centre - centre @ centre)[:, None]], axis=1)


@dataclass
class ProductQuantizer(Encoder):
    """m sub-vectors, each replaced by the number of its nearest centroid; ``codebook`` is (m, centroids, dim / m). A number takes one byte,
    or two (the higher first) where there are more than 256 centroids."""

    codebook: np.ndarray
    unit: bool = False
    name = "pq"

    def encode_rows(self, rows):
        rows = _unit(rows) if self.unit else rows
        m, k, width = self.codebook.shape
        numbers = np.stack([nearest_centroid(rows[:, s * width:(s + 1) * width], self.codebook[s]) for s in range(m)], axis=1)
        return numbers.astype(np.uint8) if k <= 256 else np.ascontiguousarray(numbers.astype(">u2")).view(np.uint8)

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """(row, sub-vector) centroid numbers of codes."""
        return codes if self.codebook.shape[1] <= 256 else np.ascontiguousarray(codes).view(">u2")

    def decode_rows(self, codes, space):
        numbers = self.numbers(codes)
        return np.concatenate([self.codebook[s][numbers[:, s]] for s in range(len(self.codebook))], axis=1)

    def metric(self, space):
        return "ip_gap" if space == "cosinesimil" else METRIC_OF_SPACE[space]

    def query(self, rows, space):
        return _unit(rows.astype(np.float64)) if space == "cosinesimil" else rows


def nearest_centroid(rows: np.ndarray, centroids: np.ndarray, metric: str = "l2") -> np.ndarray:
    """Number of the nearest centroid of each row; the lowest number wins a tie."""
    if metric == "l2" and len(centroids) >= TWO_LEVELS and len(rows) >= TWO_LEVELS // 4:
        return nearest_in_two_levels(rows, centroids)
    return nearest_centroids(rows, centroids, 1, metric)[:, 0]


TWO_LEVELS = 1024      # centroids from which a search in two levels pays


def nearest_in_two_levels(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """``nearest_centroid`` for many centroids. They are grouped around about as many pivots as a group has members. A row compares the
    pivots first, then only groups that the triangle inequality cannot exclude, nearest first; the result is the same."""
    rows, centroids = rows.astype(np.float64), centroids.astype(np.float64)
    pivots = centroids[np.linspace(0, len(centroids) - 1, int(len(centroids) ** 0.5)).astype(int)]
    home = nearest_centroids(centroids, pivots, 1, "l2")[:, 0]
    groups = [np.flatnonzero(home == g) for g in range(len(pivots))]
    reach = np.array([np.sqrt(((centroids[m] - pivots[g]) ** 2).sum(axis=1).max()) if len(m) else -np.inf for g, m in enumerate(groups)])
    size = (centroids * centroids).sum(axis=1)
    out = np.empty(len(rows), np.int64)
    step = max(1, 4_000_000 // len(pivots))
    for s in range(0, len(rows), step):
        x = rows[s:s + step]
        own = (x * x).sum(axis=1)
        far = np.sqrt(np.maximum(own[:, None] + (pivots * pivots).sum(axis=1)[None] - 2 * (x @ pivots.T), 0.0))
        least = np.maximum(far - reach[None] - 1e-6 * (1 + far), 0.0) ** 2      # room for rounding
        best, number = np.full(len(x), np.inf), np.full(len(x), -1, np.int64)

        def look(at: np.ndarray, g: int) -> None:
            members = groups[g]
            score = size[members][None] - 2 * (x[at] @ centroids[members].T)
            place = score.argmin(axis=1)
            found, who = score[np.arange(len(at)), place], members[place]
            better = (found < best[at]) | ((found == best[at]) & (who < number[at]))
            best[at[better]], number[at[better]] = found[better], who[better]

        first = np.where(np.isinf(reach)[None], np.inf, far).argmin(axis=1)
        for g in np.unique(first).tolist():
            look(np.flatnonzero(first == g), g)
        for g in np.flatnonzero(~np.isinf(reach)).tolist():
            at = np.flatnonzero((least[:, g] <= best + own + 1e-9 * (1 + own)) & (first != g))
            if len(at):
                look(at, g)
        out[s:s + step] = number
    return out


COARSE_SPACES = ("l2", "cosinesimil", "innerproduct", "hamming")


def coarse_metric(space: str) -> str:
    """How vectors of this space are dealt to the lists of an inverted file. The other spaces have no mean that represents a list."""
    if space not in COARSE_SPACES:
        raise SpecError(f"an inverted file needs one of the spaces {COARSE_SPACES}, not {space!r}")
    return METRIC_OF_SPACE[space]


def centroid_rows(column, metric: str) -> np.ndarray:
    """A vector column in the form that centroids of this metric are compared with: packed bytes for Hamming, else numbers."""
    return as_bytes(column) if metric == "hamming" else as_matrix(column)


def nearest_centroids(rows: np.ndarray, centroids: np.ndarray, n: int, metric: str = "l2") -> np.ndarray:
    """Numbers of the ``n`` nearest centroids of each row, nearest first; the lower number wins a tie."""
    if metric not in ("l2", "cos", "ip", "hamming"):
        raise SpecError(f"centroids cannot be ranked by {metric!r}")
    out = np.empty((len(rows), min(n, len(centroids))), np.int64)
    step = max(1, 4_000_000 // len(centroids))
    if metric == "hamming":
        if len(rows) and rows.shape[1] != centroids.shape[1]:
            raise SpecError(f"codes of {rows.shape[1]} bytes do not match centroids of {centroids.shape[1]}")
        rows, centroids = to_words(rows), to_words(centroids)
    else:
        rows, centroids = rows.astype(np.float64), centroids.astype(np.float64)
    if metric == "cos":
        centroids = _unit(centroids)
    for s in range(0, len(rows), step):
        if metric == "hamming":
            score = np.zeros((len(rows[s:s + step]), len(centroids)), np.int32)
            for w in range(rows.shape[1]):
                score += np.bitwise_count(rows[s:s + step, w, None] ^ centroids[None, :, w])
        else:
            score = -(rows[s:s + step] @ centroids.T)
        if metric == "l2":
            score = 2 * score + (centroids * centroids).sum(axis=1)[None, :]
        if n == 1:
            out[s:s + step, 0] = score.argmin(axis=1)
        else:
            out[s:s + step] = np.argsort(score, axis=1, kind="stable")[:, :n]
    return out


def random_rotation(dim: int, seed: int = ROTATION_SEED) -> np.ndarray:
    """Random orthonormal matrix: Gaussian rows made orthogonal one after another."""
    gauss = np.random.default_rng(seed).standard_normal((dim, dim))
    q, r = np.linalg.qr(gauss.T)
    return (q * np.sign(np.diag(r))).T


ROUNDS = 3


def structured_rotation(dim: int, seed: int = ROTATION_SEED) -> np.ndarray:
    """A random orthogonal transform that needs no matrix, written as (dim, seed); see ``rotated``."""
    return np.array([dim, seed], np.int64)


def _walsh(rows: np.ndarray) -> None:
    """Fast Walsh-Hadamard transform of the rows in place, scaled to keep lengths; the width is a power of two."""
    n, width = rows.shape
    half = 1
    while half < width:
        pairs = rows.reshape(n, width // (2 * half), 2, half)
        low = pairs[:, :, 0].copy()
        pairs[:, :, 0] += pairs[:, :, 1]
        np.subtract(low, pairs[:, :, 1], out=pairs[:, :, 1])
        half *= 2
    rows /= np.sqrt(width)


def rotated(rows: np.ndarray, rotation: np.ndarray | None) -> np.ndarray:
    """Rows times an orthogonal matrix, or through the structured transform: in each round random signs, a Walsh-Hadamard transform of the
    first and of the last so many dimensions as are a power of two, and a random order. Every step keeps lengths and angles."""
    if rotation is None:
        return rows
    if rotation.ndim == 2:
        return rows.astype(np.float64) @ rotation.T
    dim, seed = (int(x) for x in rotation)
    if len(rows) and rows.shape[1] != dim:
        raise SpecError(f"vectors of {rows.shape[1]} dimensions do not match a rotation of {dim}")
    out = rows.astype(np.float64)
    width = 1 << (dim.bit_length() - 1)
    draw = np.random.default_rng(seed)
    for _ in range(ROUNDS if len(rows) else 0):
        out = out * draw.choice((-1.0, 1.0), dim)
        for part in (slice(0, width), slice(dim - width, dim))[:1 if width == dim else 2]:
            block = np.ascontiguousarray(out[:, part])
            _walsh(block)
            out[:, part] = block
        out = out[:, draw.permutation(dim)]
    return out


def rotate(vec, matrix: np.ndarray) -> Column:
    """A vector column under a dense or structured rotation."""
    @F.arrow_udf("array<double>")
    def run(values: pa.Array) -> pa.Array:
        return where_valid(values, pa.list_(pa.float64()), lambda v: list_array(rotated(as_matrix(v), matrix)))

    return run(F.col(vec) if isinstance(vec, str) else vec)


def to_fp16(vec, clip: bool = False) -> Column:
    """Half-precision values of a vector column; out-of-range values are an error unless clipped."""
    code = Fp16(clip)

    @F.arrow_udf("array<float>")
    def run(values: pa.Array) -> pa.Array:
        return where_valid(values, pa.list_(pa.float32()), lambda v: list_array(
            code.decode_rows(code.encode_rows(as_matrix(v).astype(np.float64)), "l2").astype(np.float32)))

    return run(F.col(vec) if isinstance(vec, str) else vec)


def clip_fp16(vec) -> Column:
    vec = F.col(vec) if isinstance(vec, str) else vec
    return F.transform(vec, lambda x: F.greatest(F.lit(-FP16_MAX), F.least(F.lit(FP16_MAX), x.cast("double"))))


def to_byte(vec) -> Column:
    """Whole-numbered vector as ``array<tinyint>``; anything else is an error."""
    vec = F.col(vec) if isinstance(vec, str) else vec
    wrong = F.raise_error(F.lit("byte vectors must hold whole numbers in -128..127")).cast("tinyint")
    return F.transform(vec, lambda x: F.when((x == F.rint(x.cast("double"))) & x.between(-128, 127),
                                             x.cast("tinyint")).otherwise(wrong))


# --- storage of trained arrays -------------------------------------------------------------------------------

def pack(encoder: Encoder | None, **arrays) -> bytes:
    """Encoder and further arrays as bytes for a model row."""
    plain, stored = {}, {k: v for k, v in arrays.items() if v is not None}
    if encoder is not None:
        for key, value in vars(encoder).items():
            if isinstance(value, np.ndarray):
                stored[f"encoder.{key}"] = value
            else:
                plain[key] = value
    out = io.BytesIO()
    np.savez(out, _plain=np.frombuffer(json.dumps([encoder.name if encoder else None, plain]).encode(), np.uint8), **stored)
    return out.getvalue()


_KINDS = {k.name: k for k in (BitQuantizer, Fp16, ByteCode, Sq7, Sq1, ProductQuantizer)}


def unpack(blob: bytes):
    """``(encoder, arrays)`` from ``pack``'s bytes; holds arrays only, so nothing stored is executed."""
    with np.load(io.BytesIO(blob), allow_pickle=False) as data:
        name, plain = json.loads(data["_plain"].tobytes())
        arrays = {k: data[k] for k in data.files if k != "_plain"}
    mine = {k.split(".", 1)[1]: v for k, v in arrays.items() if k.startswith("encoder.")}
    encoder = _KINDS[name](**plain, **mine) if name else None
    return encoder, {k: v for k, v in arrays.items() if not k.startswith("encoder.")}

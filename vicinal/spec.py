"""Vector column declarations, metric names, and the options resolved before a job starts."""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

# Names and limits a caller's settings must agree with.
SPACES = ("l2", "l1", "linf", "cosinesimil", "innerproduct", "hamming")
DATA_TYPES = ("float", "byte", "binary")
MODES = ("in_memory", "on_disk")
COMPRESSIONS = ("1x", "2x", "4x", "8x", "16x", "32x", "64x")
METHODS = ("exact", "flat", "ivf")
ENCODERS = ("flat", "fp16", "byte", "sq7", "sq1", "binary", "pq")
MAX_DIMENSION = 16_000
MAX_K = 10_000
RESULT_WINDOW = 10_000
MIN_FIRST_PASS = 100
MAX_FIRST_PASS = 10_000
IVF_LIMIT = 20_000
FP16_MAX = 65504.0
ROTATION_SEED = 1212121212
MAX_DESCRIPTION = 1000

# Compression -> encoder and its bits.
ENCODER_OF_COMPRESSION = {
    "1x": ("flat", None),
    "2x": ("fp16", 16),
    "4x": ("sq7", 7),
    "8x": ("binary", 4),
    "16x": ("binary", 2),
    "32x": ("binary", 1),
}
COMPRESSION_OF_BITS = {1: "32x", 2: "16x", 4: "8x"}

# Compression -> default oversampling of the on_disk mode.
OVERSAMPLE_OF_COMPRESSION = {"4x": 1.0, "8x": 2.0, "16x": 3.0, "32x": 3.0, "64x": 5.0}

# Text shown for the raw -> score step.
SCORE_FORMULA = {
    "l2": "1 / (1 + rawScore)",
    "l1": "1 / (1 + rawScore)",
    "linf": "1 / (1 + rawScore)",
    "hamming": "1 / (1 + rawScore)",
    "cosinesimil": "Math.max((2.0F - rawScore) / 2.0F, 0.0F)",
    "innerproduct": "rawScore >= 0 ? 1 / (1 + rawScore) : -rawScore + 1",
}


class SpecError(ValueError):
    """A setting is out of range, unknown, or contradicts another one."""


@dataclass(frozen=True)
class VectorSpec:
    """What a vector column holds and how it should be searched.

    Spark arrays carry no fixed length, so the declaration travels beside the DataFrame.
    """

    dimension: int
    data_type: str = "float"
    space: str | None = None
    mode: str | None = None
    compression: str | None = None
    method: str = "exact"
    encoder: str | None = None
    params: dict = field(default_factory=dict)

    @property
    def resolved_space(self) -> str:
        return self.space or ("hamming" if self.data_type == "binary" else "l2")


def check_space(space: str, data_type: str = "float") -> str:
    if space not in SPACES:
        raise SpecError(f"unknown space {space!r}; valid values are {SPACES}")
    if (space == "hamming") != (data_type == "binary"):
        raise SpecError(f"space {space!r} is not supported with {data_type!r} data")
    return space


MAX_CODE_SIZE = 16      # bits of a product code: a codebook has fewer centroids than there are rows to train on

# name -> (kind, test) for every parameter that a method or an encoder accepts.
_PARAMETERS = {
    "ivf": {
        "nlist": (int, lambda v: 0 < v < IVF_LIMIT),
        "nprobes": (int, lambda v: 0 < v < IVF_LIMIT),
    },
    "exact": {"ef_search": (int, lambda v: v > 0)},
    "flat": {},
    "encoder:pq": {"m": (int, lambda v: v > 0), "code_size": (int, lambda v: 0 < v <= MAX_CODE_SIZE)},
    "encoder:binary": {
        "bits": (int, lambda v: v in COMPRESSION_OF_BITS),
        "random_rotation": (bool, lambda v: True),
        "enable_adc": (bool, lambda v: True),
    },
    "encoder:sq7": {"confidence_interval": (float, lambda v: v == 0 or 0.9 <= v <= 1.0)},
    "encoder:fp16": {"clip": (bool, lambda v: True)},
    "encoder:sq1": {},
    "encoder:byte": {},
    "encoder:flat": {},
}


def validate_spec(spec: VectorSpec) -> VectorSpec:
    """Range, conflict and unknown-name checks; returns the spec so calls can be chained."""
    if not isinstance(spec.dimension, int) or spec.dimension <= 0:
        raise SpecError("dimension must be a positive integer")
    if spec.dimension > MAX_DIMENSION:
        raise SpecError(f"dimension must not exceed {MAX_DIMENSION}")
    if spec.data_type not in DATA_TYPES:
        raise SpecError(f"unknown data type {spec.data_type!r}; valid values are {DATA_TYPES}")
    if spec.data_type == "binary" and spec.dimension % 8:
        raise SpecError("the dimension of a binary vector must be a multiple of 8")
    check_space(spec.resolved_space, spec.data_type)
    if spec.mode is not None and spec.mode not in MODES:
        raise SpecError(f"unknown mode {spec.mode!r}; valid values are {MODES}")
    if spec.compression is not None and spec.compression not in COMPRESSIONS:
        raise SpecError(f"unknown compression {spec.compression!r}; valid values are {COMPRESSIONS}")
    if spec.data_type != "float" and (spec.compression not in (None, "1x") or spec.mode == "on_disk"):
        raise SpecError("mode and compression apply to float vectors only")
    if spec.method not in METHODS:
        raise SpecError(f"unknown method {spec.method!r}; valid values are {METHODS}")
    if spec.encoder is not None and spec.encoder not in ENCODERS:
        raise SpecError(f"unknown encoder {spec.encoder!r}; valid values are {ENCODERS}")
    if spec.method == "ivf" and spec.resolved_space in ("l1", "linf"):
        raise SpecError(f"an inverted file does not support space {spec.resolved_space!r}")
    if spec.method == "flat" and spec.params:
        raise SpecError("the flat method takes no parameters")
    allowed = dict(_PARAMETERS[spec.method])
    if spec.encoder:
        allowed.update(_PARAMETERS[f"encoder:{spec.encoder}"])
    for name, value in spec.params.items():
        if name not in allowed:
            raise SpecError(f"unknown parameter {name!r} for {spec.method}/{spec.encoder}")
        kind, test = allowed[name]
        if kind is float and isinstance(value, int) and not isinstance(value, bool):
            value = float(value)
        if not isinstance(value, kind) or (kind is int and isinstance(value, bool)) or not test(value):
            raise SpecError(f"value {value!r} is not valid for parameter {name!r}")
    if spec.encoder == "pq" and spec.dimension % spec.params.get("m", 1):
        raise SpecError("the dimension must be divisible by the number of sub-vectors m")
    if spec.params.get("enable_adc") and spec.params.get("bits", 1) != 1:
        raise SpecError("asymmetric distance needs 1-bit codes")
    if spec.encoder == "binary" and spec.compression not in (None, COMPRESSION_OF_BITS[spec.params.get("bits", 1)]):
        raise SpecError("bits and compression contradict each other")
    return spec


def resolve_spec(dimension: int, *, mode=None, compression=None, data_type="float", space=None,
                 method_space=None, method="exact", encoder=None, params=None) -> VectorSpec:
    """Fill in what mode and compression imply: the encoder, its bits, and the space."""
    if space and method_space and space != method_space:
        raise SpecError("the method's space and the column's space contradict each other")
    params = dict(params or {})
    spec = VectorSpec(dimension, data_type, space or method_space, mode, compression, method, encoder, params)
    validate_spec(spec)
    if method == "flat":
        if compression not in (None, "32x"):
            raise SpecError("the flat method always compresses 32x")
        return replace(spec, compression="32x", encoder="sq1", space=spec.resolved_space)
    if encoder is None and data_type == "float":
        compression = compression or ("32x" if mode == "on_disk" else "1x")
        if compression not in ENCODER_OF_COMPRESSION:
            raise SpecError(f"no encoder gives a compression of {compression}")
        encoder, bits = ENCODER_OF_COMPRESSION[compression]
        if encoder == "binary":
            params.setdefault("bits", bits)
    elif encoder == "binary":
        params.setdefault("bits", 1)
        compression = COMPRESSION_OF_BITS[params["bits"]]
    resolved = replace(spec, compression=compression, encoder=encoder, params=params, space=spec.resolved_space)
    return validate_spec(resolved)


@dataclass(frozen=True)
class Rescore:
    """Second-pass setting: how far the first pass oversamples."""

    oversample: float
    user_provided: bool
    adjustable: bool = True


def resolve_rescore(spec: VectorSpec, user=None, engine: str = "faiss") -> Rescore | None:
    """The user's choice if there is one, else the default for mode, compression and dimension."""
    if user is not None:
        if user is False:
            return None
        factor = 1.0 if user is True else float(user)
        if not 1.0 <= factor <= 100.0:
            raise SpecError("the oversampling factor must lie in 1..100")
        return Rescore(factor, user_provided=True)
    if spec.method == "flat" and spec.compression == "32x":
        return Rescore(2.0, user_provided=False)
    if spec.encoder == "sq1":
        return Rescore(2.0, user_provided=False, adjustable=False)
    if spec.mode != "on_disk" or spec.compression not in OVERSAMPLE_OF_COMPRESSION:
        return None
    if spec.compression == "32x" and engine == "lucene":
        return Rescore(2.0, user_provided=False)
    if spec.compression != "4x" and spec.dimension <= 1000:
        return Rescore(5.0, user_provided=False)
    return Rescore(OVERSAMPLE_OF_COMPRESSION[spec.compression], user_provided=False)


def first_pass_k(k: int, oversample: float, *, by_dimension: int | None = None, most: int | None = None) -> int:
    """Candidates the first pass must return. ``by_dimension`` replaces the factor where the
    second pass runs once over the merged result and the user gave no factor. ``most`` (``MAX_FIRST_PASS`` is customary) limits them;
    by default nothing does."""
    if by_dimension is not None:
        oversample = 1.0 if by_dimension >= 1000 else 2.0 if by_dimension >= 768 else 3.0
    asked = max(MIN_FIRST_PASS, math.ceil(k * oversample))
    return asked if most is None else min(most, asked)


def estimate_overhead_kb(spec: VectorSpec) -> int:
    """Size of the trained tables (coarse centroids, codebooks) in KB."""
    total = 0
    if spec.method == "ivf":
        total += 4 * spec.params.get("nlist", 4) * spec.dimension // 1024 + 1
    if spec.encoder == "pq":
        total += 4 * (1 << spec.params.get("code_size", 8)) * spec.dimension // 1024 + 1
    return total


def check_k(k: int) -> int:
    if not isinstance(k, int) or isinstance(k, bool) or not 0 < k <= MAX_K:
        raise SpecError(f"k must lie in 1..{MAX_K}")
    return k


def check_radius(space: str, max_distance=None, min_score=None, *, encoder=None, method=None,
                 compression=None) -> None:
    """Rules for a radius search; exactly one of the two limits must be given."""
    if (max_distance is None) == (min_score is None):
        raise SpecError("give exactly one of max_distance and min_score")
    if space == "hamming":
        raise SpecError("radius search is not supported on binary vectors")
    if encoder == "binary":
        raise SpecError("radius search is not supported on bit-quantized columns")
    if compression not in (None, "1x", "2x") and method != "flat" and encoder != "sq1":
        raise SpecError("among quantized columns, radius search needs flat or 1-bit scalar codes")
    if isinstance(max_distance, (int, float)) and max_distance < 0 and space != "innerproduct":
        raise SpecError("max_distance must not be negative")
    if isinstance(min_score, (int, float)):
        if min_score <= 0:
            raise SpecError("min_score must be greater than 0")
        if min_score > 1 and space != "innerproduct":
            raise SpecError("min_score must not exceed 1")

"""Raw distance <-> score, as Column expressions for plans and as numpy for task code."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from vicinal.spec import SPACES, SpecError


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_score(raw, space: str) -> Column:
    """Score of a raw distance; larger is closer."""
    raw = _col(raw).cast("double")
    if space == "cosinesimil":
        return F.greatest((2.0 - raw) / 2.0, F.lit(0.0))
    if space == "innerproduct":
        return F.when(raw >= 0, 1.0 / (1.0 + F.greatest(raw, F.lit(0.0)))).otherwise(1.0 - raw)
    if space not in SPACES:
        raise SpecError(f"unknown space {space!r}")
    return 1.0 / (1.0 + raw)


def score_array(raw: np.ndarray, space: str) -> np.ndarray:
    if space == "cosinesimil":
        return np.maximum((2.0 - raw) / 2.0, 0.0)
    if space == "innerproduct":
        return np.where(raw >= 0, 1.0 / (1.0 + np.maximum(raw, 0.0)), 1.0 - raw)
    return 1.0 / (1.0 + raw)


def score_to_threshold(score, space: str):
    """Largest raw distance whose score still reaches ``score``. Numbers fold now; columns stay lazy."""
    if isinstance(score, (int, float)):
        if score == 0 and space == "l2":
            raise SpecError("score 0 has no distance in space l2")
        if space == "cosinesimil":
            return 2.0 - 2.0 * score
        if space == "innerproduct":
            return 1.0 - score if score > 1 else 1.0 / score - 1.0
        return 1.0 / score - 1.0
    s = _col(score).cast("double")
    if space == "cosinesimil":
        return 2.0 - 2.0 * s
    if space == "innerproduct":
        return F.when(s > 1, 1.0 - s).otherwise(1.0 / s - 1.0)
    return 1.0 / s - 1.0


def distance_to_threshold(distance, space: str):
    """A caller's ``max_distance`` as a bound on the raw distance.

    For inner product the bound is ``ip >= -max_distance``; as raw is ``-ip``, the number carries over.
    """
    if space not in SPACES:
        raise SpecError(f"unknown space {space!r}")
    return float(distance) if isinstance(distance, (int, float)) else _col(distance).cast("double")


def similarity_threshold(score: float, space: str) -> float:
    """The same bound stated on the similarity (cosine or inner product) instead of the raw distance."""
    raw = score_to_threshold(score, space)
    if space == "cosinesimil":
        return 1.0 - raw
    if space == "innerproduct":
        return -raw
    raise SpecError(f"space {space!r} has no similarity form")


def ip_score_to_cosine_score(score) -> Column:
    """Score computed by inner product on unit vectors -> the cosine score of the same pair."""
    s = _col(score).cast("double")
    ip = F.when(s >= 1, s - 1.0).otherwise(1.0 - 1.0 / s)
    return F.greatest((1.0 + ip) / 2.0, F.lit(0.0))

"""Turning a model's probability into what is stored: a rounded score, a band, a hard label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from subscope.settings import BAND_EDGES

OUT_OF_RANGE = "nan"
LOWEST, HIGHEST = -0.01, 1.01


def round_score(score: Column, dp: int = 4) -> Column:
    """Halves go to the even digit, unlike ``F.round``."""
    scale = float(10**dp)
    return F.rint(score * scale) / scale


def band(score: Column, labels: Sequence[str], edges: tuple[float, float] = BAND_EDGES) -> Column:
    """Right-closed bands on the unrounded score; null, NaN and scores off the scale get ``nan``."""
    low, middle, high = labels
    in_range = score.isNotNull() & ~F.isnan(score) & (score > LOWEST) & (score <= HIGHEST)
    return (
        F.when(~in_range, OUT_OF_RANGE)
        .when(score <= edges[0], low)
        .when(score <= edges[1], middle)
        .otherwise(high)
    )


def hard_label(score: Column, threshold: float = 0.5) -> Column:
    return (score >= threshold).cast("int")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)

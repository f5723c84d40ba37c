"""Fingerprints of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(columns: Sequence[str]) -> Column:
    """A BIGINT over the named columns. ``xxhash64`` skips nulls, so each column's null flag goes in
    too: otherwise a value moving to its null neighbour would pass for no change."""
    parts: list[Column] = []
    for name in columns:
        parts += [F.col(name).isNull(), F.col(name)]
    return F.xxhash64(*parts)

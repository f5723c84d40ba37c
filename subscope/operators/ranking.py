"""Top rows and result envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ENVELOPE_ROWS = 50


def top_k(df: DataFrame, order_col: str, k: int, key: str | Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``order_col``, equal ones in key order."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(F.desc(order_col), *[F.asc(c) for c in keys]).limit(k)


def result_envelope(
    df: DataFrame, order_by: Sequence[str | Column] = (), limit: int = ENVELOPE_ROWS
) -> DataFrame:
    """One row of JSON, ``{"colunas": [..], "linhas": [[..]]}``: the first ``limit`` rows, every value
    as text, in ``order_by`` order (all columns, left to right, by default)."""
    order = list(order_by) or df.columns
    values = F.array(*[F.col(c).cast("string") for c in df.columns])
    # Collecting promises no order, so each of the few rows left takes its place along.
    place = F.row_number().over(Window.orderBy(*order))
    row = F.struct(place.alias("place"), values.alias("values"))
    first = df.orderBy(*order).limit(limit).select(row.alias("row"))
    gathered = first.agg(F.sort_array(F.collect_list("row")).alias("rows"))
    body = F.struct(
        F.array(*[F.lit(c) for c in df.columns]).alias("colunas"),
        F.transform("rows", lambda r: r["values"]).alias("linhas"),
    )
    return gathered.select(F.to_json(body).alias("envelope"))

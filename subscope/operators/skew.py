"""Joins in which a few keys hold a large part of the rows, split whatever adaptive execution decides."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions.bitmaps import unused

SHARE = 1 / 1000  # of the rows, from which a key is heavy
TRACKED = 16_384  # keys a sketch keeps; the error of a count is under a tenth of the share


def heavy_keys(df: DataFrame, key: str, share: float = SHARE, tracked: int = TRACKED) -> dict:
    """The keys with about ``share`` of the rows or more, and their shares: ``1 / share`` keys at most.

    A sketch of frequent items is made in each task and merged, so one row is collected, of bounded size. Null keys, which match
    nothing, are not among them.
    """
    most = math.ceil(1 / share)
    held = df.select(F.col(key).alias("key")).where("key is not null")
    top, n = held.agg(F.expr(f"approx_top_k(key, {most}, {tracked})"), F.count("*")).first()
    return {r["item"]: r["count"] / n for r in top or [] if r["item"] is not None and r["count"] >= share * n}


def spread_join(
    left: DataFrame, right: DataFrame, key: str, by: str, heavy: dict, how: str = "left", parts: int | None = None
) -> DataFrame:
    """``left`` joined to ``right`` on ``key``, the rows of ``heavy`` keys in shares dealt by ``by``.

    A heavy key's rows of the left go to twice as many shares as it has of ``parts`` (the shuffle partitions), and its rows of the right are
    there in each of them. The result is that of the plain join, for joins that keep no unmatched row of the right.
    """
    if not heavy:
        return left.join(right, key, how)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("unmatched rows of the right would be there once for each share")
    if parts is None:
        parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = {k: max(2, math.ceil(2 * share * parts)) for k, share in heavy.items()}
    salt = max(*unused(left, "salt"), *unused(right, "salt"), key=len)

    def of(column: Column) -> Column:
        known = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
        return F.coalesce(F.try_element_at(known, column), F.lit(1))

    dealt = left.withColumn(salt, F.pmod(F.xxhash64(by), of(F.col(key))).cast("int"))
    copied = right.withColumn(salt, F.explode(F.sequence(F.lit(0), of(F.col(key)) - 1)))
    return dealt.join(copied, [key, salt], how).drop(salt)

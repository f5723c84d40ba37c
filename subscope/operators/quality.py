"""Checks of keys and references; each gives the violations, none when all is well."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions.bitmaps import key_bits, mark_by, maybe_in
from subscope.settings import cut


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column_name, n_rows``: how many rows have a null in each column that has any."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_rows")) for c in cols])
    return counts.select(F.inline(pairs)).where(F.col("n_rows") > 0)


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The keys held by more than one row, with ``n_rows``. Counts combine before the shuffle, so a
    key shared by many rows is no burden."""
    return df.groupBy(*cols).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def check_foreign_key(child: DataFrame, parent: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """The child keys no parent has, with ``n_rows``. Null keys refer to nothing and are not orphans.

    The child is reduced to its keys before it meets the parent: the join moves one row per key.
    """
    keys = [on] if isinstance(on, str) else list(on)
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    held = child.where(present).groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return held.join(parent.select(*keys), keys, "left_anti")


# --- of a feed alone ---
#
# A table version that has been checked keeps a bitmap of its keys and its violations. Rows that are added are
# checked against the bitmap, and only those it lets through against the table itself.


@dataclass(frozen=True)
class CheckedKeys:
    """bits: a bitmap of a table's keys (``functions.bitmaps``). violations: what a check of it returned."""

    bits: DataFrame
    violations: DataFrame


def _one(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def checked_unique(df: DataFrame, key: Sequence[str]) -> CheckedKeys:
    """The state of ``check_unique``, to be stored beside the table."""
    return CheckedKeys(key_bits(df.select(_one(key).alias("key")), "key"), check_unique(df, key))


def check_unique_feed(table: DataFrame, state: CheckedKeys, feed: DataFrame, key: Sequence[str]) -> DataFrame:
    """``check_unique`` of ``table`` and ``feed`` together, ``state`` being that of the table.

    Of the table only the key columns of rows that share a bit with a row of the feed are compared.
    """
    key = list(key)
    arriving = feed.groupBy(*key).agg(F.count("*").alias("n_feed")).withColumn("_key", _one(key))
    known = mark_by(arriving, state.bits, "_key", "_maybe").where("_maybe").select("_key")
    held = maybe_in(table.select(_one(key).alias("_key")), known, "_key").join(known, "_key").groupBy("_key").agg(F.count("*").alias("n_held"))
    total = F.col("n_feed") + F.coalesce("n_held", F.lit(0))
    fresh = arriving.join(held, "_key", "left").select(*key, "_key", total.alias("n_rows")).where("n_rows > 1")
    old = state.violations.withColumn("_key", _one(key)).join(arriving.select("_key"), "_key", "left_anti")
    return old.select(*key, "n_rows").unionByName(fresh.select(*key, "n_rows"))


def checked_reference(child: DataFrame, parent: DataFrame, key: str) -> CheckedKeys:
    """The state of ``check_foreign_key``: the parents' bitmap and the orphans."""
    return CheckedKeys(key_bits(parent, key), check_foreign_key(child, parent, key))


def check_foreign_key_feed(
    state: CheckedKeys, parent: DataFrame, feed: DataFrame, key: str, new_parents: DataFrame | None = None
) -> DataFrame:
    """``check_foreign_key`` of the children so far and ``feed``; ``state`` is of the children so far and of ``parent``.

    ``new_parents`` are rows added to ``parent``, which takes earlier orphans off. Children without a key are no orphans.
    """
    arriving = feed.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
    told = cut(mark_by(arriving, state.bits, key, "_maybe"))
    maybe = told.where("_maybe").drop("_maybe")
    found = maybe_in(parent.select(key), maybe, key).join(maybe.select(key), key, "left_semi").distinct()
    orphans = told.where("not _maybe").drop("_maybe").unionByName(maybe.join(found, key, "left_anti"))
    every = state.violations.unionByName(orphans).groupBy(key).agg(F.sum("n_rows").alias("n_rows"))
    return every if new_parents is None else every.join(new_parents.select(key).distinct(), key, "left_anti")

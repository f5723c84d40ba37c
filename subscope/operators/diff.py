"""What changed between two states of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions.bitmaps import maybe_in
from subscope.functions.hashing import row_hash
from subscope.settings import cut

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def _single(value: Column, pk: str) -> Column:
    """The group's only value; a second row with the same key, or a null key, fails the job."""
    twice = F.concat(F.lit(f"duplicate key in {pk}: "), F.col(pk).cast("string"))
    missing = F.raise_error(F.lit(f"null key in {pk}"))
    return F.when(F.col(pk).isNull(), missing).when(F.count("*") > 1, F.raise_error(twice)).otherwise(F.max(value))


def change_kind(old: Column, new: Column) -> Column:
    """How a key changed, from its row hash before and after; null where it did not."""
    return (
        F.when(old.isNull(), INSERT)
        .when(new.isNull(), DELETE)
        .when(old != new, UPDATE)
    )


def snapshot_diff(old: DataFrame, new: DataFrame, pk: str) -> DataFrame:
    """``pk, change`` and the payload columns as they are in ``new`` (null for a delete).

    Keys and row hashes of both sides decide; grouping by the key proves it unique and leaves both sides
    partitioned the way the join needs them. Payload travels for changed keys alone: a bitmap of those
    holds the other rows back.
    """
    payload = [c for c in new.columns if c != pk]
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError(f"snapshots differ in columns: {old.columns} and {new.columns}")
    sides = [
        side.select(pk, row_hash(payload).alias("_hash")).groupBy(pk).agg(_single(F.col("_hash"), pk).alias(name))
        for side, name in ((old, "_old"), (new, "_new"))
    ]
    changes = cut(
        sides[0].join(sides[1], pk, "full_outer")
        .select(pk, change_kind(F.col("_old"), F.col("_new")).alias("change"))
        .where(F.col("change").isNotNull())
    )
    return changes.join(maybe_in(new, changes, pk), pk, "left").select(pk, "change", *payload)


def apply_diff(old: DataFrame, diff: DataFrame, pk: str) -> DataFrame:
    """``old`` after the changes: ``apply_diff(a, snapshot_diff(a, b))`` is ``b``."""
    kept = old.join(diff.select(pk), pk, "left_anti")
    arriving = diff.where(F.col("change") != DELETE).drop("change")
    return kept.select(*old.columns).unionByName(arriving.select(*old.columns))


def count_changes(diff: DataFrame) -> DataFrame:
    return diff.groupBy("change").agg(F.count("*").alias("n_rows"))

"""Exact duplicates by content hash, with the bytes compared before a group is believed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.functions.bitmaps import maybe_in
from subscope.settings import cut


def exact_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", keep: str = "smallest"
) -> DataFrame:
    """One row per row of ``docs``: ``key, keep_id, group_size, kept, text_sha256``.

    Rows are grouped by a 128-bit hash of the text, and the one with the smallest key stays (or the
    ``largest``). Only keys and hashes of all rows are shuffled; a group with a third of all rows is
    reduced to a row per task first. Texts travel for rows in groups of several alone: each task reduces
    a group to its least and its greatest text, and where those differ the hash has collided and the
    group is taken apart by the texts themselves.

    Null counts as an empty text, and texts are compared byte for byte, however long. Of rows with equal
    text and equal key each counts in the group's size and each is kept if the key stays; a null key
    stays only if its group has no other. An empty table gives no rows. Other columns are not read.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    whole = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    hashed = whole.withColumn("hash", F.unhex(F.md5("text")))
    rows = cut(hashed.select("key", "hash", F.unhex(F.sha2("text", 256)).alias("sha")))
    groups = rows.groupBy("hash").agg(best("key").alias("keep_id"), F.count("*").alias("group_size"))

    several = groups.where("group_size > 1").select("hash")
    copies = maybe_in(hashed, several, "hash")
    differ = copies.groupBy("hash").agg(F.min("text").alias("least"), F.max("text").alias("most"))
    collided = cut(differ.where("least <> most").select("hash"))
    if collided.isEmpty():
        found = rows.join(groups, "hash")
    else:
        clean = groups.join(collided, "hash", "left_anti")
        # a text never meets another group's here: its bytes are the key
        apart = maybe_in(hashed, collided, "hash").join(collided, "hash", "left_semi")
        split = apart.groupBy("hash", "text").agg(best("key").alias("keep_id"), F.count("*").alias("group_size"))
        resolved = apart.join(split, ["hash", "text"]).select(
            "key", "hash", F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "group_size"
        )
        found = rows.join(clean, "hash").unionByName(resolved)
    return found.select(
        F.col("key").alias(key), "keep_id", "group_size",
        F.col("key").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )

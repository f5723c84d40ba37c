"""A filter of fixed size that lets a large table's rows through by the keys of another."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 32768  # bits of one block of a bitmap, as Spark's bitmap functions have it
BLOCKS = 1024  # blocks of a filter: 4 MB in all, whatever the number of keys


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BLOCK * BLOCKS))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found


def key_bits(keys: DataFrame, name: str) -> DataFrame:
    """``block, bits``: a bitmap of column ``name``, at most ``BLOCKS`` rows of 4 KB whatever the number of keys."""
    place = _place(F.col(name))
    return keys.select(F.floor(place / BLOCK).alias("block"), (place % BLOCK).alias("bit")).groupBy("block").agg(
        F.bitmap_construct_agg("bit").alias("bits")
    )


def merged_bits(*bits: DataFrame) -> DataFrame:
    """The bitmap of all keys that the given ones are of."""
    held = reduce(DataFrame.unionByName, bits)
    return held.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def mark_by(df: DataFrame, bits: DataFrame, name: str, flag: str = "maybe") -> DataFrame:
    """``df`` with a boolean column: false only where column ``name`` is certainly not among the keys of ``bits``.

    The bitmap is of bounded size, which is why it can be broadcast; a full one marks more rows and misses none.
    """
    place, block, held = unused(df, "place", "block", "bits")
    placed = df.withColumn(place, _place(F.col(name))).withColumn(block, F.floor(F.col(place) / BLOCK))
    byte = F.conv(F.hex(F.substring(held, ((F.col(place) % BLOCK) / 8).cast("int") + 1, F.lit(1))), 16, 10)
    has = F.getbit(byte.cast("long"), (F.col(place) % 8).cast("int")) == 1
    told = bits.select(F.col("block").alias(block), F.col("bits").alias(held))
    return placed.join(F.broadcast(told), block, "left").withColumn(
        flag, F.coalesce(has, F.lit(False))
    ).select(*df.columns, flag)


def mark(df: DataFrame, keys: DataFrame, name: str, flag: str = "maybe") -> DataFrame:
    """``mark_by`` with the bitmap of the column of that name in ``keys``."""
    return mark_by(df, key_bits(keys, name), name, flag)


def maybe_in(df: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` whose column ``name`` may be among ``keys``: all that are, and few others."""
    [flag] = unused(df, "maybe")
    return mark(df, keys, name, flag).where(F.col(flag)).drop(flag)

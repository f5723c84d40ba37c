"""Draws that depend on a row's key and nothing else.

A row gets the same draw for any number of partitions and on every retry, which ``rand`` cannot
promise. ``murmur3`` mode uses Spark's own ``hash`` and is the fast one; ``md5`` mode gives numbers
another engine can reproduce.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Key = str | Column | Sequence[str | Column]
MODES = ("murmur3", "md5")


def _columns(key: Key) -> list[Column]:
    parts = [key] if isinstance(key, (str, Column)) else list(key)
    return [F.col(p) if isinstance(p, str) else p for p in parts]


def _check(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, use one of {MODES}")


def _portable(key: Key, salt: str) -> Column:
    text = F.concat_ws("|", *[c.cast("string") for c in _columns(key)], F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_draw(key: Key, salt: str, mode: str = "murmur3") -> Column:
    """A non-negative BIGINT. The cast comes before ``abs``, which the smallest INT would overflow."""
    _check(mode)
    if mode == "md5":
        return _portable(key, salt)
    return F.abs(F.hash(*_columns(key), F.lit(salt)).cast("bigint"))


def pick(bank: Sequence[str], salt: str, key: Key = "n", mode: str = "murmur3") -> Column:
    """One item of ``bank`` per row; an item listed twice is twice as likely."""
    index = F.pmod(hash_draw(key, salt, mode), F.lit(len(bank))) + 1
    return F.element_at(F.array(*[F.lit(item) for item in bank]), index.cast("int"))


def hash_int(key: Key, salt: str, base: int, span: int, mode: str = "murmur3") -> Column:
    """An INT in ``base .. base + span - 1``."""
    return (F.pmod(hash_draw(key, salt, mode), F.lit(span)) + base).cast("int")


def hash_uniform(key: Key, salt: str, mode: str = "murmur3") -> Column:
    """A DOUBLE in [0, 1)."""
    _check(mode)
    if mode == "md5":
        return _portable(key, salt) / F.lit(2.0**32)
    bits = F.xxhash64(*_columns(key), F.lit(salt))
    return F.shiftrightunsigned(bits, 11) / F.lit(2.0**53)


def padded_key(key_format: tuple[str, int], number: str | Column) -> Column:
    """Prefix and zero-padded number. A number wider than the format keeps all its digits."""
    prefix, width = key_format
    digits = (F.col(number) if isinstance(number, str) else number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def half_up(value: Column, places: int) -> Column:
    """A non-negative DOUBLE rounded to ``places``, halves up, the same in every engine."""
    scale = float(10**places)
    return F.floor(value * scale + 0.5) / scale

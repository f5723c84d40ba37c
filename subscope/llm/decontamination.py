"""Benchmark items inside documents, by a prefix-filtered set join of shingles.

A benchmark item is cut into windows of consecutive words, and a window into shingles. A document window
of the same size that contains enough of these shingles must contain one of the few rarest, so only
those, the window's prefix, are looked up in the documents. Where one is found, its place in the window
and the ends of the document say where a window can start, and the words there are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subscope.functions.bitmaps import BLOCK, BLOCKS
from subscope.llm.spans import Pieces, Texts, by_bytes, mixed, texts_of, words
from subscope.llm.stage import stored

WINDOW = 10  # words of an item that are looked for together
SHINGLE = 5  # words of a shingle
PERCENT = 100  # of a window's shingles that a document window must contain
BATCH_BYTES = 4 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
# The bytes between words, [\x00-\x2F\x3A-\x60\x7B-\x7F] with A-Z in lower case.
_BETWEEN = np.zeros(256, bool)
_BETWEEN[0x00:0x30] = _BETWEEN[0x3A:0x61] = _BETWEEN[0x7B:0x80] = True


def benchmark_words(column: pa.Array) -> Pieces:
    """Runs of digits, letters and anything outside ASCII, with A-Z in lower case."""
    return words(texts_of(column).lower(), _BETWEEN)


def _shingles(found: Pieces, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first words and the hashes of all runs of ``n`` words that lie in one text."""
    left = np.repeat(found.bounds[1:], found.counts) - np.arange(len(keys))
    at = np.flatnonzero(left >= n)
    h = np.full(len(at), mixed(np.array([n], np.uint64))[0])
    for step in range(n):
        h = mixed((h + _STEP) ^ keys[at + step])
    return at, h


def _joined(found: Pieces) -> Texts:
    """All words with a space after each; word j is from ``offsets[j]`` up to the space."""
    size = found.ends - found.starts
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size + 1, out=offsets[1:])
    data = np.full(offsets[-1], 0x20, np.uint8)
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    data[np.repeat(offsets[:-1], size) + step] = found.data[np.repeat(found.starts, size) + step]
    return Texts(data, offsets)


def _strings(joined: Texts, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """Words ``first`` to ``last`` (not included) of each row, with single spaces."""
    starts, ends = joined.offsets[first], joined.offsets[last] - 1
    size = ends - starts
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(joined.data[at])).cast(pa.string())


def _lists(bounds: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def _windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """``item, words, n, size, shingles``: an item's windows, with the hash and first word of each shingle.

    size: words of a shingle, fewer where the window has fewer.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, limit=BATCH_BYTES):
            found = benchmark_words(batch.column("text"))
            keys, joined = found.keys(), _joined(found)
            many = np.where(found.counts > window, found.counts - window + 1, np.minimum(found.counts, 1))
            item = np.repeat(np.arange(len(many)), many)
            first = found.bounds[item] + np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many)
            n = np.minimum(found.counts[item], window)
            size = np.minimum(n, shingle)
            table = np.zeros((shingle + 1, len(keys)), np.uint64)
            for length in np.unique(size).tolist():
                at, h = _shingles(found, keys, length)
                table[length, at] = h
            per = n - size + 1
            bounds = np.concatenate([[0], np.cumsum(per)])
            offset = np.arange(bounds[-1]) - np.repeat(bounds[:-1], per)
            hashes = table[np.repeat(size, per), np.repeat(first, per) + offset]
            inner = pa.StructArray.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(offset.astype(np.int32))], names=["shingle", "at"]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").take(pa.array(item)), _strings(joined, first, first + n), pa.array(n.astype(np.int32)),
                 pa.array(size.astype(np.int32)), _lists(bounds, inner)],
                names=["item", "words", "n", "size", "shingles"],
            )

    kind = items.schema["item"].dataType.simpleString()
    return items.mapInArrow(cut, f"item {kind}, words string, n int, size int, shingles array<struct<shingle:long, at:int>>")


def _bits(shingles: DataFrame) -> np.ndarray:
    """A bitmap of the shingles, of 4 MB whatever their number."""
    place = F.pmod(F.col("shingle"), F.lit(BLOCK * BLOCKS))
    rows = shingles.select(F.floor(place / BLOCK).alias("block"), (place % BLOCK).alias("bit")).groupBy("block").agg(
        F.bitmap_construct_agg("bit").alias("bits")
    ).collect()  # at most BLOCKS rows of 4 KB
    held = np.zeros((BLOCKS, BLOCK // 8), np.uint8)
    for row in rows:
        held[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return held.reshape(-1)


def _maybe(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes.view(np.int64) % (BLOCK * BLOCKS)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _frequencies(docs: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """``shingle, often``: how often the documents have each shingle that the bitmap lets through."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, limit=BATCH_BYTES):
            found = benchmark_words(batch.column("text"))
            keys = found.keys()
            for size in sizes:
                _, h = _shingles(found, keys, size)
                one, often = np.unique(h[_maybe(bits, h)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(often)], names=["shingle", "often"])

    return docs.select("text").mapInArrow(count, "shingle long, often long").groupBy("shingle").agg(F.sum("often").alias("often"))


def _places(docs: DataFrame, bits: np.ndarray, sizes: list[int], window: int) -> DataFrame:
    """``key, n_words, places``: each document, and where it may have a prefix shingle, with the words around it."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, limit=BATCH_BYTES):
            found = benchmark_words(batch.column("text"))
            keys, joined, owner = found.keys(), _joined(found), found.owners()
            parts = []
            for size in sizes:
                at, h = _shingles(found, keys, size)
                some = _maybe(bits, h)
                parts.append((at[some], h[some], np.full(int(some.sum()), size)))
            at, h, size = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
            order = np.argsort(at, kind="stable")
            at, h, size = at[order], h[order].astype(np.uint64), size[order]
            doc = owner[at]
            first = np.maximum(found.bounds[doc], at - (window - size))
            last = np.minimum(found.bounds[doc + 1], at + window)
            places = pa.StructArray.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(at - found.bounds[doc]), pa.array((at - first).astype(np.int32)),
                 _strings(joined, first, last)],
                names=["shingle", "at", "before", "around"],
            )
            bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(found.counts.astype(np.int64)), _lists(bounds, places)],
                names=["key", "n_words", "places"],
            )

    kind = docs.schema["key"].dataType.simpleString()
    inner = "array<struct<shingle:long, at:long, before:int, around:string>>"
    return docs.mapInArrow(find, f"key {kind}, n_words long, places {inner}")


@dataclass(frozen=True)
class Found:
    """documents: ``row, key, n_words``, a row for each row. windows: ``row, start, n, needle``, every window
    found. items: ``needle, item``, the items that have each."""

    documents: DataFrame
    windows: DataFrame
    items: DataFrame

    def hit_words(self) -> DataFrame:
        """``row, n_hit``: words inside any window, each counted once."""
        ends = self.windows.groupBy("row", "start").agg(F.max(F.col("start") + F.col("n")).alias("end"))
        before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        seen = F.coalesce(F.max("end").over(before), F.lit(0))
        fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", seen))
        return ends.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))

    def row_items(self) -> DataFrame:
        """``row, item``: which items each row has a window of."""
        return self.windows.select("row", "needle").distinct().join(self.items, "needle").select("row", "item").distinct()


def find(
    docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, percent: int = PERCENT,
) -> Found:
    """The windows of ``items`` in ``docs``.

    A window is ``window`` consecutive words of an item, or all of them if there are fewer; its shingles are
    its runs of ``shingle`` words. A document has it where as many words in a row contain ``percent`` percent
    of its shingles; at 100 percent the words must be the same one by one.

    Null and blank texts have no words. Rows with a null or repeated key are separate rows; items with a null
    key are found, as the item null; equal windows of several items are looked for once. Empty tables give no
    windows. Only the columns named are read.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    cut = stored(_windows(items.select(F.col(item_key).alias("item"), F.col(item_text).alias("text")), window, shingle))
    needles = stored(cut.groupBy("words").agg(
        F.first("n").alias("n"), F.first("size").alias("size"), F.first("shingles").alias("shingles"),
    ).withColumn("needle", F.monotonically_increasing_id()))
    held = stored(cut.select("item", "words").distinct().join(needles.select("words", "needle"), "words").select("needle", "item"))

    each = needles.select("needle", "size", F.explode("shingles").alias("s")).select("needle", "size", "s.*")
    each = stored(each.groupBy("needle", "size", "shingle").agg(F.min("at").alias("at")))
    sizes = sorted(r["size"] for r in each.select("size").distinct().collect())  # at most ``shingle`` numbers
    often = _frequencies(rows, _bits(each), sizes)
    # of n shingles, n - m + 1 must hold one of any m: the rarest, which are in the fewest places
    ranked = each.join(often, "shingle", "left").withColumn(
        "place", F.row_number().over(Window.partitionBy("needle").orderBy(F.coalesce("often", F.lit(0)), "shingle"))
    ).withColumn("all", F.count("*").over(Window.partitionBy("needle")))
    needed = F.ceil(F.col("all") * percent / 100)
    prefix = stored(ranked.where(F.col("place") <= F.col("all") - needed + 1).select("needle", "shingle", "at", "size"))
    base = stored(_places(rows, _bits(prefix), sizes, window).withColumn("row", F.monotonically_increasing_id()))

    known = prefix.join(needles.select("needle", "words", "n"), "needle")
    places = base.where(F.size("places") > 0).select("row", F.explode("places").alias("p")).select(
        "row", "p.shingle", F.col("p.at").alias("doc_at"), "p.before", F.split("p.around", " ").alias("around")
    )
    met = places.join(known, "shingle").withColumn("starts", _starts(percent)).withColumn("start", F.explode("starts"))
    kept = met.where(_alike(percent))
    windows = kept.select("row", (F.col("doc_at") - F.col("before") + F.col("start")).alias("start"), F.col("n").cast("long").alias("n"), "needle")
    return Found(base.select("row", "key", "n_words"), stored(windows.distinct()), held)


def _starts(percent: int) -> Column:
    """Where in ``around`` the window can start: its words must fit, with the shingle at its place in it, or
    anywhere in it where shingles may be missing."""
    before, n, room = F.col("before"), F.col("n"), F.size("around") - F.col("n")
    low = before - F.col("at") if percent == 100 else F.greatest(F.lit(0), before - n + F.col("size"))
    high = F.least(low if percent == 100 else before, room)
    return F.when((low >= 0) & (low <= high), F.sequence(low, F.greatest(low, high))).otherwise(F.array().cast("array<int>"))


def _alike(percent: int) -> Column:
    here = F.slice("around", F.col("start") + 1, F.col("n"))
    if percent == 100:
        return F.concat_ws(" ", here) == F.col("words")

    def runs(parts: Column) -> Column:
        at = F.sequence(F.lit(1), F.col("n") - F.col("size") + 1)
        return F.array_distinct(F.transform(at, lambda i: F.concat_ws(" ", F.slice(parts, i, F.col("size")))))

    wanted = runs(F.split("words", " "))
    return 100 * F.size(F.array_intersect(wanted, runs(here))) >= percent * F.size(wanted)


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: its key, ``n_words, n_hit`` and ``items``, the items it has windows of, as
    sorted strings. Options and cases as in ``find``; the item null is in no list."""
    found = find(docs, items, **options)
    listed = found.row_items().groupBy("row").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    joined = found.documents.join(found.hit_words(), "row", "left").join(listed, "row", "left")
    return joined.select(
        F.col("key").alias(options.get("key", "doc_id")), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def without_hits(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose key has no row with a hit, all columns; rows with a null key go if one of them has."""
    hit = contamination(docs, items, key=key, **options).where("n_hit > 0").select(F.col(key).alias("_hit_key")).distinct()
    return docs.join(hit, F.col(key).eqNullSafe(F.col("_hit_key")), "left_anti")

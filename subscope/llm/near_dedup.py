"""Near duplicates by MinHash banding, sifted by odd sketches and confirmed on whole shingle sets.

Documents with one shingle set are one class from the start, so copies cost nothing further.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.functions.bitmaps import maybe_in
from subscope.llm.components import components
from subscope.llm.linking import Shape, links, lists
from subscope.llm.spans import by_bytes, mixed, texts_of, words
from subscope.llm.stage import stored
from subscope.settings import small_batches

WORDS = 5
PERCENT = 80  # similarity from which documents are linked
SHAPE = Shape(bands=40, rows=5, sketch=1024, parity=2048)  # misses a pair of similarity 0.8 once in seven million

BATCH_BYTES = 1 << 20  # of text signed together

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles of ``n`` words, and the bounds of each text's.

    A text with fewer words has one shingle, of all of them; one without words has none.
    """
    found = words(texts_of(column).lower())
    keys, counts, total = found.keys(), found.counts, len(found)
    many = np.maximum(counts - n + 1, np.minimum(counts, 1))
    bounds = np.zeros(len(many) + 1, np.int64)
    np.cumsum(many, out=bounds[1:])
    owner = np.repeat(np.arange(len(many)), many)
    at = np.arange(bounds[-1]) - bounds[owner] + found.bounds[owner]
    ends = found.bounds[owner + 1]
    h = np.zeros(len(at), np.uint64)
    for step in range(n):
        # past the end of a short text nothing is added, so its length is part of its hash
        has = at + step < ends
        word = keys[np.minimum(at + step, max(total - 1, 0))] if total else keys
        h = np.where(has, mixed((h + _STEP) ^ word), h)
    salted = mixed(h ^ mixed(owner.astype(np.uint64)))
    first = np.sort(np.unique(salted, return_index=True)[1])
    return h[first], np.searchsorted(owner[first], np.arange(len(many) + 1))


def set_keys(hashes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """128 bits for each set of shingles, whatever their order; null for an empty set."""
    halves = np.stack([_sums(mixed(hashes + _STEP), bounds), _sums(mixed(hashes ^ _STEP), bounds)], 1)
    n = len(bounds) - 1
    empty = pa.array(np.diff(bounds) == 0)
    held = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(16), n, [None, pa.py_buffer(np.ascontiguousarray(halves))]
    ).cast(pa.binary())
    return pc.if_else(empty, pa.scalar(None, pa.binary()), held)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _signed(rows: DataFrame, n: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, limit=BATCH_BYTES):
            hashes, bounds = shingles(batch.column("text"), n)
            bands, sketch = SHAPE.signatures(hashes, bounds)
            have = np.diff(bounds) > 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(np.diff(bounds)), set_keys(hashes, bounds),
                 lists(bands, have), lists(sketch, have), lists(SHAPE.parities(hashes, bounds), have)],
                names=["key", "n_shingles", "set", "bands", "sketch", "parity"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    sketches = "bands array<long>, sketch array<long>, parity array<long>"
    return rows.mapInArrow(sign, f"key {kind}, n_shingles long, set binary, {sketches}")


def _sets(rows: DataFrame, n: int) -> DataFrame:
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, limit=BATCH_BYTES):
            hashes, bounds = shingles(batch.column("text"), n)
            held = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([set_keys(hashes, bounds), held], names=["set", "hashes"])

    return rows.mapInArrow(collect, "set binary, hashes array<long>")


def near_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: ``key, n_shingles, component_id, kept``.

    Words are runs of anything but ASCII white space, with A-Z in lower case. Two rows are linked if
    ``100 * shared >= percent * all`` of their distinct shingles of ``n`` words; component_id is the least
    key reachable by links, kept where it is the row's own.

    A text without words (null, empty or blank) is linked with nothing. A text of fewer than ``n`` words is
    one shingle. Rows of one key are separate and share a component only by their texts; a row with a null
    key is kept if all of its component have none. An empty table gives no rows. Only two columns are read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    signed = stored(_signed(rows, n))
    classes = signed.where("n_shingles > 0").groupBy("set").agg(
        F.min("key").alias("key"), F.first(F.struct(F.col("n_shingles").alias("size"), "bands", "sketch", "parity")).alias("of")
    )
    classes = stored(classes.select("set", "key", "of.*").withColumn("node", F.monotonically_increasing_id()))
    found = links(classes, lambda pairs: _confirmed(pairs, rows, classes, n, percent), SHAPE, percent)
    least = stored(classes.select("node", "set", "key").join(components(found), "node", "left").select(
        "set", "key", F.coalesce("label", "node").alias("label")
    ))
    first = stored(least.groupBy("label").agg(F.min("key").alias("component_id")))
    least = stored(least.select("set", "label").join(first, "label").select("set", "component_id"))
    component = F.coalesce("component_id", "key")
    return signed.select("key", "n_shingles", "set").join(least, "set", "left").select(
        F.col("key").alias(key), "n_shingles", component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
    )


def _confirmed(pairs: DataFrame, rows: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs that are similar by their whole sets, which are made again for the documents in them."""
    ends = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct()
    wanted = stored(classes.select(F.col("node").alias("a"), "key", "set").join(ends, "a"))
    made = _sets(maybe_in(rows, wanted, "key"), n).join(wanted.select("a", "set"), "set")
    sets = stored(made.select("a", "hashes"))
    held = pairs.join(sets.toDF("b", "hashes_b"), "b").join(sets.toDF("a", "hashes_a"), "a")
    shared = F.size(F.array_intersect("hashes_a", "hashes_b"))
    union = F.size("hashes_a") + F.size("hashes_b") - shared
    return held.where(100 * shared >= percent * union).select("a", "b").distinct()

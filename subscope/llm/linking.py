"""Links between similar sets: MinHash bands propose, odd sketches sift, a whole comparison confirms.

The least hash of a set under many functions gives its bands, and folded into a parity bitmap (an odd
sketch) an estimate of how many of these samples two sets share, from exclusive ors and population counts.
A second odd sketch, of the whole set, tells almost exactly where sets just miss the similarity: sketches
never differ in more bits than their sets have differing members, so it rejects no similar pair.

Sets that meet in a band are first compared with one of their bucket alone, which joins a large group
with as many comparisons as it has members. Where a bucket still holds several components, a task compares
their sketches, block by block, and hands on the likeliest pair of each component. Rounds of that go on while they
join any; then what is left is compared pair by pair, as far as the sketches leave it open. So what
sketches can tell is never a row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions.bitmaps import maybe_in
from subscope.llm.components import components
from subscope.llm.spans import give_back, mixed
from subscope.llm.stage import stored

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MOST = np.uint64(2**64 - 1)
BLOCK_NODES = 4096  # of a bucket, compared with as many others in one go
PAIRS_AT_ONCE = 1 << 17

Confirm = Callable[[DataFrame], DataFrame]


@lru_cache(maxsize=4)
def _functions(samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    draws = np.random.default_rng(20260101)
    return (
        draws.integers(0, 2**64, samples, np.uint64), draws.integers(0, 2**64, samples, np.uint64) | np.uint64(1),
        np.arange(samples, dtype=np.uint64) * _STEP,
    )


@lru_cache(maxsize=4)
def _orders(samples: int, bins: int) -> np.ndarray:
    """For each sample an order of the bins, in which an empty one asks the others."""
    draws = np.random.default_rng(20260103)
    return np.array([draws.permutation(bins) for _ in range(samples)])


def _folded(x: np.ndarray, size: int) -> np.ndarray:
    """``x`` modulo ``size``, which takes no division if that is a power of two."""
    return x & np.uint64(size - 1) if size & (size - 1) == 0 else x % np.uint64(size)


@dataclass(frozen=True)
class Shape:
    """``bands`` of ``rows`` samples each, and sketches of the samples and of the set, of so many bits.

    parity: bits of the set's own sketch, 0 for none. binned: one hash function gives all samples,
    the least hash of each of as many bins, instead of a function for every sample: a fraction of the work.
    An empty bin takes the sample of the first bin that isn't, in an order of its own, so small sets miss hardly more. sigmas: how far under its expectation a pair may come out in the sketches and still be compared.
    """

    bands: int
    rows: int
    sketch: int
    parity: int = 0
    binned: bool = False
    sigmas: float = 5.0

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    def missed(self, percent: int) -> float:
        """How likely sets just this similar meet in no band."""
        return (1 - (percent / 100) ** self.rows) ** self.bands

    def most_bits_apart(self, percent: int) -> int:
        """Bits in which the sketches of two sets this similar differ at most, but for rare chance.

        Samples shared are binomial, and every sample not shared flips one bit of either sketch.
        """
        j = percent / 100
        flips = 2 * (self.samples * (1 - j) + self.sigmas * math.sqrt(self.samples * j * (1 - j)))
        expected = self.sketch / 2 * (1 - (1 - 2 / self.sketch) ** flips)
        spread = math.sqrt(self.sketch / 4 * (1 - (1 - 2 / self.sketch) ** (2 * flips)))
        return math.ceil(expected + spread)

    def signatures(self, hashes: np.ndarray, bounds: np.ndarray, *, sketched: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Band hashes and odd sketch of each set that isn't empty; the sketch is left blank if it isn't asked for."""
        starts = bounds[:-1][np.diff(bounds) > 0]
        bands = np.zeros((len(starts), self.bands), np.uint64)
        sketch = np.zeros((len(starts), self.sketch // 64), np.uint64)
        sets = np.arange(len(starts))
        for i, sample in enumerate(self._samples(hashes, bounds, starts) if len(starts) else ()):
            band = i % self.bands if self.binned else i // self.rows
            bands[:, band] = mixed(bands[:, band] ^ sample) + _STEP
            if not sketched:
                continue
            bit = _folded(sample, self.sketch)
            sketch[sets, (bit >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (bit & np.uint64(63))
        return bands, sketch

    def _samples(self, hashes: np.ndarray, bounds: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        flip, multiply, place = _functions(self.samples)
        if not self.binned:
            for i in range(self.samples):
                yield mixed(np.minimum.reduceat((hashes ^ flip[i]) * multiply[i], starts) + place[i])
            return
        sizes, n = np.diff(bounds)[np.diff(bounds) > 0], self.samples
        value = (hashes ^ flip[0]) * multiply[0]
        at = value >> np.uint64(32)
        at *= np.uint64(n)
        at >>= np.uint64(32)
        at = at.view(np.int64)
        at += np.repeat(np.arange(len(starts)) * n, sizes)
        least = np.full(len(starts) * n, _MOST)
        np.minimum.at(least, at, value)
        least = least.reshape(-1, n)
        for i in range(n):
            filled = least[:, i].copy()
            empty = np.flatnonzero(filled == _MOST)
            for other in _orders(n, n)[i]:
                if not len(empty):
                    break
                filled[empty] = least[empty, other]
                empty = empty[filled[empty] == _MOST]
            yield mixed(filled + place[i])

    def parities(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Odd sketch of each whole set that isn't empty; its members must be distinct."""
        sizes = np.diff(bounds)[np.diff(bounds) > 0]
        place = _folded(mixed(hashes + _STEP), self.parity)
        place += np.repeat(np.arange(len(sizes), dtype=np.uint64) * np.uint64(self.parity), sizes)
        odd = np.zeros(len(sizes) * self.parity, np.uint8)
        np.add.at(odd, place.view(np.int64), np.uint8(1))  # of whatever sum, the last bit is right
        return np.packbits(odd & 1, bitorder="little").view(np.uint64).reshape(len(sizes), self.parity // 64)


def lists(values: np.ndarray, have: np.ndarray) -> pa.Array:
    """A row of ``values`` for each true, an empty list for each false."""
    offsets = np.zeros(len(have) + 1, np.int32)
    np.cumsum(have * values.shape[1], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1).view(np.int64)))


def _bits_apart(name: str, bits: int) -> Column:
    a, b = F.col(f"{name}_a"), F.col(f"{name}_b")
    return reduce(add, (F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(bits // 64)))


def _alike(shape: Shape, percent: int) -> Column:
    """Sizes and sketches that allow the similarity; a size of null rules nothing out."""
    a, b = F.col("size_a"), F.col("size_b")
    sizes = F.coalesce((100 * a >= percent * b) & (100 * b >= percent * a), F.lit(True))
    alike = sizes & (_bits_apart("sketch", shape.sketch) <= shape.most_bits_apart(percent))
    if shape.parity:  # at this similarity, (100 - percent) / (100 + percent) of both sizes are not shared
        alike &= (100 + percent) * _bits_apart("parity", shape.parity) <= (100 - percent) * (a + b)
    return alike


def _ends(sketches: DataFrame, end: str) -> DataFrame:
    return sketches.select(*[F.col(c).alias(end if c == "node" else f"{c}_{end}") for c in sketches.columns])


def links(signed: DataFrame, confirm: Confirm, shape: Shape, percent: int) -> DataFrame:
    """Pairs of nodes ``a, b`` that connect all that links between similar sets connect.

    signed: stored rows ``node, size, bands, sketch`` and ``parity`` if the shape has one; a node may have several rows, all alike. confirm
    takes pairs ``a, b`` and returns those that are similar.
    """
    bands = signed.select("node", F.explode("bands").alias("bucket"))
    shared = stored(bands.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("other")).where(
        "hub < other"
    ).select("bucket", "hub"))
    # most buckets hold one node: the bitmap leaves those rows where they are
    members = stored(maybe_in(bands, shared, "bucket").join(shared, "bucket").distinct())
    told = ["size", "bands", "sketch", *(["parity"] if shape.parity else [])]
    known = maybe_in(signed.select("node", *told), members.select("node"), "node")
    sketches = stored(known.groupBy("node").agg(*[F.first(c).alias(c) for c in told]))

    # one of a bucket for each node: the one that it meets most often
    meets = members.where("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("n"))
    star = meets.groupBy("node").agg(F.max_by("hub", F.struct("n", -F.col("hub").cast("decimal(20)"))).alias("b")).select(
        F.col("node").alias("a"), "b"
    )
    for end in ("a", "b"):
        star = star.join(_ends(sketches.drop("bands"), end), end)
    found = stored(confirm(stored(star.where(_alike(shape, percent)).select("a", "b"))))

    # what is still apart, compared where it meets: the likeliest pair of each component, while that joins any
    sketches = sketches.drop("bands")
    while True:
        labels = components(found)
        best = stored(_likeliest(_across(members, sketches, labels, shape, percent, every=False)))
        if best.isEmpty():
            return found
        new = stored(confirm(best.select("a", "b")))
        if new.isEmpty():
            break
        found = stored(found.unionByName(new))
    ends = [best.select(F.col(c).alias("label")) for c in ("label_a", "label_b")]
    doubtful = stored(ends[0].unionByName(ends[1]).distinct())
    others = _across(members, sketches, labels, shape, percent, every=True, among=doubtful)
    others = stored(others.select("a", "b").distinct().join(best.select("a", "b"), ["a", "b"], "left_anti"))
    return found if others.isEmpty() else stored(found.unionByName(confirm(others)))


def _likeliest(pairs: DataFrame) -> DataFrame:
    """Of ``a, b, label_a, label_b, bits``, the pair with the fewest bits apart of each component."""
    held = F.struct("a", "b", "label_a", "label_b")
    either = pairs.select(F.explode(F.array("label_a", "label_b")).alias("label"), held.alias("p"), F.struct("bits", "a", "b").alias("by"))
    return either.groupBy("label").agg(F.min_by("p", "by").alias("p")).select("p.*").distinct()


def _labelled(nodes: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    """With the component of column ``node``; a node without links is its own."""
    held = nodes.join(labels.toDF(node, "_label"), node, "left")
    return held.withColumn(label, F.coalesce("_label", node)).drop("_label")


def _across(
    members: DataFrame, sketches: DataFrame, labels: DataFrame, shape: Shape, percent: int, *, every: bool, among: DataFrame | None = None
) -> DataFrame:
    """Pairs ``a, b`` of one bucket and two components that sizes and sketches allow, with their labels and the bits they
    differ in: the likeliest of each component, for the most part, or every one, of the components ``among``."""
    labelled = _labelled(members.select("bucket", "node"), labels, "node", "label")
    if among is not None:
        labelled = maybe_in(labelled, among, "label").join(among, "label")
    labelled = stored(labelled)
    split = labelled.groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.ceil(F.count("*") / BLOCK_NODES).cast("int").alias("blocks")
    ).where("low < high").select("bucket", "blocks")
    open_ones = labelled.join(split, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # a block of a bucket meets itself and each other one in a run of rows of their own
    each = open_ones.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "label", "own", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("run"),
        (F.col("own") == F.col("other")).alias("alone"),
    )
    held = each.join(sketches, "node").repartition("run").sortWithinPartitions("run")
    told = ["run", "node", "label", "own", "alone", "size", "sketch", *(["parity"] if shape.parity else [])]
    return held.select(*told).mapInArrow(_compare(shape, percent, every), "a long, b long, label_a long, label_b long, bits int")


def _compare(shape: Shape, percent: int, every: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Compares the rows of each run, which lie side by side; a run that goes on in the next batch waits for it."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            run = batch.column("run").to_numpy()
            if held and run[0] == run[-1] == held[-1].column("run")[-1].as_py():
                held.append(batch)
                continue
            last = int(np.searchsorted(run, run[-1]))
            yield from _run_pairs(pa.Table.from_batches([*held, batch.slice(0, last)]), shape, percent, every)
            held = [batch.slice(last)]
        if held:
            yield from _run_pairs(pa.Table.from_batches(held), shape, percent, every)
        give_back()

    return compare


def _words(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy().view(np.uint64).reshape(len(column), -1)


def _run_pairs(rows: pa.Table, shape: Shape, percent: int, every: bool) -> Iterator[pa.RecordBatch]:
    if rows.num_rows < 2:
        return
    run, node, label, own = (rows[c].to_numpy() for c in ("run", "node", "label", "own"))
    alone = rows["alone"].to_numpy()
    size = rows["size"].to_numpy()
    sketch = _words(rows["sketch"])
    parity = _words(rows["parity"]) if shape.parity else None
    most = shape.most_bits_apart(percent)
    later = np.searchsorted(run, run, "right") - np.arange(len(run)) - 1  # rows of the run after each
    total = np.concatenate([[0], np.cumsum(later)])
    for first in range(0, int(total[-1]), PAIRS_AT_ONCE):
        at = np.arange(first, min(first + PAIRS_AT_ONCE, int(total[-1])))
        a = np.searchsorted(total, at, "right") - 1
        b = a + 1 + at - total[a]
        kept = (label[a] != label[b]) & ((own[a] != own[b]) | alone[a])
        with np.errstate(invalid="ignore"):  # a size that isn't known rules nothing out
            kept &= ~((100 * size[a] < percent * size[b]) | (100 * size[b] < percent * size[a]))
        a, b = a[kept], b[kept]
        bits = np.bitwise_count(sketch[a] ^ sketch[b]).sum(1, dtype=np.int32)
        kept = bits <= most
        a, b, bits = a[kept], b[kept], bits[kept]
        if parity is not None:
            apart = np.bitwise_count(parity[a] ^ parity[b]).sum(1, dtype=np.int64)
            kept = (100 + percent) * apart <= (100 - percent) * (size[a] + size[b])
            a, b, bits = a[kept], b[kept], bits[kept]
        swap = label[a] > label[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        if not every:  # the likeliest pair of each component
            kept = np.zeros(len(a), bool)
            for side in (label[a], label[b]):
                order = np.lexsort((node[b], node[a], bits, side))
                new = np.ones(len(a), bool)
                new[1:] = side[order][1:] != side[order][:-1]
                kept[order[new]] = True
            a, b, bits = a[kept], b[kept], bits[kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (node[a], node[b], label[a], label[b], bits)], names=["a", "b", "label_a", "label_b", "bits"]
        )

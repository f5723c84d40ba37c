"""Documents as token pieces, packed into as few sequences of bounded length as can be found.

Pieces are dealt at random into partitions of bounded size, each packed best fit decreasing. Dual
feasible functions give a lower bound of the sequences that any packing needs, of a partition and of all: a partition
that meets its own is certified. Those with gaps exchange the pieces of their open sequences and pack
them again. Once all are certified, what they still waste together is their last, half-filled sequences, whose
pieces are then exchanged too, as far as the bound of all pieces isn't met.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.encoding import encoder
from subscope.llm.spans import by_bytes
from subscope.settings import cut, small_batches

CAPACITY = 4096
PER_PARTITION = 20_000  # pieces packed together by one task
BATCH_BYTES = 1 << 20  # of text encoded at once
_CLASSIC = 64  # members tried of the family that rounds multiples


def token_pieces(
    docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text",
    end_id: int = 1, capacity: int = CAPACITY,
) -> DataFrame:
    """Each document's ids with ``end_id`` after them, cut only where longer than ``capacity``.

    Returns ``key, piece, start, length, ids``: ids are little-endian unsigned 32-bit numbers, start
    counts the document's ids before the piece. Null and empty texts are the end id alone; repeated
    rows and null keys are documents like others; other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        for batch in by_bytes(batches, limit=BATCH_BYTES):
            ids, bounds = tokens.encode(batch.column("text"))
            ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
            bounds = bounds + np.arange(len(bounds))
            n = -(-np.diff(bounds) // capacity)
            of = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            at = bounds[of] + start
            length = np.minimum(bounds[of + 1] - at, capacity)
            # pieces follow one another without gaps, so the ids are one buffer with offsets
            offsets = np.append(at, len(ids)) * 4
            held = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(of), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), held.cast(pa.binary())],
                names=["key", "piece", "start", "length", "ids"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids binary"
    return rows.mapInArrow(pieces, schema).withColumnRenamed("key", key)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each length and its offset there; a length goes where it leaves the least room."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by the room they have
    filled, n = 0, 0  # filled: bit r is set where a bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = filled >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            at = room[r].pop()
            if not room[r]:
                filled ^= 1 << r
        else:
            r, at, n = capacity, n, n + 1
        bins[i], offsets[i] = at, capacity - r
        if not room[r - size]:
            filled |= 1 << (r - size)
        room[r - size].append(at)
    return bins, offsets


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing of ``counts[i]`` pieces of ``lengths[i]`` needs, by dual feasible functions.

    Such a function never gives the pieces of one bin more than 1 in all, so its sum over all pieces is
    a bound. Two families: pieces under a threshold count nothing and those that leave less than it
    count as a whole bin; and sizes rounded down to multiples. All sums are of whole numbers.
    """
    have = np.zeros(capacity + 1, np.int64)
    np.add.at(have, lengths, counts)
    size = np.arange(capacity + 1, dtype=np.int64)
    number, volume = np.cumsum(have), np.cumsum(have * size)
    low = np.arange(1, capacity // 2 + 1)
    high = capacity - low
    sums = capacity * (number[-1] - number[high]) + volume[high] - volume[low - 1]
    best = -(-int(volume[-1]) // capacity)
    if len(sums):
        best = max(best, -(-int(sums.max()) // capacity))
    for k in range(1, _CLASSIC):
        up = (k + 1) * size
        worth = np.where(up % capacity == 0, k * size, up // capacity * capacity)
        best = max(best, -(-int((worth * have).sum()) // (k * capacity)))
    return best


def _packed(pieces: DataFrame, n: int, stage: int, capacity: int) -> DataFrame:
    """``row, length, sequence_id, offset, opens, spare, certified`` after packing n random partitions.

    spare: the room left in the piece's sequence. certified: its partition met its own lower bound.
    """

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        lengths = frame["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        least = lower_bound(*np.unique(lengths, return_counts=True), capacity)
        first = np.unique(bins, return_index=True)[1]
        opens = np.zeros(len(bins), bool)
        opens[first] = True
        group = int(frame["part"].iloc[0])
        return pd.DataFrame({
            "row": frame["row"], "length": lengths, "sequence_id": ((stage << 24) + group << 32) + bins,
            "offset": offsets, "opens": opens, "spare": capacity - fill[bins], "certified": len(fill) == least,
        })

    dealt = pieces.select("row", "length", F.pmod(F.xxhash64("row", F.lit(stage)), F.lit(n)).alias("part"))
    schema = "row long, length long, sequence_id long, offset long, opens boolean, spare long, certified boolean"
    return dealt.groupBy("part").applyInPandas(pack, schema)


def pack(
    pieces: DataFrame, *, row: str = "row", length: str = "length", capacity: int = CAPACITY,
    per_partition: int = PER_PARTITION,
) -> DataFrame:
    """Place every piece: ``row, sequence_id, offset``, offsets without gaps from 0 in each sequence.

    ``pieces`` is read several times and so should be stored; ``row`` tells its rows apart and lengths
    are 1 to ``capacity`` (others are refused). An empty table gives an empty result.

    The only thing that reaches the driver is how many pieces there are of each length (at most
    ``capacity`` numbers) and totals. Rounds of exchange go on while each saves a sequence.
    """
    sizes = pieces.select(F.col(row).alias("row"), F.col(length).cast("long").alias("length"))
    have = sizes.groupBy("length").count().limit(capacity + 2).collect()
    if any(h["length"] is None or not 1 <= h["length"] <= capacity for h in have):
        raise ValueError(f"lengths must be 1 to {capacity}")
    lengths = np.array([h["length"] for h in have], np.int64)
    counts = np.array([h["count"] for h in have], np.int64)
    least = lower_bound(lengths, counts, capacity)
    placed = cut(_packed(sizes, _partitions(int(counts.sum()), per_partition), 0, capacity))
    used, stage, gaps = placed.where("opens").count(), 0, True
    part = F.shiftright("sequence_id", 32)
    while used > least:  # not certified as a whole
        stage += 1
        with_gaps = placed.where("not certified") if gaps else placed
        if gaps and with_gaps.select(part).distinct().limit(2).count() < 2:
            gaps = False
            continue
        open_ones = with_gaps.where("spare > 0")
        n_open, bins_open, n_parts = open_ones.agg(F.count("*"), F.count_if("opens"), F.count_distinct(part)).first()
        if n_parts < 2:
            break  # one partition holds all that could be exchanged
        again = cut(_packed(open_ones, _partitions(n_open, per_partition), stage, capacity))
        saved = bins_open - again.where("opens").count()
        if saved > 0:
            kept = placed.where("spare = 0") if not gaps else placed.where("spare = 0 or certified")
            placed, used = cut(kept.unionByName(again)), used - saved
        elif gaps:
            gaps = False
        else:
            break
    return placed.select(F.col("row").alias(row), "sequence_id", "offset")


def _partitions(n: int, per_partition: int) -> int:
    return max(1, -(-n // per_partition))

"""Words, lines and tokenizer chunks of a whole Arrow batch at once, straight from its UTF-8 bytes.

A batch of texts is one byte buffer with an offset per text. Cutting it is a few passes over that
buffer, whatever the number or the length of the texts, so one very long text costs what its bytes cost.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# White space as the contracts have it, [\x20\x09-\x0D].
WHITE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

BATCH_BYTES = 12 << 20  # text handled at once; bounds a worker's memory

_LIBC = ctypes.CDLL(None)
_LONG = 512  # bytes from which a piece is hashed by itself
_SEED = np.uint64(0x9E3779B97F4A7C15)
_LANE = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n bytes of eight
_SPACE = np.zeros(256, bool)
_SPACE[list(WHITE)] = True


@dataclass
class Texts:
    """Bytes of a run of texts; text i is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lower(self) -> Texts:
        """With A-Z in lower case and every other byte as it was."""
        upper = (self.data - np.uint8(ord("A"))) < 26
        return Texts(self.data + (upper.view(np.uint8) << np.uint8(5)), self.offsets)


@dataclass
class Pieces:
    """Pieces of texts: piece j is ``data[starts[j]:ends[j]]``, those of text i are ``bounds[i]:bounds[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        """The text of each piece."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def bytes_of(self, which: np.ndarray) -> list[bytes]:
        data = self.data.tobytes() if len(which) > 1000 else self.data
        cut = zip(self.starts[which].tolist(), self.ends[which].tolist(), strict=True)
        return [bytes(data[a:b]) for a, b in cut]

    def keys(self) -> np.ndarray:
        """64-bit hash of each piece, eight bytes at a time for all pieces together."""
        length = self.ends - self.starts
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        lanes = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(self.data) + 1,), (1,))
        h = mixed(length.astype(np.uint64) + _SEED)
        for i in np.flatnonzero(length > _LONG).tolist():
            h[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i] : self.ends[i]])
        left, at, who = np.where(length > _LONG, 0, length), self.starts, None
        while True:
            if who is None:
                who = np.flatnonzero(left > 0)
            else:
                who = who[left > 0]
                at, left = at[left > 0], left[left > 0]
            if len(who) == 0:
                return h
            if len(who) != len(at):
                at, left = at[who], left[who]
            lane = lanes[at] & _LANE[np.minimum(left, 8)]
            h[who] = mixed(h[who] ^ lane) * _SEED
            at, left = at + 8, left - 8


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """A string column as bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(held[at[0] : at[-1]], at - at[0])


def by_bytes(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text: large ones are cut, small ones joined.

    A single longer text is a batch of its own. After the last the worker gives back what memory it no longer uses.
    """
    yield from _by_bytes(batches, column, limit)
    give_back()


def give_back() -> None:
    """Free memory goes back to the system: workers live on, and the next stage's tasks need it elsewhere."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def _by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit - size, "right")))
            if held and size + ends[stop - 1] - before > limit:
                yield _joined(held)
                held, size = [], 0
                continue
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1] - before)
            start = stop
            if size >= limit:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def inside(data: np.ndarray) -> np.ndarray:
    """Which bytes are of words: all but white space."""
    return (data != 0x20) & ((data - np.uint8(0x09)) > 0x0D - 0x09)


def words(texts: Texts, between: np.ndarray = _SPACE) -> Pieces:
    """Runs of anything but white space, or of anything but the bytes marked in ``between``."""
    held = inside(texts.data) if between is _SPACE else ~between[texts.data]
    first = held.copy()
    first[1:] &= ~held[:-1]
    heads = texts.offsets[:-1]
    heads = heads[heads < len(held)]
    first[heads] = held[heads]
    last = held
    last[:-1] &= ~held[1:] | first[1:]
    starts = np.flatnonzero(first)
    return Pieces(texts.data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, texts.offsets))


def line_starts(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each ``\\n``-separated line, and the bounds of each text's lines.

    An empty text has one empty line, as splitting has it.
    """
    breaks = np.flatnonzero(texts.data == 0x0A)
    starts = np.concatenate([breaks + 1, texts.offsets[:-1]])
    owner = np.concatenate([
        np.searchsorted(texts.offsets, breaks, "right") - 1, np.arange(len(texts), dtype=np.int64)
    ])
    order = np.lexsort((starts, owner))
    return starts[order], np.searchsorted(owner[order], np.arange(len(texts) + 1))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))  # an array of its own, changed in place from here on
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def summed(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive bounds; 0 where there are none."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]

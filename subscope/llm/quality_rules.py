"""Quality rules: counts of a document's own words and lines, and lines that many documents of a host share."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.functions.bitmaps import mark, maybe_in, unused
from subscope.functions.hashing import row_hash
from subscope.llm.spans import Pieces, Texts, by_bytes, line_starts, mixed, summed, texts_of, words
from subscope.llm.stage import stored
from subscope.settings import cut, small_batches

# The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"

BATCH_BYTES = 1 << 20  # of text measured together

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Limits:
    """What a document must meet.

    max_documents: a line in more different documents of one host is boilerplate. Documents are different
    if their sets of lines are, so copies count once.
    min_left: a document with less than this share of its words left is depleted.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    max_documents: int = 20
    min_left: float = 0.2


@dataclass
class Lines:
    """The lines with a word of a batch of texts: the text, key and words of each."""

    owner: np.ndarray
    key: np.ndarray
    words: np.ndarray
    at: np.ndarray  # place among all lines of the batch


def _lines(texts: Texts, found: Pieces, starts: np.ndarray, bounds: np.ndarray) -> Lines:
    """A line's key is of its words in lower case and their order, so spacing doesn't matter."""
    lowered = Pieces(texts.lower().data, found.starts, found.ends, found.bounds).keys()
    line = np.searchsorted(starts, found.starts, "right") - 1
    edges = np.searchsorted(line, np.arange(len(starts) + 1))
    place = np.arange(len(line)) - edges[line]
    total = np.zeros(len(line) + 1, np.uint64)
    np.cumsum(mixed(lowered + place.astype(np.uint64) * _STEP), out=total[1:])
    n = np.diff(edges)
    at = np.flatnonzero(n)
    owner = np.searchsorted(bounds, at, "right") - 1
    return Lines(owner, (total[edges[1:]] - total[edges[:-1]])[at], n[at], at)


def _distinct_per_text(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For equal keys of one text: the first place of each, ascending, and which of them each row is."""
    _, first, which = np.unique(mixed(key ^ mixed(owner.astype(np.uint64))), return_index=True, return_inverse=True)
    order = np.argsort(first)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return first[order], rank[which]


def _repeated(found: Pieces, keys: np.ndarray) -> np.ndarray:
    """Words of each text in windows of three that it has twice or more."""
    owner = found.owners()
    covered = np.zeros(len(keys), bool)
    if len(keys) >= 3:
        at = np.flatnonzero(owner[2:] == owner[:-2])
        window = mixed(mixed(mixed(owner[at].astype(np.uint64) + _STEP) ^ keys[at]) * _STEP ^ keys[at + 1])
        window = mixed(window * _STEP ^ keys[at + 2])
        ordered = np.sort(window)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        at = at[pd.Index(twice).get_indexer(window) >= 0]
        for step in range(3):
            covered[at + step] = True
    return summed(covered, found.bounds)


def _measured(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = texts_of(batch.column("text"))
    n = len(texts)
    found = words(texts)
    inside = np.zeros(len(texts.data) + 1, np.int8)
    inside[found.starts] += 1
    inside[found.ends] -= 1  # ends differ from one another, and a start among them comes to 0
    starts, bounds = line_starts(texts)
    lines = _lines(texts, found, starts, bounds)

    ends = np.append(starts[1:], len(texts.data))
    last = np.zeros(len(starts), bool)
    last[bounds[1:] - 1] = True
    raw = Pieces(texts.data, starts[lines.at], (ends - ~last)[lines.at], bounds).keys()
    distinct_raw, _ = _distinct_per_text(lines.owner, raw)
    n_dup = np.bincount(lines.owner, minlength=n) - np.bincount(lines.owner[distinct_raw], minlength=n)

    first, which = _distinct_per_text(lines.owner, lines.key)
    weight = np.bincount(which, weights=lines.words, minlength=len(first)).astype(np.int64)
    edges = np.searchsorted(lines.owner[first], np.arange(n + 1))
    key = lines.key[first]

    point = (texts.data & 0xC0) != 0x80
    columns = {
        "key": batch.column("key"), "host": batch.column("host"), "who": batch.column("who"),
        "n_words": found.counts,
        "word_chars": summed(point & (np.cumsum(inside[:-1], dtype=np.int8) > 0), texts.offsets),
        "n_symbols": summed(_SYMBOL[texts.data], texts.offsets),
        "n_dup_lines": n_dup,
        "n_repeat_words": _repeated(found, found.keys()),
        "lines": pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(key.view(np.int64))),
        "line_words": pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(weight)),
    }
    arrays = [v if isinstance(v, pa.Array) else pa.array(np.asarray(v, np.int64)) for v in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def judge(
    docs: DataFrame, limits: Limits = Limits(), *, key: str = "doc_id", text: str = "text", host: str = "source"
) -> DataFrame:
    """One row per row: its counts, ``base_failed``, ``kept`` and ``n_left`` (words outside boilerplate lines).

    Also ``who``, a hash of key, host and text, alike for rows alike in them, and ``boilerplate``, the keys
    of its lines to remove.

    Own counts: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``. A line counts for a host once
    per different document; line hashes of all documents are shuffled, nothing else. A null or empty text has no words
    and fails; a null host is a host of its own; repeated rows are documents of their own, alike.
    An empty table gives no rows. Only the three columns named are read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(host).alias("host"), F.col(text).alias("text"))
    rows = rows.withColumn("who", row_hash(["key", "host", "text"]))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, limit=BATCH_BYTES):
            yield _measured(batch)

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("key", "host")}
    counted = rows.mapInArrow(measure, (
        f"key {kinds['key']}, host {kinds['host']}, who long, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, lines array<long>, line_words array<long>"
    ))
    base = stored(counted.withColumn("row", F.monotonically_increasing_id()))

    lines = base.select(
        "row", "host", F.xxhash64(F.sort_array("lines")).alias("content"), F.explode(F.arrays_zip("lines", "line_words")).alias("line"),
    ).select(
        "row", "content", F.col("line.lines").alias("key"), F.col("line.line_words").alias("words"),
        F.xxhash64(F.col("host").isNull(), "host", "line.lines").alias("line"),
    )
    counts = lines.groupBy("line").agg(F.count_distinct("content").alias("n"))
    shared = stored(counts.where(F.col("n") > limits.max_documents).select("line"))
    removed = maybe_in(lines.drop("content"), shared, "line").join(shared, "line").groupBy("row").agg(
        F.sum("words").alias("n_removed"), F.collect_list("key").alias("boilerplate")
    )
    left = F.col("n_words") - F.coalesce("n_removed", F.lit(0))
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")
    )
    return base.join(removed, "row", "left").select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (left >= limits.min_left * F.col("n_words"))).alias("kept"), left.alias("n_left"), "who", "boilerplate",
    )


def clean(
    docs: DataFrame, limits: Limits = Limits(), *, key: str = "doc_id", text: str = "text", host: str = "source",
    length: str | None = "n_chars",
) -> DataFrame:
    """``docs`` without the documents that are rejected, and without boilerplate lines in the others.

    All columns come through; ``length``, if there is such a column, is counted anew where lines went.
    Documents that lose nothing are not shuffled.
    """
    verdict = judge(docs, limits, key=key, text=text, host=host)
    touched = cut(
        verdict.where(~F.col("kept") | F.col("boilerplate").isNotNull())
        .groupBy("who").agg(F.first("kept").alias("_kept"), F.first("boilerplate").alias("_lines"))
    )
    who, maybe, kept, gone = unused(docs, "who", "maybe", "kept", "lines")
    named = docs.withColumn(who, row_hash([key, host, text]))
    told = touched.select(F.col("who").alias(who), F.col("_kept").alias(kept), F.col("_lines").alias(gone))
    marked = mark(named, told.select(who), who, maybe)
    some = marked.where(F.col(maybe)).join(told, who, "left").where(F.coalesce(F.col(kept), F.lit(True)))
    columns = docs.columns

    def drop_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text, BATCH_BYTES):
            yield _without(batch, text, gone).select(columns)

    edited = some.select(*columns, gone).mapInArrow(drop_lines, docs.schema)
    if length in columns:
        edited = edited.withColumn(length, F.length(text).cast(docs.schema[length].dataType))
    return marked.where(~F.col(maybe)).select(*columns).unionByName(edited)


def _without(batch: pa.RecordBatch, text: str, lines: str) -> pa.RecordBatch:
    """The batch with the lines whose keys are listed in column ``lines`` taken out of its texts."""
    held = batch.column(lines)
    some = np.flatnonzero(np.asarray(held.is_valid()))
    if not len(some):
        return batch
    column = batch.column(text).take(pa.array(some))
    texts = texts_of(column)
    starts, bounds = line_starts(texts)
    found = _lines(texts, words(texts), starts, bounds)
    out = [set(keys) for keys in held.take(pa.array(some)).to_pylist()]
    gone = {
        int(at) for at, who, k in zip(found.at, found.owner, found.key.view(np.int64).tolist()) if k in out[who]
    }
    new = batch.column(text).to_pylist()
    for j, (row, body) in enumerate(zip(some.tolist(), column.to_pylist())):
        if body is not None:
            parts = body.split("\n")
            new[row] = "\n".join(p for i, p in enumerate(parts, int(bounds[j])) if i not in gone)
    return batch.set_column(batch.schema.get_field_index(text), text, pa.array(new, batch.schema.field(text).type))

"""Scores of texts by a smoothed bigram model whose counts live in a log-frequency Bloom filter.

A count is kept as its logarithm's integer part, in the unary code of so many memberships: an n-gram of
level q is in the filter together with each of 1 to q, and its level is read back by probing 1, 2, ... up
to the first miss. The filter is cut into segments by the n-grams' hashes. Segments are of one bounded size, and their number
grows with the training tokens, so no worker ever holds more than one: a worker's block of documents sends the distinct n-grams
that it asks for to their segments, together with how often it has learnt them, where the counts are summed, the bits are
set, and every n-gram is probed once and answered with its level.

Exact unigram counts come along: a block is stored as codes of its distinct words, the words of all blocks meet by
word and go back to their blocks with the counts of the whole corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.spans import by_bytes, mixed, texts_of, words
from subscope.llm.stage import folder, stored

END = np.uint64(0x5BF0_3635_DEAD_10CC)  # the key of a text's end, which also stands before its first word
SEGMENT_GRAMS = 1 << 20  # n-grams of a segment, if every training token were two of its own
LEAST_SEGMENTS = 16
BLOCK_BYTES = 24 << 20  # of text in a block: the larger, the fewer words and n-grams go to and fro
SLICE = 1 << 19  # tokens scored together

_LOW = np.uint64(0xFFFFFFFF)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_SINGLE = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Model:
    """How counts are kept and probabilities smoothed.

    bits_per_gram is what the filter takes, whatever the corpus. base: counts of one level lie within this
    factor. probes: bits a membership sets. weight: counts that the unigram distribution is worth behind every word.
    """

    bits_per_gram: int = 10
    base: float = 1.5
    probes: int = 2
    weight: float = 4.0

    def level(self, count: np.ndarray) -> np.ndarray:
        return 1 + np.floor(np.log(count) / math.log(self.base) + 1e-9).astype(np.int64)

    def count(self, level: np.ndarray) -> np.ndarray:
        """The middle of the counts that share a level; 0 for level 0."""
        least = np.ceil(self.base ** (level - 1) - 1e-9)
        most = np.maximum(least, np.ceil(self.base**level - 1e-9) - 1)
        return np.where(level > 0, (least + most) / 2, 0.0)

    def places(self, gram: np.ndarray, level: int, probe: int, bits: int) -> np.ndarray:
        """The bit, within a segment of ``bits``, of a membership of an n-gram's lower 32 bits."""
        salt = np.uint64((2 * level + probe + 1) * int(_SINGLE) & (1 << 64) - 1)
        return mixed(gram + salt) & np.uint64(bits - 1)


@dataclass
class Segment:
    """The bits of one segment, and how to set and ask them. N-grams are told apart by 32 bits within it."""

    model: Model
    bits: int

    def __post_init__(self) -> None:
        self.data = np.zeros(self.bits // 8, np.uint8)

    def learn(self, grams: np.ndarray, counts: np.ndarray) -> None:
        level = self.model.level(counts)
        for q in range(1, int(level.max(initial=0)) + 1):
            some = grams[level >= q]
            for probe in range(self.model.probes):
                at = self.model.places(some, q, probe, self.bits)
                np.bitwise_or.at(self.data, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The level of each n-gram, by probing one after another; a chance hit can make it too high."""
        found, left = np.zeros(len(grams), np.uint8), np.arange(len(grams))
        level = 1
        while len(left) and level < 255:
            for probe in range(self.model.probes):
                at = self.model.places(grams[left], level, probe, self.bits)
                byte = self.data[(at >> np.uint64(3)).astype(np.int64)]
                left = left[(byte >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            found[left] = level
            level += 1
        return found


def singles(keys: np.ndarray) -> np.ndarray:
    return mixed(keys ^ _SINGLE)


def pairs(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mixed(before * _PAIR + after)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each text's lower-cased words and its end, and the bounds of each text's."""
    found = words(texts_of(column).lower())
    keys = np.insert(found.keys(), found.bounds[1:], END)
    return keys, found.bounds + np.arange(len(found.bounds))


def _before(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    before = np.empty_like(keys)
    before[1:] = keys[:-1]
    before[bounds[:-1]] = END
    return before


def _pack(codes: np.ndarray) -> bytes:
    """Codes as four planes of bytes, compressed: small codes are frequent, so upper planes are mostly 0."""
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").reshape(-1)


def _told(grams: np.ndarray, segments: int) -> np.ndarray:
    """What is kept of an n-gram: the number of its segment, above 32 more bits."""
    return (grams >> np.uint64(64 - segments.bit_length() + 1) << np.uint64(32) | grams & _LOW) if segments > 1 else grams & _LOW


def _distinct(words_of: np.ndarray, codes: np.ndarray, bounds: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct n-grams, segment after segment, and which of them its words and then its pairs are."""
    keys = words_of[codes]
    every = _told(np.concatenate([singles(words_of), pairs(_before(keys, bounds), keys)]), segments)
    return np.unique(every, return_inverse=True)


def _blocks(rows: DataFrame) -> DataFrame:
    """One row for each batch: its documents as codes, and its distinct words with their training counts.

    Words are in the order of their codes, the most frequent first.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, batch in enumerate(by_bytes(batches, limit=BLOCK_BYTES)):
            keys, bounds = tokens(batch.column("text"))
            held = np.asarray(batch.column("held_out").to_numpy(zero_copy_only=False), bool)
            codes, distinct = pd.factorize(keys)
            often = np.bincount(codes, minlength=len(distinct))
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            learnt = np.bincount(codes, weights=np.repeat(~held, np.diff(bounds)), minlength=len(distinct))
            lists = [
                pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
                for v in (batch.column("key"), batch.column("held_out"), pa.array(np.diff(bounds)),
                          pa.array(distinct[order].view(np.int64)), pa.array(learnt[order].astype(np.int64)))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 24) + i]), *lists, pa.array([_pack(rank[codes])], pa.binary())],
                names=["block", "keys", "held_out", "n_tokens", "words", "learnt", "codes"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(code, (
        f"block long, keys array<{kind}>, held_out array<boolean>, n_tokens array<long>, "
        "words array<long>, learnt array<long>, codes binary"
    ))


def sizes(n_tokens: int, model: Model) -> tuple[int, int]:
    """How many segments there are, and the bits of each, so that every training token can be two n-grams of its own."""
    grams = 2 * max(n_tokens, 1)
    segments = max(LEAST_SEGMENTS, 1 << (-(-grams // SEGMENT_GRAMS) - 1).bit_length())
    bits = max(1024, 1 << (-(-grams * model.bits_per_gram // segments) - 1).bit_length())
    return segments, bits


def _asked(blocks: DataFrame, segments: int) -> DataFrame:
    """``block, segment, grams, counts``: the distinct n-grams of each block, and how often it has learnt them."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in batch.to_pylist():
                bounds = np.concatenate([[0], np.cumsum(held["n_tokens"])]).astype(np.int64)
                words_of = np.array(held["words"], np.int64).view(np.uint64)
                codes = _unpack(held["codes"], int(bounds[-1]))
                grams, which = _distinct(words_of, codes, bounds, segments)
                taught = np.repeat(~np.array(held["held_out"], bool), np.diff(bounds))
                learnt = np.concatenate([np.array(held["learnt"], np.int64), taught])
                counts = np.bincount(which, weights=learnt, minlength=len(grams)).astype(np.int64)
                edges = np.searchsorted(grams >> np.uint64(32), np.arange(segments + 1))
                some = np.flatnonzero(np.diff(edges)).tolist()
                low = (grams & _LOW).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), held["block"])), pa.array(np.array(some, np.int64)),
                     pa.array([low[edges[i] : edges[i + 1]].tobytes() for i in some], pa.binary()),
                     pa.array([_pack(counts[edges[i] : edges[i + 1]]) for i in some], pa.binary())],
                    names=["block", "segment", "grams", "counts"],
                )

    told = blocks.select("block", "held_out", "n_tokens", "words", "learnt", "codes")
    return told.mapInArrow(ask, "block long, segment long, grams binary, counts binary")


def _answers(blocks: DataFrame, segments: int, bits: int, model: Model) -> DataFrame:
    """``block, levels``: the levels of each block's distinct n-grams, a byte for each.

    A segment is built and asked in one place, where all that is learnt of it and all that is asked meet.
    """

    def answer(asked: pa.Table) -> pa.Table:
        grams = [np.frombuffer(g, "<u4") for g in asked["grams"].to_pylist()]
        ends = np.cumsum([len(g) for g in grams])
        counts = np.concatenate([_unpack(c, len(g)) for c, g in zip(asked["counts"].to_pylist(), grams)])
        known, which = np.unique(np.concatenate(grams).astype(np.uint64), return_inverse=True)
        total = np.bincount(which, weights=counts, minlength=len(known)).astype(np.int64)
        segment = Segment(model, bits)
        segment.learn(known[total > 0], total[total > 0])
        levels = segment.levels(known)[which]
        return pa.table({
            "block": asked["block"], "segment": asked["segment"],
            "levels": pa.array([x.tobytes() for x in np.split(levels, ends[:-1])], pa.binary()),
        })

    found = _asked(blocks, segments).groupBy("segment").applyInArrow(answer, "block long, segment long, levels binary")
    return found.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("segment", "levels"))).alias("answers")).select(
        "block", F.col("answers.levels").alias("levels")
    )


def score(
    docs: DataFrame, held_out: str, *, model: Model = Model(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    held_out: a condition in SQL; rows for which it is true are scored and not learnt from. Tokens are
    the words with A-Z in lower case, then one end. base_score uses exact unigram counts; score is the log10
    probability by the bigram model from the filter's counts.

    Null and empty texts are the end alone. Repeated rows are learnt as often as they occur; a null key
    is kept. With no training rows all counts are 0 and score is 0, as base_score is; an empty table gives no rows.
    Only the columns of key, text and condition are read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("string").alias("key"),  # lists of numbers with nulls would not keep them exact
        F.col(text).alias("text"), F.coalesce(F.expr(held_out), F.lit(False)).alias("held_out"),
    )
    path = folder(rows, "lm")
    _blocks(rows).write.parquet(path, compression="zstd")
    blocks = spark.read.parquet(path)
    listed = blocks.select("block", F.posexplode(F.arrays_zip("words", "learnt")).alias("code", "w")).select(
        "block", "code", F.col("w.words").alias("word"), F.col("w.learnt").alias("learnt"),
    )
    known = listed.where("learnt > 0").agg(F.sum("learnt").alias("n"), F.approx_count_distinct("word").alias("v")).first()
    n_all = known["n"] or 0
    about = n_all + 0.5 * (known["v"] + 1)  # what smoothing divides by; the base score has the exact number
    segments, bits = sizes(n_all, model)

    # a block has a word once, so even the most frequent word is no more rows than there are blocks
    by_word = listed.repartition("word")
    totals = by_word.groupBy("word").agg(F.sum("learnt").alias("total"), F.min("block").alias("first"))
    leads = (F.col("block") == F.col("first")) & (F.col("total") > 0)  # once for each distinct training word
    counted = by_word.join(totals, "word").select(
        F.col("block").alias("of"), "code", "word", "total", leads.alias("leads")
    )

    def judge(block: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        held = block.iloc[0]
        bounds = np.zeros(len(held["n_tokens"]) + 1, np.int64)
        np.cumsum(held["n_tokens"], out=bounds[1:])
        codes = _unpack(held["codes"], int(bounds[-1]))
        order = np.argsort(counts["code"].to_numpy())
        words_of = counts["word"].to_numpy()[order].view(np.uint64)
        exact = counts["total"].to_numpy()[order].astype(np.float64)
        _, which = _distinct(words_of, codes, bounds, segments)
        counts_of = model.count(np.arange(256))[np.frombuffer(b"".join(held["levels"]), np.uint8)][which]
        about_word, about_pair = counts_of[: len(words_of)], counts_of[len(words_of) :]
        end = about_word[np.flatnonzero(words_of == END)[0]]
        log_exact, known_word = np.log10(exact + 0.5), (exact > 0).astype(np.int64)
        sums = [np.zeros(len(bounds) - 1, kind) for kind in (np.int64, np.float64, np.float64)]
        at = 0
        while at < len(bounds) - 1:  # some documents at a time
            stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + SLICE, "right")) - 1)
            edges = bounds[at : stop + 1] - bounds[at]
            mine = codes[bounds[at] : bounds[stop]]
            behind = np.empty(len(mine))
            behind[1:] = about_word[mine[:-1]]
            behind[edges[:-1]] = end
            together = np.minimum(about_pair[bounds[at] : bounds[stop]], behind)
            alone = (about_word[mine] + 0.5) / about
            likely = np.log10((together + model.weight * alone) / (behind + model.weight))
            for out, values in zip(sums, (known_word[mine], log_exact[mine], likely), strict=True):
                out[at:stop] = np.add.reduceat(values, edges[:-1])
            at = stop
        distinct = np.zeros(len(bounds) - 1, np.int64)
        distinct[0] = counts["leads"].sum()  # the block's part of the number of distinct words, with its first row
        return pd.DataFrame({
            "key": list(held["keys"]), "held_out": held["held_out"], "n_tokens": np.diff(bounds),
            "n_known": sums[0], "train_tokens": n_all, "base_score": sums[1], "score": sums[2],
            "distinct": distinct,
        })

    kind = rows.schema["key"].dataType.simpleString()
    schema = (
        f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, distinct long"
    )
    texts = blocks.select("block", "keys", "held_out", "n_tokens", "codes").join(_answers(blocks, segments, bits, model), "block")
    scored = stored(texts.groupBy("block").cogroup(counted.groupBy("of")).applyInPandas(judge, schema))
    n_distinct = scored.agg(F.sum("distinct")).first()[0] or 0
    whole = n_all + 0.5 * (n_distinct + 1)
    base = F.col("base_score") - F.col("n_tokens") * math.log10(whole)
    names = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return scored.withColumn("base_score", base).select(F.col("key").cast(docs.schema[key].dataType).alias(key), *names)

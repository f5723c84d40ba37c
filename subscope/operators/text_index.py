"""Text retrieval by an inverted index, and passages of long texts.

A term's weight in a text is a whole number: the bits of its count times a hundredfold, rounded, rarity. A score
is the cosine of two texts' weights. Every sum is of whole numbers, so results don't depend on the
partitioning, and another engine finds the same ones.

Texts are packed where they are read: a pack is one row, its postings by term compressed. Only the distinct terms of a pack travel,
to be counted and to bring back their rarity. In a finished pack alike texts lie side by side, in groups. Blocks of queries meet packs
in a product that shuffles neither, and a task takes its queries from pack to pack with the scores that have to be reached. What the frequent terms could add at most
follows from a group's greatest weights and from the length of its texts' part in them; the rarer terms are summed up, and only texts that could come among the
best are scored in full. Nothing is approximate, and a pack hands on the k best of each query at most.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscope.functions.bitmaps import mark
from subscope.settings import cut, shared_folder, small_batches
from subscope.sources.tables import write_table

# The task functions travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TERM = r"[\p{L}\p{N}]+"
RARITY = 100  # a unit of rarity
FIRST_TEXTS = 1024  # of a pack, scored before anything is ruled out
SLACK = 1e-5  # by which bounds in single precision are widened, above any rounding
BLOCK_TEXTS, BLOCK_POSTINGS, BLOCK_QUERIES = 262144, 6_000_000, 16384  # of a pack, which has up to twice as many texts, and of a block of queries
LEAST_TEXTS, LEAST_ASKED, TASKS_PER_CORE = 8192, 1024, 2  # smaller packs and blocks are made for idle cores, but not below so many
CELLS_AT_ONCE = 1 << 18  # bounds of a batch
FREQUENT, MOST_FREQUENT = 16, 256  # a term that one in so many of a pack's texts has, is frequent; so many terms at most
SHARES = 16  # classes of texts by what is frequent in them
GROUP = 64

PASSAGE_WORDS, STRIDE = 120, 60
BETWEEN_WORDS = r"[ \x09-\x0D]+"


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), 0)


def _bits(count: Column) -> Column:
    return F.length(F.bin(count))


@dataclass(frozen=True)
class TextIndex:
    """units: a row for each pack of texts, see ``_finished``. rarities: ``term, rarity, t``, t being the term's number in
    units. blocks: packs aimed at. group: the type of what queries may ask for."""

    units: DataFrame
    rarities: DataFrame
    blocks: int
    group: T.DataType


# --- packs ---


def _stored(packs: DataFrame) -> DataFrame:
    return write_table(packs, f"{shared_folder(packs.sparkSession)}/packs-{uuid.uuid4().hex}")


def _ranks(*columns: pa.Array) -> np.ndarray:
    """The rank of each row by ``columns``, alike rows together, nulls first."""
    keys: list[np.ndarray] = []

    def flat(column: pa.Array) -> None:
        if pa.types.is_struct(column.type):
            keys.append(np.asarray(pc.is_valid(column)).astype(np.int64))
            for field in column.flatten():
                flat(field)
            return
        coded = column.dictionary_encode()
        rank = np.empty(len(coded.dictionary) + 1, np.int64)
        rank[np.asarray(pc.sort_indices(coded.dictionary))] = np.arange(len(coded.dictionary))
        rank[-1] = -1
        keys.append(rank[coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)])

    for column in columns:
        flat(column)
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _list(values: pa.Array | np.ndarray) -> pa.Array:
    """``values`` as the one list of a row."""
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _squeezed(values: np.ndarray) -> pa.Array:
    """Numbers as a row's compressed bytes, the first byte of each, then the second and so on."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.array([pa.compress(planes.tobytes(), codec="zstd", asbytes=True)], pa.binary())


def _unsqueezed(column: pa.ChunkedArray, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(column[0].as_buffer(), n * size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).ravel()


def _apart(places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of ascending places from each start on, how far each is from the one before."""
    out = np.diff(places, prepend=0)
    out[starts] = places[starts]
    return out.astype(np.uint32)


def _summed(apart: np.ndarray, starts: np.ndarray, often: np.ndarray) -> np.ndarray:
    total = np.cumsum(apart, dtype=np.int64)
    return total - np.repeat(total[starts] - apart[starts], often)


def _column(row: pa.Table, name: str) -> pa.Array:
    return row[name].combine_chunks().flatten()


PACKED = ("pack", "units", "pools", "gs", "terms", "often", "places", "bits")


def _packed(rows: DataFrame) -> DataFrame:
    """``PACKED``: texts with a word and a key, and their postings in the order of terms. rows: ``unit, pool, g, terms,
    bits``, bits being null where terms are still to be counted."""
    most_texts, most_postings = 2 * BLOCK_TEXTS, BLOCK_POSTINGS

    def packed(number: int, held: list[tuple]) -> pa.RecordBatch:
        named = pa.chunked_array([words for _, words, _, _, _ in held]).combine_chunks().dictionary_encode()
        ids, first, before, keys = named.indices.to_numpy(), 0, 0, []
        for units, words, text, code, bits in held:
            keys.append((ids[first + code].astype(np.int64) << 24 | (text + before)) << 8 | bits)
            first, before = first + len(words), before + units.num_rows
        keys = np.concatenate(keys)
        keys.sort()
        often = np.bincount(keys >> 32, minlength=len(named.dictionary))
        apart = _apart(keys >> 8 & 0xFFFFFF, np.cumsum(often) - often)
        units = pa.Table.from_batches([h[0] for h in held])
        arrays = [pa.array([number], pa.int64()), *(_list(units[c].combine_chunks()) for c in ("unit", "pool", "g"))]
        arrays += [_list(named.dictionary), _list(often.astype(np.int32)), _squeezed(apart), _squeezed((keys & 0xFF).astype(np.uint8))]
        return pa.RecordBatch.from_arrays(arrays, names=PACKED)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, texts, postings = TaskContext.get().partitionId() << 24, [], 0, 0
        for batch in (whole.slice(at, most_texts) for whole in batches for at in range(0, whole.num_rows, most_texts)):
            batch = batch.filter(pc.and_(pc.is_valid(batch["unit"]), pc.greater(pc.list_value_length(batch["terms"]), 0)))
            if not batch.num_rows:
                continue
            words = batch["terms"].flatten().dictionary_encode()
            size, n = pc.list_value_length(batch["terms"]).to_numpy(), len(words.dictionary)
            text, code = np.repeat(np.arange(batch.num_rows), size), words.indices.to_numpy()
            given = np.repeat(np.asarray(pc.is_valid(batch["bits"])), size)
            pairs, counts = np.unique(text[~given] * n + code[~given], return_counts=True)
            text, code = np.append(pairs // n, text[given]), np.append(pairs % n, code[given])
            bits = np.append(np.frexp(counts)[1], batch["bits"].flatten().to_numpy(zero_copy_only=False))
            if held and (texts + batch.num_rows > most_texts or postings + len(text) > most_postings):
                yield packed(number, held)
                number, held, texts, postings = number + 1, [], 0, 0
            held.append((batch.select(["unit", "pool", "g"]), words.dictionary, text.astype(np.int32), code.astype(np.int32), bits.astype(np.uint8)))
            texts, postings = texts + batch.num_rows, postings + len(text)
        if held:
            yield packed(number, held)

    lists = [T.StructField(f"{c}s", T.ArrayType(rows.schema[c].dataType)) for c in ("unit", "pool", "g")]
    out = T.StructType([T.StructField("pack", T.LongType()), *lists, *T.StructType.fromDDL("terms array<string>, often array<int>, places binary, bits binary")])
    return rows.mapInArrow(pack, out)


class _Places:
    """Where the texts of a pack stand: the i-th in order is ``i % GROUP`` of its group, and places with the same number in their groups lie together."""

    def __init__(self, n: int):
        self.n, self.groups = n, -(-n // GROUP)
        self.size = self.groups * GROUP

    def of(self, at: np.ndarray) -> np.ndarray:
        return at % GROUP * self.groups + at // GROUP

    def at(self, place: np.ndarray) -> np.ndarray:
        return place % self.groups * GROUP + place // self.groups


def _frequent(often: np.ndarray, n: int) -> np.ndarray:
    by_n = np.argsort(-often, kind="stable")[:MOST_FREQUENT]
    return by_n[often[by_n] * FREQUENT >= n]


def _finished(packs: DataFrame) -> DataFrame:
    """Packs as they are searched: texts in the order in which alike ones lie together, terms and postings by their numbers.

    packs: ``PACKED`` without the terms but ``known``, of each term its place there, number and rarity. at and pool_at are a text's and its pool's
    places by key, and square that of its length.
    """

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (pa.Table.from_batches([batch.slice(i, 1)]) for batch in batches for i in range(batch.num_rows)):
            known, often = _column(row, "known"), _column(row, "often").to_numpy()
            code, t, rarity = (x.to_numpy() for x in known.flatten())
            postings, starts, n = int(often.sum()), np.cumsum(often) - often, len(_column(row, "units"))
            at = _summed(_unsqueezed(row["places"], postings, np.uint32), starts, often)
            bits = _unsqueezed(row["bits"], postings, np.uint8)
            named, rare = np.empty(len(often), np.int64), np.empty(len(often), np.int64)
            order = np.argsort(t)
            named[code[order]], rare[code] = np.arange(len(often)), rarity
            weight = np.repeat(rare.astype(np.float64), often)
            weight *= bits
            weight *= weight
            square = np.bincount(at, weight, n)
            frequent = _frequent(often, n)
            share, has = np.zeros(n), np.zeros((-(-max(1, len(frequent)) // 64) * 64, n), bool)
            for i, term in enumerate(frequent):
                here = slice(starts[term], starts[term] + often[term])
                has[i, at[here]] = True
                share[at[here]] += weight[here]
            del weight
            share = (SHARES * np.sqrt(share / square)).astype(np.int64)
            alike = np.packbits(has, axis=0).reshape(-1, 8, n)  # a number of 64 bits for as many terms, the most frequent first
            alike = [np.ascontiguousarray(x.T).view(">u8").ravel() for x in alike]
            keys = [_column(row, c) for c in ("units", "pools", "gs")]
            own = np.lexsort((square, *alike[::-1], share, _ranks(keys[2])))
            place = np.empty(n, np.int64)
            place[own] = _Places(n).of(np.arange(n))
            unit, pool = _ranks(keys[1], keys[0])[own], _ranks(keys[1])[own]
            moved = np.repeat(named, often)
            moved <<= 24
            moved |= place[at]
            moved <<= 8
            moved |= bits
            moved.sort()
            often = often[code[order]]
            apart = _apart(moved >> 8 & 0xFFFFFF, np.cumsum(often) - often)
            own = pa.array(own)
            arrays = [row["pack"].combine_chunks(), *(_list(key.take(own)) for key in keys)]
            arrays += [_list(x) for x in (unit, pool, square.astype(np.int64)[own], t[order], rarity[order], often.astype(np.int32))]
            arrays += [_squeezed(apart), _squeezed((moved & 0xFF).astype(np.uint8))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kept = [packs.schema[c] for c in PACKED[:4]]
    more = "at array<long>, pool_at array<long>, square array<long>, terms array<long>, rarities array<long>, often array<int>, places binary, bits binary"
    out = T.StructType([*kept, *T.StructType.fromDDL(more)])
    names = out.names
    return packs.mapInArrow(finish, out)


def _together(rows: DataFrame, again: DataFrame) -> DataFrame:
    """``rows`` with those of a ``key`` that is among ``again`` as one text for each of these; only such rows travel."""
    told = mark(rows.where("unit is not null"), again, "key", "maybe")
    maybe = told.where("maybe").drop("maybe")
    once = told.where("not maybe").drop("maybe").unionByName(maybe.join(again, "key", "left_anti"))
    words = maybe.join(again, "key", "left_semi").select("key", F.explode("terms").alias("term"))
    counted = words.groupBy("key", "term").agg(_bits(F.count("*")).alias("bits"))
    joined = counted.groupBy("key").agg(F.collect_list(F.struct("term", "bits")).alias("held"))
    return once.drop("key").unionByName(joined.select("key.*", F.col("held.term").alias("terms"), F.col("held.bits").alias("bits")))


def build(texts: DataFrame, unit: str, text: str, pool: str | None = None, group: str | None = None) -> TextIndex:
    """The index of ``text`` by ``unit``, a key of ``texts``. ``pool`` names what the best of several units stands for, by
    default the unit, and ``group`` a value that queries may ask for. A null or wordless text is not in it.

    ``texts`` is read several times, to count its rows and to cut them into words. Rows alike in unit, pool and group are one text."""
    small_batches(texts.sparkSession)
    rows = texts.select(
        F.col(unit).alias("unit"), F.col(pool or unit).alias("pool"), (F.col(group) if group else F.lit(0)).alias("g"),
        terms_of(F.col(text)).alias("terms"), F.lit(None).cast("array<int>").alias("bits"),
    )
    cores = texts.sparkSession.sparkContext.defaultParallelism
    keyed = rows.withColumn("key", F.struct("unit", "pool", "g"))
    keys = keyed.groupBy("key").agg(F.count("*").alias("n"))
    several = (F.col("n") > 1) & F.col("key.unit").isNotNull()
    n, repeated = keys.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(several)).first()
    lost = rows.where("unit is null").select("pool", "g", F.explode("terms").alias("term")).distinct()
    if repeated:
        rows = _together(keyed, cut(keys.where(several).select("key")))
    blocks = max(1, -(-n // BLOCK_TEXTS), min(cores, -(-n // LEAST_TEXTS)))
    packs = _stored(_packed(rows.coalesce(blocks)))
    terms = packs.select("pack", F.posexplode(F.arrays_zip("terms", "often")).alias("code", "held")).select(
        "pack", "code", F.col("held.terms").alias("term"), F.col("held.often").cast("long").alias("n")
    )
    often = terms.select("term", "n")
    if rows.schema["unit"].nullable:  # texts without a key are not found, but their words are less rare for it
        often = often.unionByName(lost.select("term", F.lit(1).cast("long").alias("n")))
    rarity = F.round(RARITY * F.log(1 + F.lit(float(n)) / F.col("n"))).cast("long")
    rare = cut(often.groupBy("term").agg(F.sum("n").alias("n")).select("term", rarity.alias("rarity"), F.monotonically_increasing_id().alias("t")))
    known = terms.join(rare, "term").groupBy("pack").agg(F.collect_list(F.struct("code", "t", "rarity")).alias("known"))
    return TextIndex(cut(_finished(packs.drop("terms").join(known, "pack"))), rare, blocks, rows.schema["g"].dataType)


def _questions(index: TextIndex, queries: DataFrame, query_id: str, text: str, group: str | None) -> DataFrame:
    """``q, wanted, long, terms, asks``: a query's known terms with their weights, and the square of its length."""
    wanted = F.col(group) if group else F.lit(None).cast(index.group)
    asked = queries.select(F.col(query_id).alias("q"), wanted.alias("wanted"), F.explode(terms_of(F.col(text))).alias("term"))
    counted = asked.where("q is not null").groupBy("q", "wanted", "term").agg(_bits(F.count("*")).cast("long").alias("bits"))
    known = counted.join(index.rarities, "term").withColumn("ask", F.col("bits") * F.col("rarity"))
    whole = known.groupBy("q", "wanted").agg(
        F.sum(F.col("ask") * F.col("ask")).alias("long"), F.collect_list(F.struct("t", "ask")).alias("held")
    ).where("long > 0")
    return whole.select("q", "wanted", "long", F.col("held.t").alias("terms"), F.col("held.ask").alias("asks"))


def _best(scored: DataFrame, k: int) -> DataFrame:
    """The best unit of each pool, and of those the ``k`` best of each query; ties by the smaller key."""
    inside = Window.partitionBy("q", "pool").orderBy(F.desc("score"), "unit")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "pool")
    best = scored.withColumn("first", F.row_number().over(inside)).where("first = 1").drop("first")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# --- scores ---


class _Block:
    """A finished pack: its postings by term, and beside them how many bits its frequent terms have, as a matrix of terms by places."""

    def __init__(self, row: pa.Table):
        self.units, self.pools, self.gs, at, pool, square, terms, rarity, often = (
            _column(row, c) for c in ("units", "pools", "gs", "at", "pool_at", "square", "terms", "rarities", "often")
        )
        self.terms, self.rarity, self.often = terms.to_numpy(), rarity.to_numpy().astype(np.float64), often.to_numpy()
        n, postings = len(self.units), int(self.often.sum())
        self.starts = np.cumsum(self.often) - self.often
        self.places = _Places(n)
        place = _summed(_unsqueezed(row["places"], postings, np.uint32), self.starts, self.often)
        self.bits = _unsqueezed(row["bits"], postings, np.uint8)
        own = self.places.of(np.arange(n))
        self.at, self.pool, self.root = np.zeros(self.places.size, np.int64), np.zeros(self.places.size, np.int64), np.ones(self.places.size)
        self.at[own], self.pool[own], self.root[own] = at.to_numpy(), pool.to_numpy(), np.sqrt(square.to_numpy().astype(np.float64))
        self.single = self.pool.max(initial=-1) == n - 1
        self.inverse = np.zeros(self.places.size, np.float32)  # 0 where no text is
        self.inverse[own] = 1 / self.root[own]
        frequent = _frequent(self.often, n)
        self.column = np.full(len(self.terms), -1)
        self.column[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), self.places.size), np.uint8)
        self.greatest = np.zeros((len(frequent), self.places.groups), np.float32)  # bits of a group's text over its length
        share = np.zeros(self.places.size)
        for i, term in enumerate(frequent):
            here = slice(self.starts[term], self.starts[term] + self.often[term])
            self.dense[i, place[here]] = self.bits[here]
            self.greatest[i] = self._peaks(self.dense[i] * self.inverse)
            share[place[here]] += (self.bits[here] * self.rarity[term]) ** 2
        self.share = (np.sqrt(share) * self.inverse).astype(np.float32)  # of a text's length, what is frequent
        self.shares = self._peaks(self.share)
        self.part = self.bits * self.inverse[place]  # of a posting, over its text's length
        self.key = np.repeat(np.arange(len(self.terms)) * self.places.size, self.often)
        self.key += place  # ascending

    def _peaks(self, values: np.ndarray) -> np.ndarray:
        return values.reshape(GROUP, -1).max(0)

    def summed(self, terms: np.ndarray, asks: np.ndarray) -> np.ndarray:
        """What the terms add to each text's cosine, about."""
        parts = [slice(a, a + n) for a, n in zip(self.starts[terms].tolist(), self.often[terms].tolist())]
        place = np.concatenate([self.key[x] for x in parts])
        place -= np.repeat(terms * self.places.size, self.often[terms])
        part = np.concatenate([self.part[x] for x in parts])
        part *= np.repeat(asks.astype(np.float32), self.often[terms])
        return np.bincount(place, part, self.places.size)

    def whole(self, place: np.ndarray, terms: np.ndarray, asks: np.ndarray) -> np.ndarray:
        """The sums of whole numbers that cosines are made of."""
        often = self.column[terms] >= 0
        dot = asks[often] @ self.dense[self.column[terms[often]][:, None], place]
        key = (terms[~often] * self.places.size)[:, None] + place
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return dot + asks[~often] @ np.where(self.key[at] == key, self.bits[at], 0)

    def kth(self, place: np.ndarray, score: np.ndarray, k: int) -> float:
        """The k-th best score of different pools; 0 if there are fewer."""
        if self.single:
            return np.partition(score, len(score) - k)[len(score) - k] if len(score) >= k else 0.0
        order = np.argsort(-score, kind="stable")
        first = np.sort(np.unique(self.pool[place[order]], return_index=True)[1])
        return score[order[first[k - 1]]] if len(first) >= k else 0.0

    def best(self, which: np.ndarray, place: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best text of each pool, and of those the ``k`` best of each query; ties by key."""
        order = np.lexsort((self.at[place], -score, which))
        which, place, score = which[order], place[order], score[order]
        first = np.sort(np.unique(which * (self.places.n + 1) + self.pool[place], return_index=True)[1])
        which, place, score = which[first], place[first], score[first]
        kept = np.arange(len(which)) - np.searchsorted(which, which) < k
        return which[kept], place[kept], score[kept]


def _scorer(k: int, first: int, grouped: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Scores queries ``q, wanted, long, terms, asks, floor`` by a pack. floor: what a text's score must reach to be of interest."""

    def score(asks: pa.Table, pack: pa.Table) -> pa.Table:
        block = _Block(pack)
        groups, slots = block.places.groups, np.arange(GROUP)[:, None] * block.places.groups
        shares = block.share.reshape(GROUP, groups)
        sizes = pc.list_value_length(asks["terms"]).to_numpy()
        terms, weights = (asks[c].combine_chunks().flatten().to_numpy() for c in ("terms", "asks"))
        term = np.minimum(np.searchsorted(block.terms, terms), len(block.terms) - 1)
        known = block.terms[term] == terms
        row, term, weight = np.repeat(np.arange(len(sizes)), sizes)[known], term[known], weights[known].astype(np.float64)
        column, ask = block.column[term], weight * block.rarity[term]
        length, floor = np.sqrt(asks["long"].to_numpy().astype(np.float64)), asks["floor"].to_numpy()
        edges = np.searchsorted(row, np.arange(len(sizes) + 1))
        low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), block.places.n)
        if grouped:
            values = block.gs.dictionary_encode()
            own = values.indices.fill_null(-1).to_numpy(zero_copy_only=False)  # alike ones lie together
            wanted, free = asks["wanted"].combine_chunks(), np.asarray(pc.is_null(asks["wanted"]))
            code = pc.index_in(wanted, value_set=values.dictionary).fill_null(-2).to_numpy(zero_copy_only=False)
            held, starts, counts = np.unique(own, return_index=True, return_counts=True)
            at = np.minimum(np.searchsorted(held, code), len(held) - 1)
            low = np.where(free, low, np.where(held[at] == code, starts[at], 0))
            high = np.where(free, high, np.where(held[at] == code, starts[at] + counts[at], 0))

        def found(i: int, bound: np.ndarray, part: float) -> tuple[np.ndarray, np.ndarray]:
            """The places of query ``i`` that may be of interest, with their scores; bound: of the groups, by what is frequent."""
            here = slice(edges[i], edges[i + 1])
            rarer, limit = column[here] < 0, max(floor[i] - SLACK, 1e-30)
            rare = block.summed(term[here][rarer], ask[here][rarer] / length[i]).reshape(GROUP, groups) if rarer.any() else None
            total = bound if rare is None else bound + rare.max(0)
            asked = (ask[here][~rarer] / length[i]).astype(np.float32)
            used = column[here][~rarer]

            def rough(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                """Places of the groups that may reach the limit, and their scores, about."""
                most = np.minimum(part * shares[:, group], bound[group])
                place = slots + group
                if rare is not None:
                    most = most + rare[:, group]
                if grouped:
                    at = block.places.at(place)
                    most = np.where((at >= low[i]) & (at < high[i]), most, -1)
                place = place[most >= limit]
                score = asked @ block.dense[used[:, None], place] * block.inverse[place]
                return place, score if rare is None else score + rare.ravel()[place]

            if floor[i] <= 0:  # nothing is known of the query yet: the likeliest texts tell what can be ruled out
                most = max(1, first // GROUP)
                group = np.argpartition(total, -most)[-most:] if most < groups else np.arange(groups)
                place, score = rough(group[total[group] >= limit])
                limit = max(limit, block.kth(place, score, k) - 2 * SLACK)
            place, score = rough(np.flatnonzero(total >= limit))
            place, score = place[score >= limit], score[score >= limit]
            place = place[score >= block.kth(place, score, k) - 2 * SLACK]
            return place, block.whole(place, term[here], ask[here]) / (length[i] * block.root[place])

        parts, step = [], max(1, CELLS_AT_ONCE // groups)
        for start in range(0, len(sizes), step):
            rows = min(step, len(sizes) - start)
            here = slice(edges[start], edges[start + rows])
            often = column[here] >= 0
            at, by = row[here][often] - start, column[here][often]
            asked, part = np.zeros((rows, len(block.dense)), np.float32), np.zeros(rows)
            asked[at, by] = ask[here][often] / length[start + at]
            part = np.sqrt(np.bincount(at, weight[here][often] ** 2, rows)) / length[start : start + rows]
            bound = asked @ block.greatest
            np.minimum(bound, part.astype(np.float32)[:, None] * block.shares, out=bound)
            if grouped:
                for i in np.flatnonzero(~free[start : start + rows]).tolist():
                    bound[i, : low[start + i] // GROUP] = -np.inf
                    bound[i, -(-high[start + i] // GROUP) :] = -np.inf
            limit = np.maximum(floor[start : start + rows] - SLACK, 1e-30)
            likely = (bound >= limit[:, None]).any(1)
            likely[row[here][~often] - start] = True
            for i in np.flatnonzero(likely).tolist():
                place, scores = found(start + i, bound[i], float(part[i]))
                some = (scores > 0) & (scores >= floor[start + i])
                parts.append((np.full(some.sum(), start + i), place[some], scores[some]))
        parts.append((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)))
        which, place, scores = block.best(*(np.concatenate(x) for x in zip(*parts)), k)
        at, which = pa.array(block.places.at(place)), pa.array(which)
        arrays = [which, asks["q"].take(which), block.pools.take(at), block.units.take(at), pa.array(scores)]
        return pa.table(arrays, names=["row", "q", "pool", "unit", "score"])

    return score


def _merged(best: pa.Table | None, found: pa.Table, k: int) -> pa.Table:
    """The best unit of each pool, and of those the ``k`` best of each query; ties by key."""
    table = found if best is None else pa.concat_tables([best, found])
    row, score = table["row"].to_numpy(), table["score"].to_numpy()
    pools, units = (table[c].combine_chunks() for c in ("pool", "unit"))
    pool, unit = _ranks(pools), _ranks(units)
    order = np.lexsort((unit, -score, pool, row))
    first = np.append(True, (row[order][1:] != row[order][:-1]) | (pool[order][1:] != pool[order][:-1]))[: len(order)]
    order = order[first]
    order = order[np.lexsort((pool[order], -score[order], row[order]))]
    return table.take(pa.array(order[np.arange(len(order)) - np.searchsorted(row[order], row[order]) < k]))


def _blocks(questions: DataFrame) -> DataFrame:
    """A row for each partition: ``block`` and the questions' columns as lists."""

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            arrays = [_list(table[c].combine_chunks()) for c in names]
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), *arrays], names=["block", *(f"all_{c}" for c in names)])

    names = questions.columns
    lists = [T.StructField(f"all_{c}", T.ArrayType(questions.schema[c].dataType)) for c in names]
    return questions.mapInArrow(block, T.StructType([T.StructField("block", T.LongType()), *lists]))


def search(
    index: TextIndex, queries: DataFrame, k: int, *, query_id: str, text: str = "text", group: str | None = None
) -> DataFrame:
    """``q, pool, unit, score, rank``: the ``k`` pools nearest to each query, with the unit that speaks for each.

    Only texts that share a term with the query are found. ``group`` names a column of the queries: where
    it is set, only texts of that group are ranked.
    """
    small_batches(queries.sparkSession)
    questions = cut(_questions(index, queries, query_id, text, group))
    asked, tasks = questions.count(), TASKS_PER_CORE * queries.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-asked // BLOCK_QUERIES), min(tasks, -(-asked // LEAST_ASKED)))
    runs = min(index.blocks, -(-tasks // parts))
    names, score = questions.columns, _scorer(k, FIRST_TEXTS, group is not None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asks: dict[int, pa.Table] = {}
        best: dict[int, pa.Table] = {}
        floors: dict[int, np.ndarray] = {}
        for row in (pa.Table.from_batches([batch.slice(i, 1)]) for batch in batches for i in range(batch.num_rows)):
            block = row["block"][0].as_py()
            if block not in asks:
                asks[block] = pa.table([_column(row, f"all_{c}") for c in names], names=names)
                floors[block] = np.zeros(asks[block].num_rows)
            found = score(asks[block].append_column("floor", pa.array(floors[block])), row)
            best[block] = _merged(best.get(block), found, k)
            which = best[block]["row"].to_numpy()
            last = np.flatnonzero(np.arange(len(which)) - np.searchsorted(which, which) == k - 1)
            floors[block][which[last]] = best[block]["score"].to_numpy()[last]
        for table in best.values():
            yield from table.select(["q", "pool", "unit", "score"]).combine_chunks().to_batches(max_chunksize=10_000)

    out = T.StructType([
        T.StructField("q", questions.schema["q"].dataType), T.StructField("pool", index.units.schema["pools"].dataType.elementType),
        T.StructField("unit", index.units.schema["units"].dataType.elementType), T.StructField("score", T.DoubleType()),
    ])
    blocks = cut(_blocks(questions.repartition(parts)))
    pairs = index.units.coalesce(runs).crossJoin(blocks.hint("shuffle_replicate_nl"))
    return _best(pairs.mapInArrow(run, out), k).select("q", "pool", "unit", "score", "rank")


# --- passages ---


def passages(texts: DataFrame, pk: str, text: str, words: int = PASSAGE_WORDS, stride: int = STRIDE) -> DataFrame:
    """``texts`` without ``text``, a row for each passage: ``passage`` (its first word's number, from 0), ``n_words`` and ``body``.

    A passage is ``words`` words, the next starts ``stride`` words on, and the last ends with the text; a shorter text
    is one. Words are parted by white space, and a passage has single spaces. A text without words has none.
    """
    parts = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), BETWEEN_WORDS), lambda w: w != "")
    rows = texts.withColumn("_words", parts).where(F.size("_words") > 0)
    last = F.greatest(F.lit(0), F.ceil((F.size("_words") - words) / stride)).cast("int")
    cut_up = rows.withColumn("passage", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: i * stride)))
    held = F.slice("_words", F.col("passage") + 1, F.lit(words))
    return cut_up.withColumn("n_words", F.size(held)).withColumn("body", F.array_join(held, " ")).select(
        *[c for c in texts.columns if c != text], "passage", "n_words", "body"
    )

"""Top-k similarity search of a table of queries over a table of vectors.

Similarity is the cosine, computed in double and taken to nine decimals, so that copies tie; ties go
to the smaller key. Vectors without a direction (null, empty, all zeros) are not searchable.

The index is laid out in the cells of a tree of pivots (``pivots``), and the cells in packs of bounded size. A query leaves out
the children of the root, and inside a pack the cells, that cannot hold one of its k nearest; what remains is an
equality join of queries and packs, by one plan however many queries there are. A query travels once to a pack, whatever
it visits there, so what moves does not grow with the number of cells. A block of queries and a pack hand on
the k best rows per query, never their pairs. ``ann`` has the approximate search.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscope.operators.pivots import PLACES, Tree, grow, packs, reached, shelf_of, widened
from subscope.operators.vectors import SLACK, matrix, packed, schema_with, slices, unit
from subscope.settings import cut
from subscope.sources.tables import read_table, write_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERY_ROWS = 65536  # queries of a block at most
LEAST_ASKED, TASKS_PER_CORE = 256, 2  # of fewer packs than cores, queries are parted further, but not below so many
LEAST_ROWS, MOST_ROWS = 2048, 32768  # rows of a cell, by the size of the index
PACK_BYTES = 1 << 24  # of the vectors of a pack
GROUP = 16
SCORES_AT_ONCE = 1 << 23

Score = Callable[[pa.Table, pa.Table], pa.Table]


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    pk: str,
    query_id: str,
    vector: str = "embedding",
    match: str | None = None,
    where: Column | None = None,
    block_rows: int | None = None,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, pk, score, rank`` of the ``k`` nearest index rows of every query.

    ``where`` filters the index before ranking. ``match`` names a column of both sides: a query with
    a value there ranks only index rows with that value, a query without one ranks them all.
    """
    if where is not None:
        index = index.where(where)

    def hits(asked: DataFrame, on: str | None) -> DataFrame:
        layout = lay_out(index, pk, vector, on, k, block_rows)
        return _visit(layout, queries_of(asked, query_id, vector, on), k, block_rows, query_rows)

    if match is None:
        return ranked(hits(queries, None), k, query_id, pk)
    bound, free = queries.where(F.col(match).isNotNull()), queries.where(F.col(match).isNull())
    return ranked(hits(bound, match).unionByName(hits(free, None)), k, query_id, pk)


def ranked(hits: DataFrame, k: int, query_id: str, pk: str) -> DataFrame:
    best = Window.partitionBy("q").orderBy(F.desc("score"), "pk")
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select(F.col("q").alias(query_id), F.col("pk").alias(pk), "score", "rank")
    )


@dataclass(frozen=True)
class Layout:
    """An index in the cells of a tree, ``g`` being the value of ``match``, for up to ``k`` results per query."""

    tree: Tree
    block_rows: int
    pk: str
    match: str | None
    k: int


def lay_out(
    index: DataFrame, pk: str, vector: str = "embedding", match: str | None = None, k: int = 10,
    block_rows: int | None = None, cell_rows: int | None = None,
) -> Layout:
    """The index in cells of up to ``cell_rows`` rows, by default those of a pack, if ``block_rows`` names them, or a sixty-fourth of the index."""
    group = F.col(match) if match else F.lit(0)
    rows = index.select(
        F.col(pk).alias("pk"), group.alias("g"), F.col(vector).cast("array<float>").alias("v")
    ).where(F.col("g").isNotNull() & (F.size("v") > 0))
    directed = rows.mapInArrow(_with_direction, schema_with(rows.schema))
    # Of equal vectors only the k smallest keys can ever be returned.
    copies = Window.partitionBy("g", "v").orderBy("pk")
    kept = cut(directed.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k).drop("copy"))
    if block_rows is None:
        n, width = kept.agg(F.count("*"), F.max(F.octet_length("v"))).first()
        cell_rows = cell_rows or min(MOST_ROWS, max(LEAST_ROWS, n // 64))
        block_rows = max(1, PACK_BYTES // (width or 1))
    return Layout(grow(kept, cell_rows or block_rows), block_rows, pk, match, k)


def _with_direction(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        vectors = matrix(batch.column("v"))
        _, good = unit(vectors)
        columns = {name: batch.column(name) for name in batch.schema.names}
        yield pa.RecordBatch.from_pydict({**columns, "v": packed(vectors)}).filter(pa.array(good))


def queries_of(queries: DataFrame, query_id: str, vector: str, match: str | None) -> DataFrame:
    """``q, g, v`` of the queries with a direction."""
    # one group for all is a number that no optimizer folds into the plan, so joins on it stay equalities
    group = F.col(match) if match else F.pmod(F.xxhash64(query_id), F.lit(1)).cast("int")
    asks = queries.select(
        F.col(query_id).alias("q"), group.alias("g"), F.col(vector).cast("array<float>").alias("v")
    ).where(F.size("v") > 0)
    return asks.mapInArrow(_with_direction, schema_with(asks.schema))


def store_layout(layout: Layout, path: str) -> None:
    """Write a layout, a folder for each child of the root, so that a search reads those it visits and no others."""
    tree = layout.tree
    if tree.cells.isEmpty():
        raise ValueError("the index has no searchable row to store")
    write_table(tree.cells.withColumn("shelf", shelf_of()), f"{path}/cells", partition_by=["shelf"])
    write_table(tree.tops, f"{path}/tops")
    for i, level in enumerate(tree.levels):
        write_table(level, f"{path}/level{i}")
    about = [(layout.pk, layout.match, layout.k, layout.block_rows, len(tree.levels))]
    write_table(
        tree.cells.sparkSession.createDataFrame(about, "pk string, match string, k int, block_rows int, levels int"), f"{path}/about"
    )


def open_layout(spark: SparkSession, path: str) -> Layout:
    about = read_table(spark, f"{path}/about").first()
    levels = tuple(read_table(spark, f"{path}/level{i}") for i in range(about["levels"]))
    tree = Tree(read_table(spark, f"{path}/cells"), levels, read_table(spark, f"{path}/tops"))
    return Layout(tree, about["block_rows"], about["pk"], about["match"], about["k"])


def search_layout(
    layout: Layout, queries: DataFrame, k: int, query_id: str, vector: str = "embedding", query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``search`` over an index laid out before. Its ``match`` column applies: a query with a value
    there ranks only the rows with that value, and one without finds nothing."""
    if k > layout.k:
        raise ValueError(f"the layout was made for {layout.k} results, not {k}")
    asks = queries_of(queries, query_id, vector, layout.match)
    return ranked(_visit(layout, asks, k, layout.block_rows, query_rows), k, query_id, layout.pk)


def _visit(layout: Layout, asks: DataFrame, k: int, block_rows: int | None, query_rows: int) -> DataFrame:
    return meet(layout, asks, layout.tree.cells.select("pk", "g", "v", "cell"), k, scorer(k), block_rows, query_rows)


def meet(
    layout: Layout, asks: DataFrame, cells: DataFrame, k: int, score: Score, block_rows: int | None = None, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """``q, pk, score`` of what ``score`` makes of each block of queries and each pack that they may have to visit.

    asks: ``q, g, v``; cells: ``pk, g, cell`` and what ``score`` reads of a row. Rows of a pack come with its cells, as rows that have ``n``.
    A query goes to a pack once, however many of its cells it visits there.
    """
    few = F.broadcast if layout.match is None else (lambda small: small)  # a group has few cells and fewer packs
    held = cut(packs(layout.tree, block_rows or layout.block_rows))
    visits = cut(reached(layout.tree, held, asks, k, layout.match is None))
    load = cut(visits.groupBy("g", "pack").agg(F.count("*").alias("asked")))
    spread = -(-TASKS_PER_CORE * visits.sparkSession.sparkContext.defaultParallelism // max(1, load.count()))
    blocks = F.greatest(F.ceil(F.col("asked") / query_rows), F.least(F.lit(spread), F.ceil(F.col("asked") / LEAST_ASKED))).cast("int")
    load = load.select("g", "pack", blocks.alias("blocks"))
    if "shelf" in layout.tree.cells.columns:  # a stored layout: at most FAN + 1 folders, and those not visited are not read
        dealt = held.select("g", shelf_of().alias("shelf"), F.explode(F.sequence("first", "last")).alias("pack"))
        visited = [r["shelf"] for r in dealt.join(load, ["g", "pack"]).select("shelf").distinct().collect()]
        cells = cells.where(layout.tree.cells["shelf"].isin(visited))
    key, told = ["g", "pack", "block"], [c for c in cells.columns if c not in ("g", "pk", "cell")]
    left = visits.join(few(load), ["g", "pack"]).withColumn("block", F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int")).select(
        *key, "q", "v", "reach"
    )
    dealt = F.pmod(F.xxhash64("pk"), F.col("last") - F.col("first") + 1).cast("int")
    none = [F.lit(None).cast(cells.schema[c].dataType).alias(c) for c in ("pk", *told)]
    about = ["n", "radius", "tilt", "pivot", "total"]
    rows = cells.join(few(held.select("g", "cell", "first", "last")), ["g", "cell"]).select(
        "g", (F.col("first") + dealt).alias("pack"), "cell", "pk", *told, *[F.lit(None).cast(held.schema[c].dataType).alias(c) for c in about]
    )
    heads = held.select("g", F.explode(F.sequence("first", "last")).alias("pack"), "cell", *none, *about)
    right = rows.unionByName(heads).join(few(load), ["g", "pack"]).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).drop("blocks")
    out = T.StructType([
        T.StructField("q", visits.schema["q"].dataType), T.StructField("pk", cells.schema["pk"].dataType),
        T.StructField("score", T.DoubleType()),
    ])
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(score, out)


def hits_of(asks: pa.Table, rows: pa.Table, which: np.ndarray, at: np.ndarray, scores: np.ndarray) -> pa.Table:
    return pa.table([asks["q"].take(pa.array(which)), rows["pk"].take(pa.array(at)), pa.array(scores)], names=["q", "pk", "score"])


def no_hits(asks: pa.Table, rows: pa.Table) -> pa.Table:
    return pa.table([asks["q"].slice(0, 0), rows["pk"].slice(0, 0), pa.array([], pa.float64())], names=["q", "pk", "score"])


class Pack:
    """The rows of a pack by cell, those of a cell by key, and its cells; ``rank`` is a row's place by key alone."""

    def __init__(self, rows: pa.Table):
        heads = rows.filter(pc.is_valid(rows["n"])).sort_by("cell")
        self.rows = rows.filter(pc.is_null(rows["n"])).sort_by([("cell", "ascending"), ("pk", "ascending")])
        self.rank = np.empty(self.rows.num_rows, np.int64)
        self.rank[pc.sort_indices(self.rows["pk"]).to_numpy()] = np.arange(self.rows.num_rows)
        cells = heads["cell"].to_numpy()
        own = self.rows["cell"].to_numpy()
        self.starts, self.ends = np.searchsorted(own, cells), np.searchsorted(own, cells, side="right")
        self.n, self.radius, self.tilt = (heads[c].to_numpy() for c in ("n", "radius", "tilt"))
        self.total = heads["total"][0].as_py() if heads.num_rows else 0
        pivots = heads["pivot"].combine_chunks()
        self.placed = np.asarray(pc.is_valid(pivots))
        self.pivots = unit(matrix(pivots.drop_null()))[0]  # of the placed

    def angles(self, left: np.ndarray) -> np.ndarray:
        """To each cell's pivot; infinite for a cell without one."""
        out = np.full((len(left), len(self.n)), np.inf)
        if self.placed.any():
            out[:, self.placed] = np.arccos(np.clip(left @ self.pivots.T, -1.0, 1.0))
        return out

    def scores(self, left: np.ndarray, right: np.ndarray, visits: np.ndarray, into: np.ndarray | None = None) -> np.ndarray:
        """Each query's scores with the rows of the cells that it visits, and -2 or what was there before with the others.
        Where most are visited, all are scored."""
        if visits.mean() > 0.5:
            return left @ right.T
        out = np.full((len(left), len(right)), -2, np.float32) if into is None else into
        for cell in np.flatnonzero(visits.any(0)):
            who, here = np.flatnonzero(visits[:, cell]), slice(self.starts[cell], self.ends[cell])
            out[who, here] = left[who] @ right[here].T
        return out


def scorer(k: int) -> Score:
    def score(asks: pa.Table, rows: pa.Table) -> pa.Table:
        pack = Pack(rows)
        rows = pack.rows
        if not asks.num_rows or not rows.num_rows:
            return no_hits(asks, rows)
        left, right = unit(matrix(asks["v"]))[0], unit(matrix(rows["v"]))[0]
        reach, single = asks["reach"].to_numpy(), right.astype(np.float32)
        parts, step = [], max(1, SCORES_AT_ONCE // len(right))
        for start in range(0, len(left), step):
            some = left[start : start + step]
            away = pack.angles(some)
            # the pivots of a pack's cells are different rows, so they bound the k-th score as those of the root do
            kth = np.partition(away, k - 1, axis=1)[:, k - 1] if away.shape[1] >= k else np.full(len(some), np.pi)
            within = np.minimum(reach[start : start + step], widened(np.minimum(kth, np.pi)))
            visits = np.isinf(away) | (away - pack.radius - SLACK <= within[:, None])
            rough = pack.scores(some.astype(np.float32), single, visits)
            which, at, scores = best_of(rough, some, right, min(k, len(right)), k, pack.rank)
            parts.append((which + start, at, scores))
        return hits_of(asks, rows, *(np.concatenate(x) for x in zip(*parts)))

    return score


def at_least(rough: np.ndarray, k: int) -> np.ndarray:
    """For each row a value that ``k`` of its numbers reach, near the k-th greatest: that of the greatest of groups of columns."""
    wide = rough.shape[1] // GROUP
    if wide < 4 * k:
        return np.partition(rough, rough.shape[1] - k, axis=1)[:, -k]
    tops = rough[:, : wide * GROUP].reshape(len(rough), GROUP, wide).max(1)
    return np.partition(tops, wide - k, axis=1)[:, -k]


def best_of(
    rough: np.ndarray, left: np.ndarray, right: np.ndarray, few: int, k: int, rank: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best rows of ``right`` for each row of ``left``, as pairs of positions with scores; ties by ``rank``.

    Single precision decides who is in question, ``few`` of them at least, double precision among those.
    """
    error = (left.shape[1] + 4) * np.finfo(np.float32).eps + 10.0**-PLACES
    floor = np.maximum(at_least(rough, few) - np.float32(2 * error), np.float32(-1.5))  # what was not scored is below
    which, at = np.nonzero(rough >= floor[:, None])
    scores = np.round(np.einsum("ij,ij->i", left[which], right[at]), PLACES) + 0.0
    order = np.lexsort((rank[at], -scores, which))
    which, at, scores = which[order], at[order], scores[order]
    place = np.arange(len(which)) - np.searchsorted(which, which)
    kept = place < k
    return which[kept], at[kept], scores[kept]


def recall(found: DataFrame, exact: DataFrame, query_id: str, pk: str) -> DataFrame:
    """``n_expected, n_found, recall`` of an approximate result against the exact one."""
    marked = exact.select(query_id, pk).join(
        found.select(query_id, pk, F.lit(1).alias("hit")), [query_id, pk], "left"
    )
    return marked.agg(
        F.count("*").alias("n_expected"),
        F.count("hit").alias("n_found"),
        (F.count("hit") / F.count("*")).alias("recall"),
    )

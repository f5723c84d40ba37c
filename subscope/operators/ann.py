"""Approximate top-k search: residual product codes in the cells of a pivot tree, probed as far as it pays.

A row's code stands for what its vector differs from its cell's pivot by, in pieces of a few dimensions, each
the number of the nearest of 256 centroids. Queries are scored with what the codes stand for, in the cells that they
visit; the best of a pack of cells are scored again with the vectors themselves, so scores are exact and only a hit can be missed.
How many cells a query visits depends on what it has found in the pack: cells are left out while the hits
expected in all of them together stay under a share of k. A pack hands on k rows per query.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.operators.knn import SCORES_AT_ONCE, Layout, Pack, Score, at_least, hits_of, lay_out, meet, no_hits, queries_of, ranked
from subscope.operators.pivots import PLACES, expected_in
from subscope.operators.vectors import matrix, packed, slices, unit
from subscope.settings import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 8192  # rows, at most, that the centroids are fitted on
PIECE = 4  # dimensions of a piece
CENTROIDS = 256
STEPS = 8  # of k-means
TARGET = 0.98  # share of a query's hits that the cells it visits are expected to hold
AGAIN = 24  # rows scored exactly for each hit wanted
CLOSE = 128  # of a pack's rows, one in so many is scored exactly at least: as many more lie between the hits as there are rows
LEAST_CELL, MOST_CELL = 256, 32768


@dataclass(frozen=True)
class Codes:
    """A layout with ``pk, g, cell, code, v`` of its rows, the centroids of each piece, and how many dimensions the residuals fill."""

    layout: Layout
    cells: DataFrame
    books: np.ndarray
    dimensions: float


def encode(
    index: DataFrame, pk: str, vector: str = "embedding", match: str | None = None, k: int = 10, sample: int = SAMPLE,
    cell_rows: int | None = None,
) -> Codes:
    """The index laid out and coded, every row of it. Centroids are fitted on ``sample`` rows in the order of a hash."""
    if cell_rows is None:
        cell_rows = min(MOST_CELL, max(LEAST_CELL, int(index.count() ** 0.5)))
    layout = lay_out(index, pk, vector, match, k, cell_rows=cell_rows)
    tree = layout.tree
    leaves = [
        level.select("g", F.explode("children").alias("c")).where("c.leaf").select("g", F.col("c.child").alias("cell"), F.col("c.v").alias("pivot"))
        for level in tree.levels
    ]
    # rows in a group of one cell have no pivot: they differ from nothing
    told = tree.cells.withColumn("pivot", F.lit(None).cast("binary"))
    if leaves:
        told = tree.cells.join(reduce(DataFrame.unionByName, leaves), ["g", "cell"], "left")
    drawn = told.orderBy(F.xxhash64("pk"), "pk").limit(sample).select("v", "pivot").toArrow()
    books, dimensions = _fit(_residuals(drawn["v"], drawn["pivot"]))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            rest = _residuals(batch.column("v"), batch.column("pivot"))
            found = np.stack([_closest(rest[:, i * PIECE : (i + 1) * PIECE], book) for i, book in enumerate(books)], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("pk"), batch.column("g"), batch.column("cell"), packed(found.astype(np.uint8)), batch.column("v")],
                names=["pk", "g", "cell", "code", "v"],
            )

    kinds = ", ".join(f"{c} {tree.cells.schema[c].dataType.simpleString()}" for c in ("pk", "g", "cell"))
    return Codes(layout, cut(told.mapInArrow(code, f"{kinds}, code binary, v binary")), books, dimensions)


def _residuals(vectors: pa.Array | pa.ChunkedArray, pivots: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Directions less those of their pivots, in whole pieces."""
    if isinstance(pivots, pa.ChunkedArray):
        pivots = pivots.combine_chunks()
    out, _ = unit(matrix(vectors))
    some = np.flatnonzero(np.asarray(pc.is_valid(pivots)))
    if len(some):
        out[some] -= unit(matrix(pivots.drop_null()))[0]
    return np.pad(out, ((0, 0), (0, -out.shape[1] % PIECE)))


def _closest(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (rows @ book.T - (book**2).sum(1) / 2).argmax(1)


def _fit(rest: np.ndarray) -> tuple[np.ndarray, float]:
    """Centroids of each piece by k-means, and the effective number of dimensions of the residuals."""
    draw = np.random.default_rng(1)
    pieces = max(1, rest.shape[1] // PIECE)
    books = np.zeros((pieces, CENTROIDS, PIECE))
    if not len(rest):
        return books, 1.0
    for i in range(pieces):
        part = rest[:, i * PIECE : (i + 1) * PIECE]
        book = part[draw.permutation(len(part))[np.arange(CENTROIDS) % len(part)]].copy()
        for _ in range(STEPS):
            own = _closest(part, book)
            n = np.bincount(own, minlength=CENTROIDS)
            for d in range(PIECE):
                total = np.bincount(own, weights=part[:, d], minlength=CENTROIDS)
                book[:, d] = np.where(n > 0, total / np.maximum(n, 1), book[:, d])
        books[i] = book
    spread = np.linalg.eigvalsh(np.cov(rest.T)) if len(rest) > 1 else np.ones(1)
    return books, float(spread.sum() ** 2 / max((spread**2).sum(), 1e-30))


def search(
    index: DataFrame, queries: DataFrame, k: int, *, pk: str, query_id: str, vector: str = "embedding",
    match: str | None = None, target: float = TARGET, **options,
) -> DataFrame:
    """``query_id, pk, score, rank`` of about the ``k`` nearest rows of every query; a query without a value of
    ``match`` finds nothing. Null, empty and zero vectors are neither found nor find anything."""
    return search_codes(encode(index, pk, vector, match, k, **options), queries, k, query_id, vector, target)


def search_codes(
    codes: Codes, queries: DataFrame, k: int, query_id: str, vector: str = "embedding", target: float = TARGET, again: int = AGAIN
) -> DataFrame:
    """``search`` in an index coded before."""
    layout = codes.layout
    asks = queries_of(queries, query_id, vector, layout.match)
    score = _decoder(codes.books, k, k * again, target, codes.dimensions)
    return ranked(meet(layout, asks, codes.cells, k, score), k, query_id, layout.pk)


def _decoder(books: np.ndarray, k: int, wanted: int, target: float, dimensions: float) -> Score:
    """The ``k`` best rows of a pack for each query, of the ``wanted`` best by the vectors that the codes stand for.

    The nearest cells, of as many rows as are wanted, are visited first; of the others those are left out, the least
    promising first, that are expected to hold no more hits together than the pack's share of what may be missed.
    """

    def score(asks: pa.Table, rows: pa.Table) -> pa.Table:
        pack = Pack(rows)
        rows = pack.rows
        if not asks.num_rows or not rows.num_rows:
            return no_hits(asks, rows)
        exact, left = unit(matrix(rows["v"]))[0], unit(matrix(asks["v"]))[0]
        code = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(rows.num_rows, -1)
        right = np.concatenate([book[code[:, i]] for i, book in enumerate(books)], 1).astype(np.float32)[:, : exact.shape[1]]
        for pivot, cell in zip(pack.pivots, np.flatnonzero(pack.placed)):
            right[pack.starts[cell] : pack.ends[cell]] += pivot.astype(np.float32)
        missed = (1 - target) * k * len(right) / max(pack.total, 1)
        parts, step = [], max(1, SCORES_AT_ONCE // len(right))
        for start in range(0, len(left), step):
            some = left[start : start + step]
            single, away = some.astype(np.float32), pack.angles(some)
            order = np.argsort(away, axis=1, kind="stable")
            held = (pack.ends - pack.starts)[order]
            first = np.zeros(away.shape, bool)
            np.put_along_axis(first, order, held.cumsum(1) - held < wanted, 1)
            rough = pack.scores(single, right, first)
            floor = np.maximum(at_least(rough, min(k, len(right))), -1.0)[:, None]
            hits = np.where(first, np.inf, expected_in(away, pack.radius, pack.tilt, pack.n, floor, dimensions))
            order = np.argsort(hits, axis=1, kind="stable")
            more = np.zeros(away.shape, bool)
            np.put_along_axis(more, order, np.take_along_axis(hits, order, 1).cumsum(1) > missed, 1)
            if first.mean() <= 0.5:  # else all have been scored
                rough = pack.scores(single, right, first | more) if (first | more).mean() > 0.5 else pack.scores(single, right, more & ~first, rough)
            few = min(max(wanted, len(right) // CLOSE), len(right))
            which, at = np.nonzero(rough >= np.maximum(at_least(rough, few), np.float32(-1.5))[:, None])
            scores = np.round(np.einsum("ij,ij->i", some[which], exact[at]), PLACES) + 0.0
            best = np.lexsort((pack.rank[at], -scores, which))
            which, at, scores = which[best], at[best], scores[best]
            kept = np.arange(len(which)) - np.searchsorted(which, which) < k
            parts.append((start + which[kept], at[kept], scores[kept]))
        return hits_of(asks, rows, *(np.concatenate(x) for x in zip(*parts)))

    return score

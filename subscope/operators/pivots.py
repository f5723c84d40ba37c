"""A tree of pivots over a table of vectors, and the descent of a table of queries through it.

A node with too many rows takes some of them as pivots, every row goes to the nearest, and the children are
treated alike, level by level, for all nodes of a level together. Nodes, rows and queries meet in
joins: nothing that grows with the rows is collected or sent to every task.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscope.operators.vectors import SLACK, angles, matrix, packed, schema_with, slices, unit
from subscope.settings import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PLACES = 9  # decimals of a score
FAN = 32  # children of a node at most
LEVELS = 6  # of the tree; larger cells are searched in blocks all the same
SLICE_ROWS = 65536  # rows of a node that one task sends to its children

ROOT = 0


@dataclass(frozen=True)
class Tree:
    """cells: ``pk, g, v, cell, angle`` of every row, angle being that to the pivot of its cell.

    levels: for each level of inner nodes, ``g, node, children``, an array of ``child, leaf, n, radius, tilt, v``; tilt is
    the mean cosine to the child's pivot. A child's number is ``node * FAN + 1 + i``. tops: ``g, n`` of the groups that are one cell.
    """

    cells: DataFrame
    levels: tuple[DataFrame, ...]
    tops: DataFrame


def grow(rows: DataFrame, cell_rows: int, levels: int = LEVELS, fan: int = FAN) -> Tree:
    """The tree over ``pk, g, v``, v being the bytes of a vector with a direction; ``g`` has a tree for each value.

    A node's pivots are rows in the order of a hash of their vectors, different ones, as many as it takes
    cells of ``cell_rows`` rows but no more than ``fan``. A node without two different vectors isn't split.
    """
    key = ["g", "node"]
    placed = rows.withColumn("node", F.lit(ROOT).cast("long")).withColumn("angle", F.lit(np.pi))
    sizes = cut(placed.groupBy(*key).agg(F.count("*").alias("n")))
    tops, done, made = sizes.drop("node"), [], []
    for _ in range(levels):
        large = sizes.where(F.col("n") > cell_rows)
        if large.isEmpty():
            break
        wanted = F.least(F.lit(fan), F.ceil(F.col("n") / cell_rows)).cast("int")
        asked = placed.join(large.withColumn("wanted", wanted), key)
        order = Window.partitionBy(*key).orderBy("hash", "pk")
        drawn = asked.select(*key, "v", "wanted", "pk", F.xxhash64("v").alias("hash")).withColumn(
            "place", F.row_number().over(order)
        ).where(F.col("place") <= 2 * fan)
        vectors = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("place", "v"))), lambda s: s["v"]))
        split = drawn.groupBy(*key).agg(F.first("wanted").alias("wanted"), vectors.alias("pivots"))
        split = cut(split.where(F.size("pivots") > 1).select(*key, F.slice("pivots", F.lit(1), F.col("wanted")).alias("pivots")))
        if not made:
            tops = tops.join(split.select("g"), "g", "left_anti")
        inside = split.select(*key).withColumn("inner", F.lit(True))
        told = placed.join(inside, key, "left")
        done.append(told.where("inner is null").drop("inner"))
        slices_ = F.ceil(F.col("n") / SLICE_ROWS).cast("int")
        parts = split.join(sizes.select(*key, slices_.alias("slices")), key)
        parts = parts.select(*[F.col(c).alias(c) for c in parts.columns])  # columns of its own, to be grouped beside the rows
        left = told.where("inner").drop("inner", "angle").join(parts.select(*key, "slices"), key).withColumn(
            "slice", F.pmod(F.xxhash64("pk"), F.col("slices")).cast("int")
        ).drop("slices")
        right = parts.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
        by = [*key, "slice"]
        kinds = T.StructType([f for f in placed.schema.fields])
        placed = cut(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_nearest(fan, placed.columns), kinds))
        below = cut(placed.groupBy(*key).agg(
            F.count("*").alias("n"), F.max("angle").alias("radius"), F.avg(F.cos("angle")).alias("tilt")
        ))
        numbered = split.select("g", F.col("node").alias("parent"), F.posexplode("pivots").alias("i", "v")).select(
            "g", "parent", (F.col("parent") * fan + 1 + F.col("i")).alias("node"), "v"
        )
        made.append(numbered.join(below, key))
        sizes = below.select(*key, "n")
    cells = reduce(DataFrame.unionByName, [*done, placed]).withColumnRenamed("node", "cell")
    inner = [m.select("g", F.col("parent").alias("node"), F.lit(False).alias("leaf")).distinct() for m in made[1:]]
    nodes = []
    for i, level in enumerate(made):
        leaf = F.lit(True)
        if i < len(inner):
            level, leaf = level.join(inner[i], key, "left"), F.coalesce("leaf", F.lit(True))
        child = F.struct(F.col("node").alias("child"), leaf.alias("leaf"), "n", "radius", "tilt", "v")
        nodes.append(cut(level.groupBy("g", F.col("parent").alias("node")).agg(F.array_sort(F.collect_list(child)).alias("children"))))
    return Tree(cells, tuple(nodes), tops)


def _nearest(fan: int, names: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def assign(rows: pa.Table, nodes: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table([rows[c] if c in rows.column_names else pa.array([], pa.float64()) for c in names], names=names)
        pivots, _ = unit(matrix(nodes["pivots"].combine_chunks().flatten()))
        first = nodes["node"][0].as_py() * fan + 1
        chosen, away = [], []
        for part in slices(iter(rows.combine_chunks().to_batches())):
            units, _ = unit(matrix(part.column("v")))
            turn = angles(units, pivots)
            at = turn.argmin(1)
            chosen.append(first + at)
            away.append(turn[np.arange(len(at)), at])
        own = {"node": pa.array(np.concatenate(chosen)), "angle": pa.array(np.concatenate(away))}
        return pa.table([own[c] if c in own else rows[c] for c in names], names=names)

    return assign


def shelf_of(cell: str = "cell") -> Column:
    """The child of the root that a cell lies under: a number up to ``FAN``, or ``ROOT`` of a group that is one cell."""
    at = F.col(cell)
    for _ in range(LEVELS):
        at = F.when(at > FAN, F.floor((at - 1) / FAN)).otherwise(at)
    return at.cast("int")


def packs(tree: Tree, rows: int) -> DataFrame:
    """``g, cell, n, radius, tilt, pivot, total, first, last``: every cell, and the packs of about ``rows`` rows that its
    rows are dealt to. total: the rows of the group. A group that is one cell has no pivot."""
    cells = tree.tops.select(
        "g", F.lit(ROOT).cast("long").alias("cell"), F.col("n").cast("long").alias("n"), F.lit(np.pi).alias("radius"),
        F.lit(0.0).alias("tilt"), F.lit(None).cast("binary").alias("pivot"),
    )
    for level in tree.levels:
        child = level.select("g", F.explode("children").alias("c")).where("c.leaf")
        cells = cells.unionByName(child.select("g", F.col("c.child").alias("cell"), "c.n", "c.radius", "c.tilt", F.col("c.v").alias("pivot")))
    whole = Window.partitionBy("g")
    upto = F.sum("n").over(whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    return cells.withColumns({"total": F.sum("n").over(whole), "upto": upto}).withColumns({
        "first": F.floor((F.col("upto") - F.col("n")) / rows).cast("int"), "last": F.floor((F.col("upto") - 1) / rows).cast("int"),
    }).drop("upto")


def reached(tree: Tree, held: DataFrame, asks: DataFrame, k: int, few_groups: bool) -> DataFrame:
    """``q, g, v, reach, pack``: the packs with rows under a child of the root that can hold one of a query's ``k`` nearest.

    held: ``packs``; reach: the angle that no row beyond can be among them. A query is looked at once, beside all children of its root.
    """
    shelves = held.select("g", shelf_of().alias("shelf"), F.explode(F.sequence("first", "last")).alias("pack")).groupBy("g", "shelf").agg(
        F.collect_set("pack").alias("packs")
    )
    children = tree.tops.select("g", F.lit(ROOT).alias("shelf"), F.lit(np.pi).alias("radius"), F.lit(None).cast("binary").alias("pivot"))
    for level in tree.levels[:1]:
        child = level.select("g", F.explode("children").alias("c"))
        children = children.unionByName(child.select("g", F.col("c.child").cast("int").alias("shelf"), "c.radius", F.col("c.v").alias("pivot")))
    roots = cut(children.join(shelves, ["g", "shelf"]).groupBy("g").agg(F.collect_list(F.struct("radius", "pivot", "packs")).alias("children")))
    met = asks.join(F.broadcast(roots) if few_groups else roots, "g")
    return met.mapInArrow(_reached(k), schema_with(asks.select("q", "g", "v").schema, ("reach", T.DoubleType()), ("pack", T.IntegerType())))


def _reached(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            held, vectors = batch.column("children"), matrix(batch.column("v"))
            children = held.flatten()
            rows = np.repeat(np.arange(batch.num_rows), np.diff(held.offsets.to_numpy()))
            angle = angles_to(unit(vectors)[0], rows, children.field("pivot"))
            reach = reach_of(angle, rows, batch.num_rows, k)
            near = np.isinf(angle) | (angle - children.field("radius").to_numpy() - SLACK <= reach[rows])
            of = children.field("packs")
            sizes = np.diff(of.offsets.to_numpy())
            pairs = np.stack([np.repeat(rows, sizes), of.flatten().to_numpy()], 1)[np.repeat(near, sizes)]
            pairs = np.unique(pairs, axis=0)
            which = pa.array(pairs[:, 0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("q").take(which), batch.column("g").take(which), packed(vectors[pairs[:, 0]]), pa.array(reach[pairs[:, 0]]),
                 pa.array(pairs[:, 1].astype(np.int32))], names=["q", "g", "v", "reach", "pack"],
            )

    return look


def angles_to(units: np.ndarray, rows: np.ndarray, pivots: pa.Array) -> np.ndarray:
    """The angle of the ``rows``-th direction to each pivot; infinite where there is none, as it bounds nothing."""
    out = np.full(len(rows), np.inf)
    some = np.flatnonzero(np.asarray(pc.is_valid(pivots)))
    if len(some):
        at, _ = unit(matrix(pivots.drop_null()))
        out[some] = np.arccos(np.clip(np.einsum("ij,ij->i", units[rows[some]], at), -1.0, 1.0))
    return out


def reach_of(angle: np.ndarray, rows: np.ndarray, n: int, k: int) -> np.ndarray:
    """Of each of ``n`` queries, the k-th least angle to a pivot, widened for what rounds to the same score; pi where there are fewer."""
    order = np.lexsort((angle, rows))
    place = np.arange(len(order)) - np.searchsorted(rows[order], rows[order])
    kth = np.full(n, np.pi)
    at = order[place == k - 1]
    kth[rows[at]] = np.minimum(angle[at], np.pi)
    return widened(kth)


def widened(kth: np.ndarray) -> np.ndarray:
    return np.arccos(np.maximum(-1.0, np.cos(kth) - 2 * 10.0**-PLACES)) + SLACK


Keep = Callable[[DataFrame], DataFrame]

_SEEN = (
    ("child", T.LongType()), ("leaf", T.BooleanType()), ("n", T.LongType()), ("radius", T.DoubleType()),
    ("tilt", T.DoubleType()), ("angle", T.DoubleType()),
)


def descend(tree: Tree, asks: DataFrame, keep: Keep) -> DataFrame:
    """``q, g, v, child, n, radius, tilt, angle``: the cells (``child``) that each query visits.

    asks: ``q, g, v``. ``keep`` is given what the queries see on a level, the children of the nodes they are at, and
    returns the rows that they go on to. A group that is one cell is visited by all its queries.
    """
    columns = ["q", "g", "v", *(name for name, _ in _SEEN)]
    whole = asks.join(tree.tops, "g").select(
        "q", "g", "v", F.lit(ROOT).cast("long").alias("child"), F.lit(True).alias("leaf"), F.col("n").cast("long").alias("n"),
        F.lit(np.pi).alias("radius"), F.lit(0.0).alias("tilt"), F.lit(np.pi / 2).alias("angle"),
    )
    visits, at = [whole], asks.withColumn("node", F.lit(ROOT).cast("long"))
    for level in tree.levels:
        met = at.join(level, ["g", "node"]).drop("node")
        seen = met.mapInArrow(_look, schema_with(met.drop("children").schema, *_SEEN))
        kept = keep(seen).select(*columns)
        visits.append(kept.where("leaf"))
        at = kept.where("not leaf").select("q", "g", "v", F.col("child").alias("node"))
    return reduce(DataFrame.unionByName, visits)


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each query and child of its node, with the angle to the child's pivot."""
    for batch in slices(batches, 256):
        held = batch.column("children")
        children = held.flatten()
        rows = np.repeat(np.arange(batch.num_rows), np.diff(held.offsets.to_numpy()))
        asked, _ = unit(matrix(batch.column("v")))
        pivots, _ = unit(matrix(children.field("v")))
        away = np.arccos(np.clip(np.einsum("ij,ij->i", asked[rows], pivots), -1.0, 1.0))
        which = pa.array(rows)
        columns = {name: batch.column(name).take(which) for name in batch.schema.names if name != "children"}
        columns["v"] = packed(matrix(batch.column("v"))[rows])
        columns |= {name: children.field(name) for name, _ in _SEEN if name != "angle"}
        yield pa.RecordBatch.from_pydict({**columns, "angle": pa.array(away)})


def within_reach(k: int) -> Keep:
    """Keeps the nodes that can hold one of a query's ``k`` nearest rows.

    The pivots are rows themselves, different ones on a level, so the angle of the k-th nearest (widened for
    what rounds to the same score) is reached by no node whose rows are all farther.
    """

    def keep(seen: DataFrame) -> DataFrame:
        order = Window.partitionBy("q", "g").orderBy("angle")
        whole = Window.partitionBy("q", "g")
        kth = F.max(F.when(F.col("place") == k, F.col("angle"))).over(whole)
        reach = F.acos(F.greatest(F.lit(-1.0), F.cos("kth") - 2 * 10.0**-PLACES)) + SLACK
        marked = seen.withColumn("place", F.row_number().over(order)).withColumn("kth", kth)
        return marked.where(F.col("kth").isNull() | (F.col("angle") - F.col("radius") - SLACK <= reach))

    return keep


def likely(k: int, target: float, dimensions: float) -> Keep:
    """Keeps the nodes that hold all but ``1 - target`` of the ``k`` rows expected beyond the k-th pivot's score."""

    def keep(seen: DataFrame) -> DataFrame:
        order = Window.partitionBy("q", "g").orderBy("angle")
        whole = Window.partitionBy("q", "g")
        kth = F.max(F.when(F.col("place") == k, F.cos("angle"))).over(whole)
        marked = seen.withColumn("place", F.row_number().over(order)).withColumn("floor", F.coalesce(kth, F.lit(-1.0)))
        return enough(marked, "floor", k, target, dimensions)

    return keep


def expected_hits(floor: Column, dimensions: float) -> Column:
    """How many of a node's ``n`` rows may score above ``floor``.

    Rows lie around the node's pivot at a mean cosine ``tilt``, in directions of so many dimensions, so their scores
    are about normal. The logistic function stands for the normal distribution.
    """
    dot = F.cos("angle")
    spread = F.sqrt(F.greatest(F.lit(1e-9), (1 - F.col("tilt") ** 2) * (1 - dot**2) / max(dimensions - 1, 1.0)))
    z = (floor - F.col("tilt") * dot) / spread
    odds = 1.5976 * z + 0.07056 * z**3
    return F.when(F.col("angle") - F.col("radius") > F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), floor))) + SLACK, F.lit(0.0)).otherwise(
        F.col("n") / (1 + F.exp(F.least(odds, F.lit(700.0))))
    )


def enough(seen: DataFrame, floor: str, k: int, target: float, dimensions: float) -> DataFrame:
    """The nodes without those, the least promising first, in which at most ``(1 - target) * k`` hits are expected in all."""
    least = Window.partitionBy("q", "g").orderBy("hits", F.desc("angle"), "child").rowsBetween(Window.unboundedPreceding, 0)
    told = seen.withColumn("hits", expected_hits(F.col(floor), dimensions))
    return told.withColumn("missed", F.sum("hits").over(least)).where(F.col("missed") > (1 - target) * k).drop("hits", "missed")


def expected_in(
    angle: np.ndarray, radius: np.ndarray, tilt: np.ndarray, n: np.ndarray, floor: np.ndarray, dimensions: float
) -> np.ndarray:
    """``expected_hits`` of queries (rows) in cells (columns); all of a cell's rows where it has no pivot."""
    dot = np.where(np.isinf(angle), 0.0, np.cos(np.minimum(angle, np.pi)))
    spread = np.sqrt(np.maximum(1e-9, (1 - tilt**2) * (1 - dot**2) / max(dimensions - 1, 1.0)))
    z = (floor - tilt * dot) / spread
    odds = np.minimum(1.5976 * z + 0.07056 * z**3, 700.0)
    beyond = ~np.isinf(angle) & (angle - radius > np.arccos(np.clip(floor, -1.0, 1.0)) + SLACK)
    return np.where(np.isinf(angle), n, np.where(beyond, 0.0, n / (1 + np.exp(odds))))

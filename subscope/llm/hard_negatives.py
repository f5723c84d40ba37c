"""Hard negatives: rows that score nearly as high as an anchor's positives but carry another label.

Vectors are whole numbers and a score is their inner product. Candidates are laid out in cells around a
few pivots, cells in blocks of bounded size, and each block is a cover tree: a node's centre is a candidate,
and its radius covers all candidates below it. Vectors of a block get one more coordinate, which brings them
all to the length of the longest, so they lie on a sphere, where the angle to a centre and the
radius bound every inner product below a node from both sides. A search expands the nodes
with the highest bounds first and leaves those outside its windows of scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subscope.llm.stage import stored

SCALE = 256
LARGEST = 1 << 26  # components from here on, scaled, take no part: sums of products must stay whole numbers
POSITIVES, NEGATIVES = 5, 3
LOW_PERCENT, HIGH_PERCENT = 50, 95  # of the positive's score, between which a negative's lies

PIVOTS = 256  # at most, of a sample of as many rows
CELL_ROWS = 1024  # rows for each pivot, below that number of pivots
BLOCK_ROWS = 8192  # rows of a cover tree
QUERY_ROWS = 4096  # queries that meet a tree in one task
AT_ONCE = 256  # queries that descend a tree together
SHRINK = 0.7  # of a node's radius, which its children's may not exceed
FIRST = 16  # nodes a query expands in its first step; twice as many in each further one
SLACK = 1e-5  # radians by which bounds are widened, above any rounding

_NODE = "block int, node int, parent int, radius double, place int, fresh boolean"


def scaled(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``row, key, label, v``: the rows that take part, each component the floor of ``SCALE`` times it.

    Rows with a null label or vector, or with any component that is null, not finite or too large, are left out.
    """
    def usable(x: Column) -> Column:
        return F.coalesce(~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < LARGEST), F.lit(False))

    v = F.transform(F.col(vector), lambda x: F.when(usable(x), F.floor(x.cast("double") * SCALE)).cast("int"))
    whole = F.forall(F.col(vector), usable)
    named = rows.select(F.col(key).alias("key"), F.col(label).alias("label"), v.alias("v"), whole.alias("whole"))
    held = named.where("label is not null and v is not null and whole").drop("whole")
    return held.select(F.monotonically_increasing_id().alias("row"), "key", "label", "v")


def _matrix(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """The vectors as rows; a shorter one is as if it ended in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    width = max(1, int(sizes.max(initial=0))) if width is None else width
    out = np.zeros((len(column), width))
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    values = column.flatten().to_numpy(zero_copy_only=False)
    inside = at < width
    out[np.repeat(np.arange(len(column)), sizes)[inside], at[inside]] = values[inside]
    return out


def _windows(low: pa.ChunkedArray | pa.Array, high: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each query's windows side by side; where it has fewer than others, the last are empty."""
    held, ends = _matrix(low), _matrix(high)
    missing = np.arange(held.shape[1]) >= np.array([len(x) for x in low])[:, None]
    return np.where(missing, np.inf, held), np.where(missing, -np.inf, ends)


def _angles(scores: np.ndarray, length: np.ndarray, radius: float) -> np.ndarray:
    """Angles between queries of these lengths and points of the sphere, from their inner products."""
    most = length[:, None] * radius
    return np.arccos(np.clip(np.divide(scores, most, out=np.zeros_like(scores), where=most > 0), -1.0, 1.0))


# --- layout ---


@dataclass(frozen=True)
class Forest:
    """rows: ``row, key, label, v, cell, block``. nodes: the trees of the blocks, a row for each node, with the candidate at its centre.
    pivots and cells: the cells' centres, at most ``PIVOTS``, and ``cell, block, n`` of the blocks with bounds."""

    rows: DataFrame
    nodes: DataFrame
    pivots: np.ndarray
    cells: list


def plant(rows: DataFrame, pivots: int = PIVOTS, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> Forest:
    """Cover trees over all of ``rows`` (from ``scaled``, stored).

    The pivots are rows in the order of their hashes, at most ``pivots`` of them; every row goes to the pivot at
    the smallest angle, and cells of more than ``block_rows`` rows are cut by a hash.
    """
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    wanted = min(pivots, max(1, -(-n // cell_rows)))
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(wanted).select("v").toArrow()
    centres = _matrix(sample["v"], max(1, width or 1))
    lengths = np.sqrt((centres**2).sum(1))
    units = centres / np.where(lengths > 0, lengths, 1.0)[:, None]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                v = _matrix(part.column("v"), units.shape[1])
                length = np.sqrt((v**2).sum(1))
                angle = _angles(v @ units.T, length, 1.0)
                cell = angle.argmin(1)
                near = angle[np.arange(len(cell)), cell]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell.astype(np.int32)), pa.array(near), pa.array(length)],
                    names=[*part.schema.names, "cell", "angle", "length"],
                )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    placed = stored(rows.mapInArrow(assign, f"{kinds}, cell int, angle double, length double"))
    found = placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("angle").alias("radius"), F.max("length").alias("longest"), F.min("length").alias("shortest"),
    ).collect()  # a row for each pivot
    cells, block = [], 0
    for c in sorted(found):
        blocks = -(-c["n"] // block_rows)
        cells.append((c["cell"], block, blocks, c["radius"], c["longest"], c["shortest"]))
        block += blocks
    table = rows.sparkSession.createDataFrame([c[:3] for c in cells], "cell int, first int, blocks int")
    dealt = placed.drop("angle", "length").join(F.broadcast(table), "cell").withColumn(
        "block", (F.col("first") + F.pmod(F.xxhash64("row"), F.col("blocks"))).cast("int")
    ).drop("first", "blocks")
    kept = F.col("row"), F.col("key"), F.col("label"), F.col("v")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    nodes = stored(dealt.select("block", *kept).groupBy("block").applyInArrow(_grown, f"{_NODE}, {kinds}"))
    return Forest(dealt, nodes, units, cells)


def _grown(rows: pa.Table) -> pa.Table:
    """The cover tree of a block: nodes in the order of their levels, each with its centre's row."""
    v = _matrix(rows["v"])
    square = (v**2).sum(1)
    longest = float(square.max(initial=0.0))
    lift = np.sqrt(longest - square)  # the coordinate that brings every vector to the length of the longest
    points = np.concatenate([v, lift[:, None]], 1) / (np.sqrt(longest) or 1.0)

    def angles(centre: int, to: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(points[to] @ points[centre], -1.0, 1.0)) if longest else np.zeros(len(to))

    centre, parent, radius, fresh = [0], [-1], [0.0], [True]
    under = [np.arange(1, len(v))]
    at = 0
    while at < len(centre):  # nodes are appended behind, so parents come before their children
        rest, here = under[at], centre[at]
        if len(rest):
            away = angles(here, rest)
            radius[at] = float(away.max())
            limit = radius[at] * SHRINK
            first = True
            tried = gathered = 0
            while len(rest):
                # where a cover gathers hardly anything, every point is a child of its own
                if radius[at] <= SLACK / 10 or tried >= 32 and gathered < 2 * tried:
                    for j in rest.tolist():
                        centre.append(j), parent.append(at), radius.append(0.0), fresh.append(True), under.append(rest[:0])
                    break
                pick = here if first else int(rest[away.argmax()])  # the farthest is a centre next
                own = away if first else angles(pick, rest)
                near = own <= limit
                inside = rest[near] if first else rest[near & (rest != pick)]
                if len(inside) or not first:
                    centre.append(pick), parent.append(at), radius.append(0.0), fresh.append(not first), under.append(inside)
                gathered, tried = gathered + len(inside), tried + (not first)
                left = ~near if first else ~near & (rest != pick)
                rest, away = rest[left], away[left]
                first = False
        at += 1
    order = np.array(centre)
    names = ["block", "node", "parent", "radius", "place", "fresh"]
    made = [
        pa.array(np.full(len(order), rows["block"][0].as_py(), np.int32)), pa.array(np.arange(len(order), dtype=np.int32)),
        pa.array(np.array(parent, np.int32)), pa.array(np.array(radius)), pa.array(order.astype(np.int32)), pa.array(np.array(fresh)),
    ]
    own = rows.select(["row", "key", "label", "v"]).take(pa.array(order))
    return pa.table([*made, *own.columns], names=[*names, *own.column_names])


# --- search ---


class _Tree:
    """A block's nodes as arrays; ``kids[i]:kids[i + 1]`` are the children of node i."""

    def __init__(self, nodes: pa.Table):
        nodes = nodes.sort_by("node")
        self.table = nodes
        self.v = _matrix(nodes["v"])
        self.radius = nodes["radius"].to_numpy()
        self.fresh = nodes["fresh"].to_numpy(zero_copy_only=False)
        self.parent = nodes["parent"].to_numpy()
        self.kids = np.searchsorted(self.parent, np.arange(len(self.parent) + 1))
        self.longest = float(np.sqrt((self.v**2).sum(1).max()))
        labels = nodes["label"].combine_chunks().dictionary_encode()
        self.names = {x: i for i, x in enumerate(labels.dictionary.to_pylist())}
        self.label = labels.indices.to_numpy(zero_copy_only=False)
        # copies of a centre are not told apart by order, so ties go by the key, nulls last
        by_key = nodes.append_column("_at", pa.array(np.arange(nodes.num_rows))).sort_by([("key", "ascending"), ("row", "ascending")])
        self.rank = np.empty(nodes.num_rows, np.int64)
        self.rank[by_key["_at"].to_numpy()] = np.arange(nodes.num_rows)

    def search(self, q: np.ndarray, label: np.ndarray, row: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        """For each query and window: up to ``k`` nodes of the highest scores, as arrays of query, window, node, score.

        low and high: the windows of each query, from the score to beat or to equal to the highest wanted.
        """
        n, length = len(self.radius), np.sqrt((q**2).sum(1))
        scores = np.full((len(q), n), -np.inf)
        bound = np.full((len(q), n), -np.inf)  # of nodes that wait to be expanded
        low = low.copy()
        rows = self.table["row"].to_numpy()
        allowed = (self.label[None, :] == label[:, None]) == same
        allowed &= self.fresh[None, :] & (rows[None, :] != row[:, None])

        def see(which: np.ndarray, nodes: np.ndarray) -> None:
            """Scores and bounds of ``nodes`` for the queries ``which``."""
            found = q[which] @ self.v[nodes].T
            scores[np.ix_(which, nodes)] = found
            inner = self.radius[nodes] > 0
            inner |= self.kids[nodes + 1] > self.kids[nodes]
            if inner.any():
                angle = _angles(found[:, inner], length[which], self.longest)
                reach = self.radius[nodes[inner]] + SLACK
                most = (length[which] * self.longest)[:, None]
                top = most * np.cos(np.maximum(angle - reach, 0.0)) + 1e-3
                least = most * np.cos(np.minimum(angle + reach, np.pi)) - 1e-3
                open_ = _meets(low[which], high[which], least, top)
                bound[np.ix_(which, nodes[inner])] = np.where(open_, top, -np.inf)

        everyone = np.arange(len(q))
        see(everyone, np.array([0]))
        step = FIRST
        while True:
            active = np.flatnonzero((bound > -np.inf).any(1))
            if not len(active):
                break
            waiting = bound[active]
            if step < n:
                edge = np.partition(waiting, n - step, axis=1)[:, n - step]
                best = (waiting >= edge[:, None]) & (waiting > -np.inf)
            else:
                best = waiting > -np.inf
            for node in np.flatnonzero(best.any(0)).tolist():
                which = active[best[:, node]]
                bound[which, node] = -np.inf
                kids = np.arange(self.kids[node], self.kids[node + 1])
                see(which, kids)
            # what has been found raises the scores that the rest must reach
            ready = np.where(allowed[active], scores[active], -np.inf)
            for w in range(low.shape[1]):
                inside = np.where((ready >= low[active, w][:, None]) & (ready <= high[active, w][:, None]), ready, -np.inf)
                if n >= k:
                    low[active, w] = np.maximum(low[active, w], np.partition(inside, n - k, axis=1)[:, n - k])
            floor = np.where(low[active] <= high[active], low[active], np.inf).min(1)
            bound[active] = np.where(bound[active] >= floor[:, None], bound[active], -np.inf)
            step *= 2
        return self._best(np.where(allowed, scores, -np.inf), low, high, k)

    def _best(self, scores: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        parts = []
        for w in range(low.shape[1]):
            which, node = np.nonzero((scores >= low[:, w][:, None]) & (scores <= high[:, w][:, None]) & (scores > -np.inf))
            value = scores[which, node]
            order = np.lexsort((self.rank[node], -value, which))
            which, node, value = which[order], node[order], value[order]
            kept = np.arange(len(which)) - np.searchsorted(which, which) < k
            parts.append((which[kept], np.full(int(kept.sum()), w), node[kept], value[kept]))
        return tuple(np.concatenate(x) for x in zip(*parts))


def _meets(low: np.ndarray, high: np.ndarray, least: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Which of the ranges ``least, top`` meet a window of their query."""
    met = np.zeros(top.shape, bool)
    for w in range(low.shape[1]):
        met |= (top >= low[:, w][:, None]) & (least <= high[:, w][:, None]) & (low[:, w] <= high[:, w])[:, None]
    return met


def _descend(k: int, same: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def descend(asks: pa.Table, nodes: pa.Table) -> pa.Table:
        names = ["query", "window", "row", "key", "score"]
        if not asks.num_rows or not nodes.num_rows:
            none = pa.array([], pa.int64())
            return pa.table([none, none.cast(pa.int32()), none, nodes["key"].slice(0, 0), none], names=names)
        tree = _Tree(nodes)
        parts = []
        for start in range(0, asks.num_rows, AT_ONCE):
            part = asks.slice(start, AT_ONCE).combine_chunks()
            label = np.array([tree.names.get(x, -1) for x in part["label"].to_pylist()])
            low, high = _windows(part["low"], part["high"])
            which, window, node, score = tree.search(
                _matrix(part["v"], tree.v.shape[1]), label, part["query"].to_numpy(), low, high, k, same
            )
            own = tree.table.select(["row", "key"]).take(pa.array(node))
            parts.append(pa.table(
                [part["query"].take(pa.array(which)), pa.array(window.astype(np.int32)), own["row"], own["key"],
                 pa.array(score.astype(np.int64))], names=names,
            ))
        return pa.concat_tables(parts)

    return descend


def search(forest: Forest, asks: DataFrame, k: int, same: bool) -> DataFrame:
    """``query, window, row, key, score``: the ``k`` best rows of each query and window, of the same label or of others.

    asks, stored: ``query`` (a row number of the forest's rows, never its own result), ``label, v, low, high``, the
    two being lists with a window's least and highest score in each place. Two rounds: the nearest cell first, then, with the
    scores found there, every other cell whose bounds meet a window. A tree meets bounded parts of
    its queries in tasks of their own.
    """
    choose = _Cells(forest)
    first = asks.mapInArrow(choose.nearest, _visits(asks)).where(F.size("blocks") > 0)
    found = _visited(forest, stored(first), k, same)
    found = stored(_top(found, k))
    enough = found.groupBy("query", "window").agg(F.min("score").alias("score"), F.count("*").alias("n")).where(F.col("n") >= k)
    raised = enough.groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("raised"))
    again = asks.join(raised, "query", "left").withColumn("low", F.transform(
        "low", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("raised", i), x))
    )).select(*asks.columns)
    rest = stored(again.mapInArrow(choose.others, _visits(asks)).where(F.size("blocks") > 0))
    return _top(found.unionByName(_visited(forest, rest, k, same)), k)


def _visits(asks: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asks.schema) + ", blocks array<int>"


class _Cells:
    """Which blocks a query visits: those of its nearest cell, or of all others that can hold a result."""

    def __init__(self, forest: Forest):
        cells = forest.cells
        self.units = forest.pivots[[c[0] for c in cells]] if cells else forest.pivots[:0]
        self.blocks = [list(range(c[1], c[1] + c[2])) for c in cells]
        self.radius, self.longest, self.shortest = (np.array([c[i] for c in cells], float) for i in (3, 4, 5))

    def _visit(self, batches: Iterator[pa.RecordBatch], nearest: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                lists: list[list[int]] = [[] for _ in range(part.num_rows)]
                if self.blocks and part.num_rows:
                    q = _matrix(part.column("v"), self.units.shape[1])
                    length = np.sqrt((q**2).sum(1))
                    angle = _angles(q @ self.units.T, length, 1.0)
                    best = angle.argmin(1)
                    if nearest:
                        lists = [self.blocks[b] for b in best.tolist()]
                    else:
                        reach = self.radius + SLACK
                        near, far = np.cos(np.maximum(angle - reach, 0.0)), np.cos(np.minimum(angle + reach, np.pi))
                        # the longest vector of the cell where that helps the bound, the shortest where it hurts
                        top = length[:, None] * np.where(near > 0, self.longest, self.shortest) * near + 1e-3
                        least = length[:, None] * np.where(far > 0, self.shortest, self.longest) * far - 1e-3
                        low, high = _windows(part.column("low"), part.column("high"))
                        go = _meets(low, high, least, top)
                        go[np.arange(len(go)), best] = False
                        lists = [[b for c in np.flatnonzero(g).tolist() for b in self.blocks[c]] for g in go]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, pa.list_(pa.int32()))], names=[*part.schema.names, "blocks"])

    def nearest(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return self._visit(batches, True)

    def others(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return self._visit(batches, False)


def _visited(forest: Forest, visits: DataFrame, k: int, same: bool) -> DataFrame:
    """What the queries find in the blocks they visit; ``QUERY_ROWS`` of a block's queries or so are one task's."""
    each = visits.withColumn("block", F.explode("blocks")).drop("blocks")
    load = each.groupBy("block").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("parts"))
    asked = each.join(load, "block").withColumn("part", F.pmod(F.xxhash64("query"), F.col("parts")).cast("int"))
    nodes = forest.nodes.join(load, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    out = f"query long, window int, row long, key {forest.rows.schema['key'].dataType.simpleString()}, score long"
    left = asked.select("block", "part", "query", "label", "v", "low", "high").groupBy("block", "part")
    right = nodes.select("block", "part", "node", "parent", "radius", "fresh", "row", "key", "label", "v").groupBy("block", "part")
    return left.cogroup(right).applyInArrow(_descend(k, same), out)


def _top(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query", "window").orderBy(F.desc("score"), F.asc_nulls_last("key"), "row")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).drop("place")


def mine(
    rows: DataFrame, anchor: Column, *, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW_PERCENT, high: int = HIGH_PERCENT, **layout,
) -> DataFrame:
    """``anchor, positive, rank, negative, positive_score, negative_score`` of the rows that ``anchor`` holds for.

    An anchor's positives are its ``positives`` best other rows of its label, a positive's negatives the
    ``negatives`` best rows of other labels that score from ``low`` to ``high`` percent of it. Higher scores come first, ties by
    the smaller key, null last, and repeated rows by their place. ``anchor`` is a condition on the column named ``key``.

    Rows that ``scaled`` leaves out take no part. Rows are told apart by their place, so repeated keys are
    rows of their own, as anchors too; a row with a null key can be a result. A shorter vector counts as
    ending in zeros. An anchor without positives, or a positive without negatives, gives no rows, and neither does an empty table.
    """
    held = stored(scaled(rows, key, vector, label))
    forest = plant(held, **layout)
    chosen = held.withColumnRenamed("key", key).where(anchor).withColumnRenamed("row", "query")
    everything = F.array(F.lit(float("-inf"))), F.array(F.lit(float("inf")))
    asks = stored(chosen.select("query", F.col(key).alias("anchor"), "label", "v", everything[0].alias("low"), everything[1].alias("high")))
    found = search(forest, asks.drop("anchor"), positives, same=True)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"), "row")
    best = stored(found.select(
        "query", F.col("key").alias("positive"), F.col("score").alias("positive_score"), (F.row_number().over(order) - 1).alias("window")
    ))
    # in whole numbers: low * positive <= 100 * negative <= high * positive
    windows = best.select("query", F.struct(
        "window", (-_hundredth(-low * F.col("positive_score"))).alias("low"), _hundredth(high * F.col("positive_score")).alias("high")
    ).alias("w")).groupBy("query").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    wanted = asks.drop("low", "high", "anchor").join(windows, "query").select(
        "query", "label", "v", F.transform("ws", lambda w: w["low"]).alias("low"), F.transform("ws", lambda w: w["high"]).alias("high")
    )
    return _named(search(forest, stored(wanted), negatives, same=False), best, asks)


def _hundredth(x: Column) -> Column:
    """The greatest whole number up to a hundredth of ``x``."""
    return ((x - F.pmod(x, F.lit(100))) / 100).cast("double")


def _named(found: DataFrame, best: DataFrame, asks: DataFrame) -> DataFrame:
    order = Window.partitionBy("query", "window").orderBy(F.desc("score"), F.asc_nulls_last("key"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.join(best, ["query", "window"]).join(asks.select("query", "anchor"), "query").select(
        "anchor", "positive", "rank", F.col("key").alias("negative"), "positive_score", F.col("score").alias("negative_score")
    )

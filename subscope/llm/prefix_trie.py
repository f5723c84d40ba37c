"""The trie of all prefixes of a table of sequences, by the recursion of van Emde Boas.

Sequences are cut at half their depth. The prefixes up to the cut are named by a digest, the trie above
the cut and the forests below it are built alike, all of them in one job for each level of the recursion,
and then the totals of the forests are grafted onto the trie above, the smallest pieces first. So the
number of jobs grows with the logarithm of the greatest depth, and every element of a sequence is a row:
a sequence with a third of all elements is not one task's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.llm.stage import stored

IDS_AT_ONCE = 4096  # ends of a node that are joined to one piece of text


def _no_name() -> Column:
    return F.unhex(F.lit("")).alias("name")


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def ordered_turns(
    conversations: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """``seq, at, digest, weight`` of every turn, and ``seq, n`` of every conversation.

    at is the turn's place, from 0, by ``turn`` with null first; turns alike in that come by role, then by
    the digest of role and text, of which repeated rows have their own places. weight is the bytes of its text. A null role or text
    is empty; a null key belongs to no conversation.

    Rows are ranked by a sort of the whole table and a count for each of its partitions, so a conversation may
    lie in many of them. Only the columns named are read.
    """
    said, by = F.coalesce(text, F.lit("")), F.coalesce(role, F.lit(""))
    rows = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("seq"), F.col(turn).alias("turn"), by.alias("role"),
        _digest(F.encode(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said), "UTF-8")).alias("digest"),
        F.octet_length(said).cast("long").alias("weight"), F.monotonically_increasing_id().alias("tie"),
    )
    order = ["seq", "turn", "role", "digest", "tie"]
    ranked = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "seq", "digest", "weight", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
    ))
    before, total = [], 0
    for part, n in sorted(ranked.groupBy("part").count().collect()):  # a number for each partition of the sort
        before.append((part, total))
        total += n
    starts = ranked.sparkSession.createDataFrame(before, "part int, before long")
    numbered = ranked.join(starts, "part").withColumn("place", F.col("before") + F.col("place"))
    lengths = stored(numbered.groupBy("seq").agg(F.count("*").alias("n"), F.min("place").alias("first")))
    turns = numbered.join(lengths, "seq").select("seq", (F.col("place") - F.col("first")).alias("at"), "digest", "weight")
    return turns, lengths.select("seq", "n")


@dataclass(frozen=True)
class Trie:
    """nodes: ``name, seq, depth, parent, n_members, n_children, n_leaves, saved``, the root included; seq is
    the least member, parent that of the node above. ends: ``name, seq``, the node that each sequence ends at."""

    nodes: DataFrame
    ends: DataFrame


def trie(elements: DataFrame, sequences: DataFrame) -> Trie:
    """The trie of ``sequences`` (``seq``, distinct), whose elements are ``seq, depth, digest, weight``.

    depth counts from 1 without gaps. A node is a distinct run of first elements; its members are the
    sequences that start with it. n_leaves counts the childless nodes of its subtree, itself included, and
    saved sums ``(n_members - 1) * weight`` over it, weight being that of a node's last element. A sequence
    without elements ends at the root. Without sequences there are no nodes.
    """
    elements = stored(elements.select("seq", F.col("depth").cast("long").alias("depth"), "digest", "weight"))
    deepest = elements.agg(F.max("depth")).first()[0] or 0
    levels = max(0, int(deepest) - 1).bit_length()
    prefixes = _prefixes(elements, levels)

    nodes = prefixes.groupBy("name", "depth").agg(
        F.min("seq").alias("seq"), F.count("*").alias("n_members"), F.max("weight").alias("weight")
    )
    top = sequences.agg(F.min("seq"), F.count("*")).first()
    nodes = stored(_with_parents(stored(nodes), prefixes, top[0]))
    children = nodes.groupBy(F.col("parent").alias("seq"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["seq", "depth"], "left").select(
        "name", "depth", "seq", "parent", "n_members", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_members") - 1) * F.col("weight")).alias("saved"),
    )
    nodes = _grafted(stored(nodes), prefixes, levels)

    first = nodes.where("depth = 1").agg(F.count("*").alias("n"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"))
    root = first.where(F.lit(top[1] > 0)).select(
        _no_name(), F.lit(0).cast("long").alias("depth"), F.lit(top[0]).cast("long").alias("seq"),
        F.lit(None).cast("long").alias("parent"), F.lit(top[1]).cast("long").alias("n_members"), F.col("n").alias("n_children"),
        F.coalesce("leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved"),
    )
    last = elements.groupBy("seq").agg(F.max("depth").alias("depth"))
    ends = last.join(prefixes, ["seq", "depth"]).select("name", "seq").unionByName(
        sequences.select("seq").join(last, "seq", "left_anti").select(_no_name(), "seq")
    )
    return Trie(nodes.unionByName(root), ends)


def _prefixes(elements: DataFrame, levels: int) -> DataFrame:
    """``seq, depth, name, weight`` of every prefix of every sequence: equal names are equal prefixes.

    Runs of 2, 4, 8 .. elements get digests first. Then, from the cut at half depth to the single elements, a
    prefix up to a cut is named by the name of the prefix where its piece begins and the digest of the run between.
    """
    runs = [elements.select("seq", (F.col("depth") - 1).alias("block"), "digest", "weight")]
    for _ in range(levels):
        odd = F.col("block") % 2 == 1
        halves = runs[-1].groupBy("seq", F.shiftright("block", 1).alias("block")).agg(
            F.max(F.when(~odd, F.col("digest"))).alias("left"), F.max(F.when(odd, F.col("digest"))).alias("right"),
            F.max(F.when(odd, F.col("weight"))).alias("weight"),
        ).where("right is not null")
        runs.append(stored(halves.select("seq", "block", _digest(F.col("left"), F.col("right")).alias("digest"), "weight")))
    named: DataFrame | None = None
    for level in range(levels, -1, -1):
        cuts = runs[level].where(F.col("block") % 2 == 0).select(
            "seq", F.shiftleft("block", level).alias("low"), F.shiftleft(F.col("block") + 1, level).alias("depth"), "digest", "weight"
        )
        made = cuts.where("low = 0").select("seq", "depth", _digest(F.col("digest")).alias("name"), "weight")
        if named is not None:
            above = named.select("seq", F.col("depth").alias("low"), F.col("name").alias("above"))
            made = made.unionByName(cuts.where("low > 0").join(above, ["seq", "low"]).select(
                "seq", "depth", _digest(F.col("above"), F.col("digest")).alias("name"), "weight"
            ))
        made = stored(made)
        named = made if named is None else named.unionByName(made)
    return named


def _with_parents(nodes: DataFrame, prefixes: DataFrame, root: int | None) -> DataFrame:
    """With ``parent``, the least member of the node above; the root's is known, however many children it has."""
    above = prefixes.select("seq", (F.col("depth") + 1).alias("depth"), F.col("name").alias("above"))
    below = nodes.where("depth > 1").join(above, ["seq", "depth"])
    parents = nodes.select(F.col("name").alias("above"), F.col("seq").alias("parent"))
    return below.join(parents, "above").drop("above").unionByName(
        nodes.where("depth = 1").withColumn("parent", F.lit(root).cast("long"))
    )


def _grafted(nodes: DataFrame, prefixes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` with ``n_leaves`` and ``saved`` summed over their subtrees.

    After the round of a level, totals cover pieces of twice as many depths. A cut of that level lies at
    an odd multiple of its size: the nodes right under it are summed for each node at the cut, and that sum
    goes to all nodes between the piece's top and the cut on that node's way up, which its least member has.
    """
    for level in range(levels):
        cut = F.shiftright(F.col("depth") - 1, level)
        roots = nodes.where((F.col("depth") > 1) & (F.shiftleft(cut, level) == F.col("depth") - 1) & (cut % 2 == 1))
        forests = roots.groupBy(F.col("parent").alias("seq"), (cut - 1).alias("piece")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        ways = prefixes.select("seq", F.shiftright(F.col("depth") - 1, level).alias("piece"), "name")
        grafts = forests.join(ways, ["seq", "piece"]).groupBy("name").agg(
            F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved")
        )
        nodes = stored(nodes.join(grafts, "name", "left").withColumns({
            "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
            "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0)),
        }).drop("more_leaves", "more_saved"))
    return nodes


def ends_digest(ends: DataFrame) -> DataFrame:
    """``name, ends_sha256``: the hash of each node's ``seq`` in ascending order, with commas between.

    A hash is taken of one id after the other, so the ids of a node are sorted over many tasks and joined to
    pieces there, and one task sees the pieces, as a stream.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, ids = None, []
        for batch in batches:
            made = []
            for own, seq in zip(batch.column("name").to_pylist(), batch.column("seq").to_pylist()):
                if ids and (own != name or len(ids) == IDS_AT_ONCE):
                    made.append((name, ids[0], ",".join(map(str, ids))))
                    ids = []
                name = own
                ids.append(seq)
            if made:
                yield _rows(made)
        if ids:
            yield _rows([(name, ids[0], ",".join(map(str, ids)))])

    def _rows(made: list[tuple]) -> pa.RecordBatch:
        names, first, text = zip(*made)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(first, pa.int64()), pa.array(text)], names=["name", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            names, digests = [], []
            for own, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
                if state is not None and own == name:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    names.append(name)
                    digests.append(state.hexdigest())
                name, state = own, hashlib.sha256(ids.encode())
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests)], names=["name", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.hexdigest()])], names=["name", "ends_sha256"])

    pieces = ends.repartitionByRange("name", "seq").sortWithinPartitions("name", "seq").mapInArrow(
        joined, "name binary, first long, ids string"
    )
    return pieces.repartition("name").sortWithinPartitions("name", "first").mapInArrow(hashed, "name binary, ends_sha256 string")

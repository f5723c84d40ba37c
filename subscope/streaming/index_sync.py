"""Keeping an index level with a change feed, one triggered run at a time.

The index is kept as versions of its rows in ranges of the key's hash: a batch writes a folder for each range
that it touches, and a log says which. A range that one folder holds is read as it is; only where
several do are versions merged, and ranges are compacted one by one, each when it has gathered enough.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from subscope.operators.diff import DELETE
from subscope.operators.index import TextEmbedder, build_index

RANGES = 64
HELPERS = ("_pk", "version", "deleted", "_batch")


def _range_of(pk: str) -> Column:
    return F.pmod(F.xxhash64(pk), F.lit(RANGES)).cast("int")


def _log(spark: SparkSession, index_path: str, folder: str, ranges: list[int], number: int, upto: int) -> None:
    rows = [(folder, r, number, upto) for r in ranges]
    kinds = "folder string, range int, number long, upto long"
    spark.createDataFrame(rows, kinds).coalesce(1).write.mode("append").parquet(f"{index_path}/log")


def _folders(spark: SparkSession, index_path: str) -> dict[int, tuple[list[str], int]]:
    """By range: the folders that hold it, and the last batch in them.

    A log line with ``number`` under 0 is of a compaction, up to batch ``upto``; batches up to there count no more.
    """
    log = spark.read.parquet(f"{index_path}/log").distinct()
    compacted = log.where("number < 0").groupBy("range").agg(F.max("upto").alias("base"), F.max_by("folder", "upto").alias("first"))
    live = log.where("number >= 0").join(compacted.select("range", "base"), "range", "left").where("base is null or number > base")
    found: dict[int, tuple[list[str], int]] = {}
    for r in compacted.collect():  # a row for each range
        found[r["range"]] = ([r["first"]], r["base"])
    for r in live.select("range", "number", "folder").distinct().orderBy("number").collect():  # batches since the last compaction
        folders, _ = found.get(r["range"], ([], -1))
        found[r["range"]] = ([*folders, r["folder"]], r["number"])
    return {r: ([f"{index_path}/{f}/range={r}" for f in folders], last) for r, (folders, last) in found.items()}


def _newest(held: DataFrame) -> DataFrame:
    best = F.max_by(F.struct(*held.columns), F.struct("version", "_batch")).alias("row")
    return held.groupBy("_pk").agg(best).select("row.*")


def read_index(spark: SparkSession, index_path: str) -> DataFrame:
    """The index as all batches so far leave it: of each key the newest version, unless that deleted it.

    Ranges that one folder holds are not shuffled.
    """
    folders = [paths for paths, _ in _folders(spark, index_path).values()]
    alone = [paths[0] for paths in folders if len(paths) == 1]
    several = [p for paths in folders if len(paths) > 1 for p in paths]
    parts = [spark.read.parquet(*alone)] if alone else []
    parts += [_newest(spark.read.parquet(*several))] if several else []
    level = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return level.where("not deleted").drop(*HELPERS)


def take_in(
    index_path: str, pk: str, text_col: str, embedder: TextEmbedder
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for a feed of ``pk, change, payload.., version``.

    A batch writes the newest version of each of its keys, embedded, and a mark for each deleted one, and
    reads nothing of what is there: the table keeps versions, so a change that comes late is older than what
    the index holds, whichever batch it is in. A batch that is run again writes the same files again.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        newest = batch.groupBy(pk).agg(F.max_by(F.struct(*batch.columns), "version").alias("row")).select("row.*")
        arriving = newest.where(F.col("change") != DELETE).drop("change")
        made = build_index(arriving, pk, text_col, embedder=embedder, carry=["version"])
        gone = newest.where(F.col("change") == DELETE).select(pk, "version")
        changes = made.withColumn("deleted", F.lit(False)).unionByName(
            gone.withColumn("deleted", F.lit(True)), allowMissingColumns=True
        )
        _store(changes.withColumns({"_pk": F.col(pk), "_batch": F.lit(batch_id)}), index_path, f"changes/{batch_id}", batch_id, batch_id)

    return run


def _store(rows: DataFrame, index_path: str, folder: str, number: int, upto: int) -> None:
    spark, target = rows.sparkSession, f"{index_path}/{folder}"
    dealt = rows.withColumn("range", _range_of("_pk"))
    dealt.write.partitionBy("range").mode("overwrite").parquet(target)
    ranges = spark.read.schema(dealt.schema).parquet(target).select("range").distinct().collect()
    if ranges:
        _log(spark, index_path, folder, sorted(r["range"] for r in ranges), number, upto)


def compact_ranges(spark: SparkSession, index_path: str, folders: int = 4) -> list[int]:
    """Merge the versions of each range that ``folders`` folders or more hold, and return those ranges.

    Deleted keys keep their mark, so a late change still loses. Nothing else is read or written; readers go
    by the log, which names the new folder once it is whole.
    """
    found = {r: (paths, last) for r, (paths, last) in _folders(spark, index_path).items() if len(paths) >= folders}
    by_last: dict[int, list[int]] = {}
    for r, (_, last) in found.items():
        by_last.setdefault(last, []).append(r)
    for last, ranges in by_last.items():
        held = spark.read.parquet(*[p for r in ranges for p in found[r][0]])
        _store(_newest(held), index_path, f"compacted/{last}-{uuid.uuid4().hex}", -1, last)
    return sorted(found)


def compact(spark: SparkSession, index_path: str, target: str) -> None:
    """Write the index as it is now, one row for each key, to ``target``."""
    read_index(spark, index_path).write.parquet(target)


def start_sync(
    feed: DataFrame, index_path: str, checkpoint: str, pk: str, text_col: str, embedder: TextEmbedder
) -> StreamingQuery:
    """Take in all that has arrived since the last run, then stop.

    ``checkpoint`` counts the batches the files in ``index_path`` are named after: start either anew
    only together with the other.
    """
    return (
        feed.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(take_in(index_path, pk, text_col, embedder))
        .start()
    )

"""A corpus made ready for training: five stages, each on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.functions.bitmaps import mark, unused
from subscope.llm import exact_dedup, language_id, near_dedup, quality_rules
from subscope.llm.queries import packed
from subscope.llm.stage import folder, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document whose likeliest language has less than this mean probability has none that was learnt.
MIN_SCORE = 0.4


def _named(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column for each row's doc_id and a hash of its text, alike for rows alike in both, and its name.

    Null ids come last. The name is none that ``docs`` has, so no column of the caller's is lost.
    """
    [name] = unused(docs, "row")
    nothing = F.lit(0).cast(docs.schema["doc_id"].dataType)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", nothing).alias("id"), F.xxhash64("text").alias("text"))
    return docs.withColumn(name, row), name


def _without(named: DataFrame, dropped: DataFrame, name: str) -> DataFrame:
    """The rows of ``named`` whose column ``name`` is not in ``dropped``; only rows that may be among them are shuffled."""
    [maybe] = unused(named, "maybe")
    dropped = stored(dropped.select(name).distinct())
    marked = mark(named, dropped, name, maybe)
    left = marked.where(F.col(maybe)).join(dropped, name, "left_anti")
    return marked.where(~F.col(maybe)).unionByName(left.select(*marked.columns)).select(*named.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet the rules, without lines that many documents of their source share.

    A null, empty or blank text has too few words and goes; a null source is a source of its own. Repeated rows
    are judged alike and all stay or go. Columns of any name come through; an empty table stays empty.
    """
    return quality_rules.clean(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; where none could be learnt, those with a letter.

    A null, empty or blank text has no letter and goes, by its doc_id and text: other texts of a null or repeated doc_id stay.
    A null lang is not learnt from. Columns of any name come through; an empty table stays empty.
    """
    net = language_id.learn(docs)
    if not net.languages:
        return docs.where(r"text rlike '\\p{L}'")
    named, name = _named(docs)
    found = language_id.predict(named, net, key=name)
    without = (F.col("lang_pred") == language_id.UNDETERMINED) | (F.col("score") < MIN_SCORE)
    return _without(named, found.where(without), name).drop(name)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with one text, the one with the smallest doc_id; of rows with that doc_id too, one.

    Null counts as empty, and a null doc_id stays only where all of the text have none. Rows with a text of their own
    are not shuffled. Columns of any name come through; an empty table stays empty.
    """
    maybe, text, key, sha, kept = unused(docs, "maybe", "text", "id", "sha", "kept")
    found = exact_dedup.exact_duplicates(docs).where("group_size > 1")
    found = stored(found.select(F.col("doc_id").alias(key), F.col("text_sha256").alias(sha), F.col("kept").alias(kept)).distinct())
    marked = mark(docs, found.select(F.col(key).alias("doc_id")), "doc_id", maybe)
    some = marked.where(F.col(maybe)).withColumn(text, F.sha2(F.coalesce("text", F.lit("")), 256))
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(text) == F.col(sha))
    stays = F.coalesce(F.col(kept), F.lit(True))
    first = some.join(found, same, "left").where(stays).dropDuplicates(["doc_id", text])
    return marked.where(~F.col(maybe)).select(*docs.columns).unionByName(first.select(*docs.columns))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that links of similarity connect, one with the smallest doc_id, null only if all are.

    A null, empty or blank text is like nothing and stays. Of rows alike in doc_id and text one stays, if there are
    words. Columns of any name come through; an empty table stays empty.
    """
    named, name = _named(docs)
    maybe, more = unused(named, "maybe", "again")
    found = stored(near_dedup.near_duplicates(named, key=name))
    again = found.where("kept and n_shingles > 0").groupBy(name).count().where("count > 1").select(name)
    left = _without(named, found.where("not kept"), name)
    again = stored(again)
    marked = mark(left, again, name, maybe)
    some = marked.where(F.col(maybe)).join(again.withColumn(more, F.lit(True)), name, "left")
    once = some.where(F.col(more)).dropDuplicates([name])
    parts = [marked.where(~F.col(maybe)), some.where(F.col(more).isNull()), once]
    return reduce(DataFrame.unionByName, [p.select(*docs.columns) for p in parts])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's tokens go in sequences of bounded length.

    A null or empty text is its end token alone; repeated rows and null ids are documents like others, in the order of
    no column. Other columns are not returned; an empty table gives no rows.
    """
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("language", language),
    ("exact duplicates", exact),
    ("near duplicates", near),
    ("packing", packing),
]

#: Recurrent networks, MinHash components and tokenizers have no SQL form; the tests compare by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = folder(docs, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

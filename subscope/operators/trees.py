"""A boosted-tree model as a table of its nodes, and scores made from that table alone."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.settings import cut

ROWS_AT_ONCE = 1024


def nodes_of(model: PipelineModel, path: str) -> DataFrame:
    """``tree, weight, node, prediction, yes, no, feature, threshold, level``: a row for each node of the fitted trees.

    A row of features goes to ``yes`` where the feature is at most ``threshold`` or, for a 0/1 column, is ``level``,
    else to ``no``; a leaf has neither. The model is written to ``path``, in its own format, and read from there.
    """
    booster = model.stages[-1]
    booster.write().overwrite().save(path)
    spark = SparkSession.active()
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(booster.treeWeights)], "tree int, weight double")
    node = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    split, leaf = F.col("split"), F.col("leftChild") < 0
    told = F.element_at(split["leftCategoriesOrThreshold"], 1)
    numeric = split["numCategories"] < 0
    return node.join(weights, "tree").select(
        "tree", "weight", F.col("id").alias("node"), "prediction",
        F.when(~leaf, F.col("leftChild")).alias("yes"), F.when(~leaf, F.col("rightChild")).alias("no"),
        F.when(~leaf, split["featureIndex"]).alias("feature"),
        F.when(~leaf & numeric, told).alias("threshold"), F.when(~leaf & ~numeric, told).alias("level"),
    )


def depth_of(nodes: DataFrame) -> int:
    """Steps from a root to the deepest leaf."""
    at, steps = cut(nodes.where("node = 0 and yes is not null").select("tree", "yes", "no")), 0
    links = nodes.where("yes is not null").select("tree", F.col("node").alias("at"), "yes", "no")
    while not at.isEmpty():
        steps += 1
        below = at.select("tree", F.explode(F.array("yes", "no")).alias("at"))
        at = cut(below.join(links, ["tree", "at"]).select("tree", "yes", "no"))
    return steps


def score_by_nodes(encoded: DataFrame, nodes: DataFrame, output: str = "score", features: str = "features") -> DataFrame:
    """``encoded`` with the probability of label 1, from the nodes and the feature vectors alone.

    The ensemble's nodes, a table of the model's size whatever the number of rows, go to every task as arrays, and all rows of a
    batch walk all trees together, a step at a time.
    """
    held = nodes.orderBy("tree", "node").select(
        "tree", "weight", "prediction", "feature", F.coalesce("threshold", F.lit(np.nan)).alias("threshold"),
        F.coalesce("level", F.lit(np.nan)).alias("level"), "yes", "no", F.col("level").isNotNull().alias("leveled"), F.col("yes").isNull().alias("leaf"),
    ).toArrow()
    tree, leaf = held["tree"].to_numpy(), held["leaf"].to_numpy()
    roots = np.flatnonzero(np.diff(tree, prepend=-1))
    base, own = np.repeat(roots, np.diff(np.append(roots, len(tree)))), np.arange(len(tree))
    yes, no = (np.where(leaf, own, base + held[c].fill_null(0).to_numpy()) for c in ("yes", "no"))
    feature, threshold, level, leveled = (held[c].to_numpy() for c in ("feature", "threshold", "level", "leveled"))
    feature = np.nan_to_num(feature).astype(np.int64)
    gain = held["weight"].to_numpy() * held["prediction"].to_numpy()

    def score(vectors: pa.Array) -> pa.Array:
        x = np.full((len(vectors), feature.max() + 1), np.nan)
        some = np.asarray(vectors.is_valid())
        if some.any():
            given = vectors.flatten().to_numpy().reshape(some.sum(), -1)[:, : x.shape[1]]
            x[some, : given.shape[1]] = given
        out = np.empty(len(x))
        for start in range(0, len(x), ROWS_AT_ONCE):
            rows = x[start : start + ROWS_AT_ONCE]
            at = np.broadcast_to(roots, (len(rows), len(roots)))
            while not leaf[at].all():
                value = np.take_along_axis(rows, feature[at], 1)
                at = np.where(np.where(leveled[at], value == level[at], value <= threshold[at]), yes[at], no[at])
            margin = gain[at].cumsum(1)[:, -1]  # tree by tree
            out[start : start + ROWS_AT_ONCE] = 1 / (1 + np.exp(-2 * margin))
        return pa.array(out)

    return encoded.withColumn(output, F.arrow_udf(score, "double")(vector_to_array(features)))

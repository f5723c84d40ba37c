"""How good a score is: base rate, ROC AUC, classification report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subscope.functions.scoring import flag, hard_label


def label_base_rate(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col(label)).cast("bigint").alias("n_positive"),
        F.avg(F.col(label)).alias("base_rate"),
    )


def roc_auc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``auc, n_positive, n_negative``; equal scores count half, one class alone has no AUC.

    The chance that a positive outranks a negative, summed over distinct scores. The running count of
    negatives is taken inside score ranges of about equal size, one per shuffle partition, and carried
    over from range to range, so no task ever sorts more than its range. All counts are whole numbers
    until the last division.
    """
    by_score = (
        df.select(F.col(score).alias("s"), F.col(label).alias("y"))
        .where(F.col("s").isNotNull() & F.col("y").isNotNull())
        .groupBy("s")
        .agg(
            F.sum(flag(F.col("y") == 1)).alias("pos"),
            F.sum(flag(F.col("y") == 0)).alias("neg"),
        )
    )
    ranged = by_score.repartitionByRange("s").withColumn("r", F.spark_partition_id())
    inside = Window.partitionBy("r").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    pairs = (
        ranged.withColumn("below", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
        .groupBy("r")
        .agg(
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            # twice the pairs won inside the range: a tie is worth one, a win two
            F.sum(_wide("pos") * (2 * _wide("below") + _wide("neg"))).alias("twice_won"),
        )
    )
    # From here on there is one row per range.
    earlier = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    carried = pairs.withColumn("carried", F.coalesce(F.sum("neg").over(earlier), F.lit(0)))
    total = carried.agg(
        F.sum("pos").alias("n_positive"),
        F.sum("neg").alias("n_negative"),
        F.sum(F.col("twice_won") + 2 * _wide("pos") * _wide("carried")).alias("twice_won"),
    )
    possible = F.col("n_positive").cast("double") * F.col("n_negative").cast("double")
    return total.select(
        F.when(possible > 0, F.col("twice_won").cast("double") / 2.0 / possible).alias("auc"),
        F.coalesce("n_positive", F.lit(0)).alias("n_positive"),
        F.coalesce("n_negative", F.lit(0)).alias("n_negative"),
    )


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(18,0)")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def classification_report(
    df: DataFrame, score: str = "score", label: str = "label", threshold: float = 0.5
) -> DataFrame:
    """``entry, precision, recall, f1, support`` for each class seen, then accuracy (under ``f1``),
    macro and weighted mean. A class never predicted has precision 0."""
    y, hit = F.col(label), hard_label(F.col(score), threshold)
    cells = df.agg(
        *[
            F.sum(flag((y == truth) & (hit == guess))).alias(f"c{truth}{guess}")
            for truth in (0, 1)
            for guess in (0, 1)
        ]
    )
    total = F.col("c00") + F.col("c01") + F.col("c10") + F.col("c11")
    entries, per_class = [], []
    for this, other in ((0, 1), (1, 0)):
        right = F.col(f"c{this}{this}")
        support = right + F.col(f"c{this}{other}")
        claimed = right + F.col(f"c{other}{this}")
        precision, recall = _share(right, claimed), _share(right, support)
        f1 = _share(2.0 * right, claimed + support)
        per_class.append((precision, recall, f1, support, (support + claimed) > 0))
        entries.append(_entry(str(this), precision, recall, f1, support, (support + claimed) > 0))
    none = F.lit(None).cast("double")
    accuracy = _share(F.col("c00") + F.col("c11"), total)
    entries.append(_entry("accuracy", none, none, accuracy, total, total > 0))
    seen = sum((flag(c[4]) for c in per_class), F.lit(0))
    macro = [_share(sum((F.when(c[4], c[i]).otherwise(0.0) for c in per_class), F.lit(0.0)), seen) for i in range(3)]
    weighted = [_share(sum((c[i] * c[3] for c in per_class), F.lit(0.0)), total) for i in range(3)]
    entries.append(_entry("macro avg", *macro, total, total > 0))
    entries.append(_entry("weighted avg", *weighted, total, total > 0))
    return cells.select(F.inline(F.array(*entries))).where("shown").drop("shown")


def _entry(name: str, precision: Column, recall: Column, f1: Column, support: Column, shown: Column) -> Column:
    return F.struct(
        F.lit(name).alias("entry"), precision.alias("precision"), recall.alias("recall"),
        f1.alias("f1"), support.alias("support"), shown.alias("shown"),
    )

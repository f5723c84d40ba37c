"""Churn and upgrade models: targets, split, gradient-boosted trees, scores for the whole base."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subscope.functions.draws import hash_draw
from subscope.functions.scoring import band, flag, round_score
from subscope.operators.evaluation import classification_report, roc_auc
from subscope.settings import (
    CANCELLED, FREE, PAID_PLANS, PROPENSITY_BANDS, RISK_BANDS, cut, shared_folder,
)

NUMERIC = (
    "n_events", "watch_total", "watch_avg", "pct_avg", "completion_rate", "n_genres", "n_devices",
    "recency_days", "tenure_days",
)
ROUNDS, LEARNING_RATE, SEED, TEST_SHARE = 200, 0.1, 42, 0.25
PARTITION_ROWS = 50_000  # of training; every tree is several jobs, whose tasks should have something to do
SPLIT_BUCKETS = 65536


def churn_target() -> Column:
    return flag(F.col("status") == CANCELLED)


def paid_target() -> Column:
    return flag(F.col("plan").isin(*PAID_PLANS))


@dataclass(frozen=True)
class ModelSpec:
    """What a model predicts, from what, and how its scores are stored."""

    name: str
    categorical: tuple[str, ...]
    score_col: str
    band_col: str
    bands: tuple[str, str, str]
    keep: tuple[str, ...]
    only_plan: str | None = None
    numeric: tuple[str, ...] = NUMERIC

    def target(self) -> Column:
        return churn_target() if self.name == "churn" else paid_target()


CHURN = ModelSpec(
    "churn", ("plan", "state", "age_band", "main_device"), "prob_churn", "risk_band", RISK_BANDS,
    keep=("user_id", "plan", "status"),
)
# The plan would give the answer away.
UPGRADE = ModelSpec(
    "upgrade", ("state", "age_band", "main_device"), "prob_upgrade", "band", PROPENSITY_BANDS,
    keep=("user_id", "plan"), only_plan=FREE,
)


def targets(features: DataFrame, spec: ModelSpec) -> DataFrame:
    """The features with numerics as DOUBLE and the 0/1 ``label``."""
    numbers = {c: F.col(c).cast("double") for c in spec.numeric}
    return features.withColumns({**numbers, "label": spec.target()})


def split(
    df: DataFrame, key: str, share: float = TEST_SHARE, seed: int = SEED, label: str = "label", mode: str = "murmur3"
) -> DataFrame:
    """``df`` with ``split`` = ``test`` for the ``share`` of each label's rows with the smallest draws.

    Exact shares without ranking all rows: the draws are counted in buckets, the bucket holding the
    cut is found from at most ``SPLIT_BUCKETS`` counts per label, and only that bucket's rows are
    ranked. ``df`` is computed once and stored, as three passes are made over it.
    """
    drawn = cut(df.withColumn("_draw", hash_draw(key, f"split{seed}", mode)).withColumn(
        "_bucket", F.pmod("_draw", F.lit(SPLIT_BUCKETS)).cast("int")
    ))
    counts = drawn.groupBy(label, "_bucket").agg(F.count("*").alias("_n"))
    running = Window.partitionBy(label).orderBy("_bucket")
    whole = Window.partitionBy(label)
    cuts = (
        counts.withColumn("_upto", F.sum("_n").over(running))
        .withColumn("_wanted", F.floor(F.sum("_n").over(whole) * share + 0.5))
        .where((F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("_n") < F.col("_wanted")))
        .select(
            label,
            F.col("_bucket").alias("_cut"),
            (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_room"),
        )
    )
    last = (
        drawn.select(label, "_bucket", "_draw", key)
        .join(F.broadcast(cuts), label)  # one row per label
        .where(F.col("_bucket") == F.col("_cut"))
        .withColumn("_place", F.row_number().over(Window.partitionBy(label).orderBy("_draw", key)))
        .where(F.col("_place") == F.col("_room"))
        .select(label, F.struct("_bucket", "_draw", key).alias("_last"))
    )
    # A label with too few rows for a test row has no last one.
    in_test = F.coalesce(F.struct("_bucket", "_draw", key) <= F.col("_last"), F.lit(False))
    return drawn.join(F.broadcast(last), label, "left").select(
        *df.columns, F.when(in_test, "test").otherwise("train").alias("split")
    )


def split_shares(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label, "split").agg(F.count("*").alias("n_rows"))


def feature_stages(spec: ModelSpec) -> list:
    """One 0/1 column per known level of each categorical, all zero for an unknown one; numerics as
    they are."""
    indexed = [f"{c}_index" for c in spec.categorical]
    encoded = [f"{c}_levels" for c in spec.categorical]
    return [
        StringIndexer(
            inputCols=list(spec.categorical), outputCols=indexed,
            handleInvalid="keep", stringOrderType="alphabetAsc",
        ),
        # "keep" adds an index for unknown levels; dropping the last column drops exactly that one.
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=encoded + list(spec.numeric), outputCol="features"),
    ]


def fit(train: DataFrame, spec: ModelSpec, rounds: int = ROUNDS, **options) -> PipelineModel:
    """Fit on rows from ``targets``, which are stored once, in ``partitions``. The
    trees' intermediate state is checkpointed in the shared folder every ten rounds."""
    shared_folder(train.sparkSession)
    held = cut(train.select(*spec.categorical, *spec.numeric, "label"))
    train = held.coalesce(partitions(held.count(), train.sparkSession.sparkContext.defaultParallelism))
    booster = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=rounds, stepSize=LEARNING_RATE, seed=SEED,
        checkpointInterval=10, **options,
    )
    return Pipeline(stages=[*feature_stages(spec), booster]).fit(train)


def partitions(rows: int, cores: int) -> int:
    """Of training: no more than whole rounds of all cores, as each of a thousand jobs waits for a last round of a few tasks."""
    wanted = max(1, -(-rows // PARTITION_ROWS))
    return wanted if wanted < cores else wanted // cores * cores


def with_probability(model: PipelineModel, rows: DataFrame, output: str = "score") -> DataFrame:
    """``rows`` with the probability of label 1."""
    scored = model.transform(rows)
    return scored.select(
        *rows.columns, F.element_at(vector_to_array("probability"), 2).alias(output)
    )


def score(model: PipelineModel, features: DataFrame, spec: ModelSpec) -> DataFrame:
    """Stored scores of the whole base, training rows included: the score rounded, its band taken
    before rounding. An upgrade model scores Free users only."""
    rows = targets(features, spec)
    if spec.only_plan is not None:
        rows = rows.where(F.col("plan") == spec.only_plan)
    p = F.col("_p")
    extra = [c for c in ("split",) if c in features.columns]
    return with_probability(model, rows, "_p").select(
        *spec.keep, *extra, round_score(p).alias(spec.score_col), band(p, spec.bands).alias(spec.band_col)
    )


def evaluate(model: PipelineModel, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``roc_auc`` and ``classification_report`` over held-out rows."""
    scored = with_probability(model, test).select("score", "label")
    return roc_auc(scored), classification_report(scored)


def importances(model: PipelineModel, spec: ModelSpec) -> DataFrame:
    """``feature, importance``: how much each input drives the trees."""
    levels = model.stages[0].labelsArray
    names = [f"{c}={v}" for c, vs in zip(spec.categorical, levels) for v in vs] + list(spec.numeric)
    weights = [float(w) for w in model.stages[-1].featureImportances.toArray()]
    spark = SparkSession.active()
    return spark.createDataFrame(list(zip(names, weights)), "feature string, importance double")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def band_summary(scores: DataFrame, score_col: str, band_col: str) -> DataFrame:
    """``band, n_users, avg_score`` (3 decimals), the highest mean first."""
    # Scores are stored with four decimals, so their sum is taken exactly, as whole numbers.
    total = F.sum(F.rint(F.col(score_col) * 10_000).cast("bigint"))
    mean = total.cast("decimal(20,0)") / (F.count(score_col) * 10_000).cast("decimal(20,0)")
    return (
        scores.groupBy(F.col(band_col).alias("band"))
        .agg(F.count("*").alias("n_users"), F.round(mean, 3).cast("double").alias("avg_score"))
        .orderBy(F.desc("avg_score"), "band")
    )


def best_targets(
    scores: DataFrame, score_col: str, k: int = 15, status: str | None = None, extra: Sequence[str] = ()
) -> DataFrame:
    """The ``k`` users with the highest scores, of one status if named."""
    rows = scores if status is None else scores.where(F.col("status") == status)
    return (
        rows.orderBy(F.desc(score_col), "user_id").limit(k).select("user_id", *extra, score_col)
    )

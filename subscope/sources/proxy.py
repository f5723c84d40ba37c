"""Users, titles, plays and scores read from an order-and-events warehouse.

The views a deployment would read from its own tables; here they are derived from the star schema in
``TESTDATA.md``, every row of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.functions.draws import padded_key
from subscope.functions.scoring import band, round_score
from subscope.settings import ACTIVE, CANCELLED, COMPLETE, FREE, PROPENSITY_BANDS, RISK_BANDS
from subscope.sources.banks import AGE_BANDS, DEVICES, TITLE_KEY, USER_KEY

ACTIVE_SINCE = "2000-01-01"


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _nth(values: list[str], number: Column) -> Column:
    index = F.pmod(number, F.lit(len(values))) + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, with the first and last order deciding the signup date and the status."""
    orders = source(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("first_order"),
        F.max("o_orderdate").cast("date").alias("last_order"),
    )
    nation = source(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    balance = F.col("c_acctbal")
    joined = (
        source(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    )
    return joined.select(
        padded_key(USER_KEY, "c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.when(balance < 2500, FREE).when(balance < 6500, "Standard").otherwise("Premium").alias("plan"),
        F.col("n_name").alias("state"),
        _nth(AGE_BANDS, F.col("c_custkey")).alias("age_band"),
        F.col("c_mktsegment").alias("main_device"),
        F.coalesce("first_order", F.lit("1995-01-01").cast("date")).alias("signup_date"),
        F.when(F.col("last_order") >= F.lit(ACTIVE_SINCE).cast("date"), ACTIVE)
        .otherwise(CANCELLED)
        .alias("status"),
        F.col("c_custkey").alias("n"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "part").select(
        padded_key(TITLE_KEY, "p_partkey").alias("content_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("genre"),
        F.when(F.col("p_size") <= 30, "Filme").otherwise("Série").alias("kind"),
    )


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    return source(spark, sf_dir, "events").select(
        "event_id",
        padded_key(USER_KEY, "user_id").alias("user_id"),
        padded_key(TITLE_KEY, k).alias("content_id"),
        "ts",
        F.when(kind == "purchase", COMPLETE)
        .when(kind == "click", "pause")
        .when(kind == "error", "stop")
        .otherwise("play")
        .alias("event"),
        _nth(DEVICES, k).alias("device"),
        F.least(F.lit(100.0), "value").alias("pct_watched"),
        F.greatest(F.lit(1), F.floor("value")).cast("int").alias("watch_min"),
    )


def _spread(multiplier: int) -> Column:
    """A fixed stand-in for a model's probability."""
    return F.pmod(F.col("n") * multiplier, F.lit(10007)) / 10006.0


def scored(users_df: DataFrame) -> DataFrame:
    """Users with an unrounded churn score ``p``."""
    return users_df.withColumn("p", _spread(7919))


def churn_scores(users_df: DataFrame) -> DataFrame:
    return scored(users_df).select(
        "user_id", "plan", "status",
        round_score(F.col("p")).alias("prob_churn"),
        band(F.col("p"), RISK_BANDS).alias("risk_band"),
    )


def upgrade_scores(users_df: DataFrame) -> DataFrame:
    p = _spread(104729)
    return users_df.where(F.col("plan") == FREE).select(
        "user_id", "plan",
        round_score(p).alias("prob_upgrade"),
        band(p, PROPENSITY_BANDS).alias("band"),
    )

"""Engagement and profile features, one row per user."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions.scoring import flag
from subscope.operators.skew import heavy_keys, spread_join
from subscope.schemas import PLAYS, TITLES, USERS, USER_FEATURES, require
from subscope.settings import COMPLETE, NEVER_WATCHED_DAYS

PCT_GRID = 10_000  # pct_watched is summed as whole ten-thousandths
SUMS = ("n", "minutes", "n_minutes", "pct", "n_pct", "completed")


def completion_rate(completed: Column, total: Column) -> Column:
    """Share of completed plays, as DECIMAL(15,5)."""
    share = completed.cast("decimal(20,0)") / total.cast("decimal(20,0)")
    return share.cast("decimal(15,5)")


def engagement_state(plays: DataFrame, titles: DataFrame) -> DataFrame:
    """What is kept of each user's plays: whole-number sums, the sets of genres and devices, the last day.

    Plays are first summed by user, title and device, by hash and in each task before the shuffle, so a
    user or a title that holds a large part of them arrives as few rows. A title that many users play is still
    many of those: its sums are dealt out to several tasks, as a sketch of the plays' titles says. ``pct_watched``
    is summed as whole numbers of ``PCT_GRID``-ths, so averages do not depend on how the rows were split; finer
    values are rounded.
    """
    require(plays, PLAYS, "user_id", "content_id", "ts", "event", "device", "pct_watched", "watch_min")
    require(titles, TITLES, "content_id", "genre")
    pct = F.rint(F.col("pct_watched") * PCT_GRID).cast("bigint")
    sums = plays.groupBy("user_id", "content_id", "device").agg(
        F.count("*").alias("n"), F.sum("watch_min").alias("minutes"), F.count("watch_min").alias("n_minutes"),
        F.sum(pct).alias("pct"), F.count("pct_watched").alias("n_pct"),
        F.sum(flag(F.col("event") == COMPLETE)).cast("bigint").alias("completed"), F.max(F.to_date("ts")).alias("last"),
    )
    met = spread_join(sums, titles.select("content_id", "genre"), "content_id", "user_id", heavy_keys(plays, "content_id"))
    return met.groupBy("user_id").agg(
        *[F.sum(c).alias(c) for c in SUMS], F.max("last").alias("last"),
        F.collect_set("genre").alias("genres"), F.collect_set("device").alias("devices"),
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of the plays that the ``states`` are of together, if no play is in two of them."""
    held = reduce(DataFrame.unionByName, states)
    return held.groupBy("user_id").agg(
        *[F.sum(c).alias(c) for c in SUMS], F.max("last").alias("last"),
        *[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("genres", "devices")],
    )


def features_of(users: DataFrame, state: DataFrame, as_of: dt.date, no_recency: int = NEVER_WATCHED_DAYS) -> DataFrame:
    """Every user once, with what their state says; without one, zeros and ``no_recency``."""
    require(users, USERS, "user_id", "plan", "state", "age_band", "main_device", "signup_date", "status")
    engagement = state.select(
        "user_id", F.col("n").alias("n_events"), F.col("minutes").alias("watch_total"),
        (F.col("minutes") / F.nullif("n_minutes", F.lit(0))).alias("watch_avg"),
        (F.col("pct") / (F.nullif("n_pct", F.lit(0)) * float(PCT_GRID))).alias("pct_avg"),
        completion_rate(F.col("completed"), F.col("n")).alias("completion_rate"),
        F.size("genres").alias("n_genres"), F.size("devices").alias("n_devices"),
        F.datediff(F.lit(as_of), F.col("last")).alias("recency_days"),
    )
    defaults = {
        "n_events": 0, "watch_total": 0, "watch_avg": 0.0, "pct_avg": 0.0, "completion_rate": 0,
        "n_genres": 0, "n_devices": 0, "recency_days": no_recency,
    }
    columns = {name: F.col(name) for name in ("user_id", "plan", "state", "age_band", "main_device", "status")}
    columns["tenure_days"] = F.datediff(F.lit(as_of), F.col("signup_date"))
    for name, default in defaults.items():
        columns[name] = F.coalesce(F.col(name), F.lit(default))
    return users.join(engagement, "user_id", "left").select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in USER_FEATURES.fields]
    )


def user_features(
    users: DataFrame,
    plays: DataFrame,
    titles: DataFrame,
    as_of: dt.date,
    no_recency: int = NEVER_WATCHED_DAYS,
) -> DataFrame:
    """Every user once: those without plays get zeros and ``no_recency``; plays of users not in
    ``users`` do not appear; plays of unknown titles count, without a genre."""
    return features_of(users, engagement_state(plays, titles), as_of, no_recency)

"""Reproducible subscribers, titles and viewing events.

Every value is a function of its row's key (see ``functions.draws``), so the tables are the same for
any partitioning and a lost task rebuilds exactly the rows it lost. The generators take the keys as a
DataFrame; ``key_range`` supplies plain ranges.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.functions.draws import half_up, hash_draw, hash_int, hash_uniform, padded_key, pick
from subscope.schemas import HELP_ARTICLES, PLAYS, TITLES, USERS
from subscope.settings import ACTIVE, CANCELLED, COMPLETE, FREE
from subscope.sources import banks

N_USERS, N_TITLES, N_PLAYS = 120_000, 10_000, 1_000_000


def key_range(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """``n``: 1 .. N."""
    return spark.range(1, n + 1, 1, partitions).withColumnRenamed("id", "n")


def titles_for(keys: DataFrame, mode: str = "murmur3") -> DataFrame:
    """One title per ``n``."""

    def of(bank: list[str], salt: str) -> Column:
        return pick(bank, salt, "n", mode)

    kind, genre = of(banks.KINDS, "tipo"), of(banks.GENRES, "gen")
    name = F.concat(of(banks.TITLE_CORES, "nuc"), of(banks.TITLE_SUFFIXES, "sfx"))
    cast = [of(banks.CAST_NAMES, salt) for salt in ("e1", "e2", "e3")]
    synopsis = F.concat_ws(
        " ",
        of(banks.SYNOPSIS_OPENINGS, "ab"), of(banks.SYNOPSIS_HEROES, "pr"),
        of(banks.SYNOPSIS_TURNS, "dv"), of(banks.SYNOPSIS_CLOSINGS, "fe"),
        F.concat(F.lit("Um título de "), genre, F.lit(".")),
    )
    columns = {
        "content_id": padded_key(banks.TITLE_KEY, "n"),
        "title": F.trim(F.concat_ws(" ", of(banks.TITLE_PREFIXES, "pfx"), name)),
        "kind": kind,
        "genre": genre,
        "genre2": of(banks.GENRES, "gen2"),
        "year": hash_int("n", "ano", 1990, 36, mode),
        "rating_class": of(banks.RATING_CLASSES, "cls"),
        "language": of(banks.LANGUAGES, "idi"),
        "country": of(banks.COUNTRIES, "pais"),
        "director": of(banks.CAST_NAMES, "dir"),
        "cast_names": F.concat_ws(", ", *cast),
        "score_avg": half_up(5.0 + hash_uniform("n", "nota", mode) * 5.0, 1),
        "seasons": F.when(kind == "Série", hash_int("n", "temp", 1, 8, mode)),
        "duration_min": F.when(kind == "Filme", hash_int("n", "dur", 80, 90, mode)),
        "synopsis": synopsis,
    }
    return keys.select(*[columns[name].alias(name) for name in TITLES.fieldNames()])


def users_for(
    keys: DataFrame, plays_per_user: float, as_of: dt.date, mode: str = "murmur3"
) -> DataFrame:
    """One user per ``n``, with the latent columns ``eng`` and ``n_ev`` the plays are drawn from.

    Engagement drives the plan, the cancellation and the number of plays, which is what gives the
    models something to learn. ``gen_users`` drops the latent columns.
    """

    def u(salt: str) -> Column:
        return hash_uniform("n", salt, mode)

    first, last = pick(banks.FIRST_NAMES, "pn", "n", mode), pick(banks.LAST_NAMES, "un", "n", mode)
    blend = 0.65 * F.col("eng") + 0.35 * u("plan")
    leave_at = 0.32 - 0.26 * F.col("eng") + F.when(F.col("plan") == FREE, 0.15).otherwise(0.0)
    plays = plays_per_user * (0.25 + 1.5 * F.col("eng")) * (0.6 + 0.8 * u("n_ev"))
    return (
        keys.select("n")
        .withColumn("eng", F.pmod(hash_draw("n", "eng", mode), F.lit(1000)) / 1000.0)
        .withColumn(
            "plan",
            F.when(blend < 0.42, FREE).when(blend < 0.75, "Standard").otherwise("Premium"),
        )
        .withColumns({
            "user_id": padded_key(banks.USER_KEY, "n"),
            "name": F.concat_ws(" ", first, last),
            "email": F.concat(
                F.lower(first), F.lit("."), F.lower(last), F.col("n").cast("string"),
                F.lit("@" + banks.EMAIL_DOMAIN),
            ),
            "state": pick(banks.STATES, "uf", "n", mode),
            "age_band": pick(banks.AGE_BANDS, "faixa", "n", mode),
            "main_device": pick(banks.DEVICES, "disp", "n", mode),
            "signup_date": F.date_sub(F.lit(as_of), F.floor(u("signup") * 1825).cast("int")),
            "status": F.when(u("status") < leave_at, CANCELLED).otherwise(ACTIVE),
            "n_ev": F.floor(plays + 0.5).cast("int"),
        })
    )


def plays_of(
    latent: DataFrame, n_titles: int | Column, as_of: dt.date, mode: str = "murmur3"
) -> DataFrame:
    """``n_ev`` plays for each row of ``users_for``; every play's title is one of 1 .. n_titles."""
    pair = ["n", "k"]
    one_each = F.concat_ws("_", F.col("n"), F.col("k"))
    count = F.lit(n_titles) if isinstance(n_titles, int) else n_titles

    def u(salt: str) -> Column:
        return hash_uniform(pair, salt, mode)

    def whole(value: Column) -> Column:
        return F.floor(value).cast("int")

    clock = F.lit(f"{as_of} 00:00:00").cast("timestamp_ntz")  # from text: no time zone comes into it
    ago = F.make_dt_interval(
        whole(u("day") * 365), whole(u("hour") * 24), whole(u("minute") * 60), F.lit(0)
    )
    columns = {
        "event_id": F.concat(F.lit("EVT"), F.col("n").cast("string"), F.lit("-"), F.col("k").cast("string")),
        "user_id": padded_key(banks.USER_KEY, "n"),
        "content_id": padded_key(banks.TITLE_KEY, F.pmod(hash_draw(pair, "c", mode), count) + 1),
        "ts": clock - ago,
        "event": F.when(u("done") < 0.15 + 0.55 * F.col("eng"), COMPLETE).otherwise(
            pick(banks.OTHER_EVENTS, "evt", one_each, mode)
        ),
        "device": pick(banks.DEVICES, "dispe", one_each, mode),
        "pct_watched": half_up(
            F.least(F.lit(100.0), (20 + 80 * F.col("eng")) * (0.5 + u("pct"))), 1
        ),
        "watch_min": F.greatest(F.lit(1), whole((5 + 110 * F.col("eng")) * (0.5 + u("watch")))),
    }
    return (
        latent.where(F.col("n_ev") >= 1)  # sequence(1, 0) counts down instead of being empty
        .select("n", "eng", F.explode(F.sequence(F.lit(1), F.col("n_ev"))).alias("k"))
        .select(*[columns[name].alias(name) for name in PLAYS.fieldNames()])
    )


def gen_titles(spark: SparkSession, n: int = N_TITLES, mode: str = "murmur3") -> DataFrame:
    return titles_for(key_range(spark, n), mode)


def gen_users_latent(
    spark: SparkSession, as_of: dt.date, n: int = N_USERS, n_plays: int = N_PLAYS, mode: str = "murmur3"
) -> DataFrame:
    return users_for(key_range(spark, n), n_plays / n if n else 0.0, as_of, mode)


def gen_users(latent: DataFrame) -> DataFrame:
    """The stored columns of ``users_for``."""
    return latent.select(*USERS.fieldNames())


def gen_plays(
    latent: DataFrame, as_of: dt.date, n_titles: int = N_TITLES, mode: str = "murmur3"
) -> DataFrame:
    return plays_of(latent, n_titles, as_of, mode)


def gen_help(spark: SparkSession) -> DataFrame:
    """The help articles: whom each is for and its steps, as one text."""
    rows = [
        (f"AJU-{i:03d}", i, topic, f"{whom}: {'; '.join(steps)}.", banks.HELP_SOURCE, banks.HELP_UPDATED)
        for i, (topic, whom, steps) in enumerate(banks.HELP, start=1)
    ]
    return spark.createDataFrame(rows, HELP_ARTICLES)

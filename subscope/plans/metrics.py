"""Declared measures over the declared join graph.

A measure is built from sums, so it can be reduced to one row per join key before any dimension is
joined: the join moves as many rows as there are keys, and a key that holds a large part of the fact
table weighs no more than another.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions.scoring import flag
from subscope.operators.ranking import top_k
from subscope.settings import CANCELLED, COMPLETE, PAID_PLANS, PROPENSITY_BANDS, RISK_BANDS

Tables = Mapping[str, DataFrame]

# fact -> {dimension: join key}
DECLARED: dict[str, dict[str, str]] = {
    "plays": {"users": "user_id", "titles": "content_id"},
    "user_features": {"users": "user_id"},
    "churn_scores": {"users": "user_id"},
    "upgrade_scores": {"users": "user_id"},
    "users": {},
    "titles": {},
}


@dataclass(frozen=True)
class Measure:
    """Named sums over a fact table and the expression that combines them."""

    fact: str
    parts: dict[str, str]
    value: str
    dtype: str = "bigint"


def _in(values: Sequence[str]) -> str:
    return "IN (" + ", ".join(f"'{v}'" for v in values) + ")"


def _count_if(fact: str, condition: str) -> Measure:
    return Measure(fact, {"n": f"count_if({condition})"}, "n")


def _rate(fact: str, condition: str) -> Measure:
    return Measure(fact, {"hits": f"count_if({condition})", "n": "count(*)"}, "hits / nullif(n, 0)", "double")


MEASURES: dict[str, Measure] = {
    "user_count": Measure("users", {"n": "count(*)"}, "n"),
    "payer_count": _count_if("users", f"plan {_in(PAID_PLANS)}"),
    "churn_rate": _rate("users", f"status = '{CANCELLED}'"),
    "title_count": Measure("titles", {"n": "count(*)"}, "n"),
    "play_count": Measure("plays", {"n": "count(*)"}, "n"),
    "watch_minutes": Measure("plays", {"m": "sum(watch_min)"}, "m"),
    "avg_watch_minutes": Measure(
        "plays", {"m": "sum(watch_min)", "n": "count(watch_min)"}, "m / nullif(n, 0)", "double"
    ),
    "completion_rate": _rate("plays", f"event = '{COMPLETE}'"),
    **{
        f"{level}_risk_users": _count_if("churn_scores", f"risk_band = '{band}'")
        for level, band in zip(("low", "medium", "high"), RISK_BANDS)
    },
    **{
        f"{level}_propensity_users": _count_if("upgrade_scores", f"band = '{band}'")
        for level, band in zip(("low", "medium", "high"), PROPENSITY_BANDS)
    },
}


def star(
    tables: Tables, fact: str, dims: Sequence[str], how: str = "inner", joins: Mapping = DECLARED
) -> DataFrame:
    """The fact table joined to the named dimensions on their declared keys. A dimension column the
    fact also has is left out."""
    joined = tables[fact]
    for dim in dims:
        key = joins[fact][dim]
        fresh = [c for c in tables[dim].columns if c not in joined.columns]
        joined = joined.join(tables[dim].select(key, *fresh), key, how)
    return joined


def _owners(tables: Tables, fact: str, columns: Sequence[str]) -> dict[str, str]:
    """Which table each column comes from: the fact first, then its dimensions in declared order."""
    owners = {}
    for column in columns:
        for table in (fact, *DECLARED[fact]):
            if table in tables and column in tables[table].columns:
                owners[column] = table
                break
        else:
            raise ValueError(f"no table joined to {fact} has a column {column}")
    return owners


def _holds(column: str, wanted: object) -> Column:
    if isinstance(wanted, (list, tuple, set)):
        return F.col(column).isin(*wanted)
    return F.col(column) == wanted


def metric(
    tables: Tables,
    name: str,
    by: Sequence[str] = (),
    where: Mapping[str, object] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The measure ``name`` for each combination of ``by`` columns, largest first.

    ``where`` maps columns to a value or a list of values. ``by`` and ``where`` may name columns of
    the fact or of any dimension joined to it.
    """
    if name not in MEASURES:
        raise ValueError(f"unknown measure {name!r}; there are {sorted(MEASURES)}")
    measure, where = MEASURES[name], dict(where or {})
    owners = _owners(tables, measure.fact, [*by, *where])

    def narrowed(table: str) -> DataFrame:
        df = tables[table]
        for column, wanted in where.items():
            if owners[column] == table:
                df = df.where(_holds(column, wanted))
        return df

    dims = [d for d in DECLARED[measure.fact] if d in owners.values()]
    keys = [DECLARED[measure.fact][d] for d in dims]
    held = list(dict.fromkeys([*keys, *[c for c in by if owners[c] == measure.fact]]))
    parts = [F.expr(value).alias(part) for part, value in measure.parts.items()]
    rows = narrowed(measure.fact).groupBy(*held).agg(*parts)
    if dims:
        for dim, key in zip(dims, keys):
            wanted = [c for c in by if owners[c] == dim and c != key]
            rows = rows.join(narrowed(dim).select(key, *wanted), key)
        # a count over no rows is 0, as it is without a join; other sums stay null
        total = {
            part: F.coalesce(F.sum(part), F.lit(0)) if value.startswith("count") else F.sum(part)
            for part, value in measure.parts.items()
        }
        rows = rows.groupBy(*by).agg(*[value.alias(part) for part, value in total.items()])
    result = rows.select(*by, F.expr(measure.value).cast(measure.dtype).alias(name))
    if by:
        result = result.orderBy(F.desc(name), *by)
    return result if limit is None else result.limit(limit)


def users_by_plan(tables: Tables) -> DataFrame:
    return metric(tables, "user_count", ["plan"])


def titles_by_genre(tables: Tables) -> DataFrame:
    return metric(tables, "title_count", ["genre"])


def watch_by_plan(tables: Tables) -> DataFrame:
    """Mean minutes per play."""
    return metric(tables, "avg_watch_minutes", ["plan"])


def free_high_band(tables: Tables) -> DataFrame:
    return metric(tables, "high_propensity_users", where={"plan": "Free"})


def _percent(part: Column, whole: Column, places: int) -> Column:
    share = part.cast("decimal(20,0)") * 100 / whole.cast("decimal(20,0)")
    return F.round(share, places).cast("double")


def _mean(total: Column, n: Column, places: int) -> Column:
    """Half-up mean of whole numbers, taken as a decimal."""
    return F.round(total.cast("decimal(20,0)") / n.cast("decimal(20,0)"), places).cast("double")


def churn_by_plan(tables: Tables) -> DataFrame:
    """``plan, total, churn_pct``, the largest plan first."""
    gone = F.sum(flag(F.col("status") == CANCELLED))
    return (
        tables["users"].groupBy("plan")
        .agg(F.count("*").alias("total"), _percent(gone, F.count("*"), 1).alias("churn_pct"))
        .orderBy(F.desc("total"), "plan")
    )


def events_by_kind(tables: Tables) -> DataFrame:
    """``event, total, avg_minutes``, the most frequent first."""
    mean = _mean(F.sum("watch_min"), F.count("watch_min"), 1)
    return (
        tables["plays"].groupBy("event")
        .agg(F.count("*").alias("total"), mean.alias("avg_minutes"))
        .orderBy(F.desc("total"), "event")
    )


def features_by_status(tables: Tables) -> DataFrame:
    """How engagement differs between those who left and those who stayed."""
    n = F.count("*")
    rate = F.sum("completion_rate") / n
    return tables["user_features"].groupBy("status").agg(
        n.alias("n_users"),
        _mean(F.sum("n_events"), n, 1).alias("avg_events"),
        _mean(F.sum("watch_total"), n, 0).alias("avg_watch_total"),
        F.round(rate, 3).cast("double").alias("avg_completion"),
    )


def top_titles_views(tables: Tables, k: int = 10) -> DataFrame:
    """Views by title text and genre: titles that share both are one line. Plays are counted per
    title before titles are joined."""
    views = tables["plays"].groupBy("content_id").agg(F.count("*").alias("views"))
    named = views.join(tables["titles"].select("content_id", "title", "genre"), "content_id")
    total = named.groupBy("title", "genre").agg(F.sum("views").alias("views"))
    return top_k(total, "views", k, ["title", "genre"])


def top_titles_minutes(tables: Tables, k: int = 10) -> DataFrame:
    """Minutes watched by title, each ``content_id`` for itself."""
    minutes = tables["plays"].groupBy("content_id").agg(F.sum("watch_min").alias("minutes"))
    named = minutes.join(tables["titles"].select("content_id", "title"), "content_id")
    return top_k(named, "minutes", k, "content_id").select("content_id", "title", "minutes")


def user_profile(tables: Tables, ids: DataFrame) -> DataFrame:
    """Everything known about the users in ``ids``: registration, features, scores. An id no user has
    is left out; a user without a score has nulls there."""
    wanted = ids.select("user_id").distinct()
    engagement = ["tenure_days", "n_events", "watch_total", "completion_rate", "recency_days"]
    return (
        tables["users"].join(wanted, "user_id", "left_semi")
        .select("user_id", "name", "plan", "status", "state", "age_band", "main_device", "signup_date")
        .join(tables["user_features"].select("user_id", *engagement), "user_id", "left")
        .join(tables["churn_scores"].select("user_id", "prob_churn", "risk_band"), "user_id", "left")
        .join(tables["upgrade_scores"].select("user_id", "prob_upgrade", "band"), "user_id", "left")
    )



"""Declared schemas of the tables, and the check operators make on entry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


TITLES = _schema(
    ("content_id", _S), ("title", _S), ("kind", _S), ("genre", _S), ("genre2", _S), ("year", _I),
    ("rating_class", _S), ("language", _S), ("country", _S), ("director", _S), ("cast_names", _S),
    ("score_avg", _D), ("seasons", _I), ("duration_min", _I), ("synopsis", _S),
)
USERS = _schema(
    ("user_id", _S), ("name", _S), ("email", _S), ("plan", _S), ("state", _S), ("age_band", _S),
    ("main_device", _S), ("signup_date", T.DateType()), ("status", _S),
)
PLAYS = _schema(
    ("event_id", _S), ("user_id", _S), ("content_id", _S), ("ts", T.TimestampNTZType()),
    ("event", _S), ("device", _S), ("pct_watched", _D), ("watch_min", _I),
)
HELP_ARTICLES = _schema(
    ("doc_id", _S), ("position", _L), ("title", _S), ("body", _S), ("source", _S), ("updated", _S),
)
USER_FEATURES = _schema(
    ("user_id", _S), ("plan", _S), ("state", _S), ("age_band", _S), ("main_device", _S),
    ("tenure_days", _I), ("status", _S), ("n_events", _L), ("watch_total", _L), ("watch_avg", _D),
    ("pct_avg", _D), ("completion_rate", T.DecimalType(15, 5)), ("n_genres", _L), ("n_devices", _L),
    ("recency_days", _I),
)
CHURN_SCORES = _schema(
    ("user_id", _S), ("plan", _S), ("status", _S), ("prob_churn", _D), ("risk_band", _S),
)
UPGRADE_SCORES = _schema(("user_id", _S), ("plan", _S), ("prob_upgrade", _D), ("band", _S))


def require(df: DataFrame, schema: T.StructType, *columns: str) -> DataFrame:
    """``df`` itself, if it has the named columns (all, by default) in their declared types.

    A timestamp with or without zone passes for either, and a key of any atomic type passes for a
    string key: sources differ in both, and no operator depends on it.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in schema.fields:
        if columns and field.name not in columns:
            continue
        if field.name not in have:
            problems.append(f"missing column {field.name}")
        elif not _fits(field, have[field.name]):
            found = have[field.name].simpleString()
            problems.append(f"{field.name} is {found}, not {field.dataType.simpleString()}")
    if problems:
        raise ValueError("; ".join(problems))
    return df


def _fits(field: T.StructField, found: T.DataType) -> bool:
    stamps = (T.TimestampType, T.TimestampNTZType)
    if isinstance(field.dataType, stamps):
        return isinstance(found, stamps)
    if field.name.endswith("_id"):
        return isinstance(found, (T.StringType, T.IntegralType))
    return type(found) is type(field.dataType)

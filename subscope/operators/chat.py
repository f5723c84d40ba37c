"""Conversation tables: roles, plain text, and the system message in front."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.functions.content import flatten_content

ROLES = ("user", "assistant", "system", "developer")
SYSTEM_TURN = -1


def normalize_roles(df: DataFrame, role: str = "role") -> DataFrame:
    """Message rows only, with ``developer`` read as ``system``."""
    named = F.when(F.col(role) == "developer", "system").otherwise(F.col(role))
    return df.where(F.col(role).isin(*ROLES)).withColumn(role, named)


def chat_messages(
    items: DataFrame, system_text: str, conv_id: str = "conv_id", content: str = "content"
) -> DataFrame:
    """``conv_id, turn, role, content`` of every request, a system message at turn -1 in front.

    Items keep their turn; ordering by ``conv_id, turn`` gives the message list. A conversation whose
    items are all dropped still has its system message. Only conversation keys are shuffled.
    """
    messages = normalize_roles(items).select(
        conv_id, "turn", "role", flatten_content(F.col(content)).alias("content")
    )
    turn = items.schema["turn"].dataType
    opening = items.select(conv_id).distinct().select(
        conv_id,
        F.lit(SYSTEM_TURN).cast(turn).alias("turn"),
        F.lit("system").alias("role"),
        F.lit(system_text).alias("content"),
    )
    return opening.unionByName(messages)

"""Intermediate tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from subscope.settings import shared_folder


def folder(df: DataFrame, name: str) -> str:
    """A path of its own in the folder that all executors share."""
    return f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written as Parquet and read again.

    Later plans start from the files, with their true size: a checkpoint would keep the size that was
    estimated, which joins in a loop multiply round after round until the number itself fills the driver.
    """
    path = folder(df, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

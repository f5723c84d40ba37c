"""Names, clock and seed shared by a run, and the session to test with."""

from __future__ import annotations

import datetime as dt
import tempfile
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

CANCELLED, ACTIVE = "Cancelado", "Ativo"
FREE, PAID_PLANS = "Free", ("Standard", "Premium")
COMPLETE = "complete"
RISK_BANDS = ("Baixo", "Médio", "Alto")
PROPENSITY_BANDS = ("Baixa", "Média", "Alta")
BAND_EDGES = (0.3, 0.6)
NEVER_WATCHED_DAYS = 999
ARROW_BYTES = 4 << 20


@dataclass(frozen=True)
class Settings:
    """One participant's namespace; every job takes its clock and seed from here."""

    database: str = "subscope"
    as_of: dt.date = dt.date(2024, 1, 31)
    seed: int = 42

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"


def local_session(
    cores: int | str = 8, shuffle_partitions: int = 8, warehouse: str | None = None
) -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("subscope")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if warehouse is not None:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local master may go without: there the machine's own temporary folder is shared by
    definition. A cluster that names no folder is refused rather than given a machine-local one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="subscope-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def small_batches(spark: SparkSession) -> None:
    """Workers get rows in Arrow batches of ``ARROW_BYTES`` at most, or of fewer if the session says so.

    Spark's own bound is a number of rows: of long texts, a batch is tens of megabytes in the executor and in the worker.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = spark.conf.get(name, None)
    if given is None or not given.isdigit() or int(given) > ARROW_BYTES:
        spark.conf.set(name, str(ARROW_BYTES))


def cut(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared folder, so that reusing it neither recomputes it nor loses it."""
    shared_folder(df.sparkSession)
    return df.checkpoint()

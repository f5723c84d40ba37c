"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _is_path(target: str) -> bool:
    return "/" in target


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """A catalog table by name, or a Parquet table by path."""
    return spark.read.parquet(target) if _is_path(target) else spark.table(target)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or a folder at ``path``, on whichever file system it is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def file_versions(df: DataFrame) -> list[tuple[str, int, int]]:
    """The files that ``df`` is read from, with the time and size of each."""
    spark, found = df.sparkSession, []
    for name in sorted(df.inputFiles()):
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        status = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at)
        found.append((name, status.getModificationTime(), status.getLen()))
    return found


def spread_scan(scan: DataFrame, key: str) -> DataFrame:
    """A scan with fewer partitions than there are cores, spread over them by ``key``; any other as it
    is. For a table of few files that heavy work per row follows."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)


def write_table(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Replace the table, schema included, and return it as stored.

    ``target`` is a path or a table name. A partitioned table is first clustered on its partition
    columns and a spread of the rest, so that a hot partition value is written by many tasks and a
    rare one does not leave a file per task.
    """
    if partition_by:
        df = _cluster(df, partition_by)
    writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if _is_path(target):
        writer.save(target)
        reader = df.sparkSession.read.format(fmt)
        if fmt == "parquet":  # partition values keep their type, and an empty table its columns
            reader = reader.schema(df.schema)
        return reader.load(target)
    writer.saveAsTable(target)
    return df.sparkSession.table(target)


def _cluster(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    # REBALANCE lets AQE split a hot value over several tasks and merge the small ones.
    return df.hint("rebalance", *partition_by)


def write_report(df: DataFrame, name: str) -> DataFrame:
    """One row: the table's name and how many rows it holds."""
    return df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str] = ()) -> DataFrame:
    """A few rows to look at."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def drop_dataset(
    spark: SparkSession, name: str, tables: Sequence[str] = (), confirm: bool = False
) -> list[str]:
    """Drop the named tables of a schema, or the whole schema when none is named.

    Does nothing but list what it would drop unless ``confirm`` is given.
    """
    if tables:
        statements = [f"DROP TABLE IF EXISTS {name}.{table}" for table in tables]
    else:
        statements = [f"DROP SCHEMA IF EXISTS {name} CASCADE"]
    if confirm:
        for statement in statements:
            spark.sql(statement)
    return statements

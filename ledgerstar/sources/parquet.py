"""Parquet tables, flat or partitioned into folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Scan a Parquet table.

    For a partitioned one, a ``schema`` that names the partition columns as strings keeps
    '01' as it is; without it they are read as numbers. A filter on them skips folders.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write a flat table; returns it as read from ``path``."""
    df.write.mode(mode).parquet(path)
    return read_parquet(df.sparkSession, path, df.schema)


def write_observed(
    df: DataFrame, path: str, figures: dict[str, Column], mode: str = "overwrite"
) -> tuple[DataFrame, dict[str, int]]:
    """Write a flat table and gather aggregates over its rows on the way; nothing is read twice.

    The figures are taken in the tasks that write, the last of the job, whose results Spark
    counts once per partition also when a task is repeated.
    """
    if not figures:
        return write_parquet(df, path, mode), {}
    seen = Observation()
    named = [figure.alias(name) for name, figure in figures.items()]
    written = write_parquet(df.observe(seen, *named), path, mode)
    return written, dict(seen.get)


def write_partitioned(
    df: DataFrame,
    path: str,
    columns: list[str],
    replace_touched_only: bool = False,
    rebalance: bool = True,
    even_folders: bool = False,
) -> None:
    """Write a Parquet table in folders by ``columns``.

    ``replace_touched_only`` overwrites just the partitions present in ``df`` and leaves the
    others, for the rerun of single days; otherwise the whole table is replaced.

    ``rebalance`` first brings the rows of a partition together, so that a folder gets few
    files: the adaptive plan sizes the tasks, merges thin partitions and splits one that is too
    large, such as a hot day, over several tasks. Input ordered by day does not need it.

    ``even_folders`` shares the folders evenly among the tasks instead, for very many thin
    partitions, where opening files takes the time. A task then writes whole partitions,
    however large, so it is for input whose largest partition one task can write.
    """
    if even_folders:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(tasks, *columns)
    elif rebalance:
        df = df.hint("rebalance", *columns)
    writer = df.write.mode("overwrite").partitionBy(*columns)
    overwrite = "dynamic" if replace_touched_only else "static"
    writer.option("partitionOverwriteMode", overwrite).parquet(path)

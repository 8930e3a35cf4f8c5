"""Named tables: sources by name, views, catalog tables over Parquet, bulk loads."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Rows that a bucket holds on average. A task sorts a bucket, so this bounds its memory.
BUCKET_ROWS = 500_000


class Sources:
    """Source tables by name, each a Parquet path or, with no path given, a catalog table."""

    def __init__(self, spark: SparkSession, paths: dict[str, str | None]):
        self._spark = spark
        self._paths = dict(paths)

    def __getitem__(self, name: str) -> DataFrame:
        path = self._paths[name]
        return self._spark.table(name) if path is None else self._spark.read.parquet(path)

    def names(self) -> list[str]:
        return sorted(self._paths)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a view: nothing is computed until the view is read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def save_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Write ``df`` as a Parquet table at ``path`` under ``name``, replacing its content."""
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def table_from_parquet(
    spark: SparkSession, name: str, path: str, partitioned: bool = False
) -> DataFrame:
    """A catalog table over existing files, its columns taken from the Parquet metadata."""
    spark.catalog.createTable(name, path=path, source="parquet")
    if partitioned:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def register_partitions(
    spark: SparkSession, name: str, columns: list[str], rows: list[tuple], path: str
) -> DataFrame:
    """Tell a partitioned table of the folders of some partitions; no other folder is listed.

    ``rows`` has the values of the partition ``columns``. A partition that the table knows stays
    as it is, and its files are read anew. One statement names a bounded number of partitions.
    """
    for at in range(0, len(rows), 500):
        parts = []
        for values in rows[at : at + 500]:
            named = ", ".join(f"{c} = '{v}'" for c, v in zip(columns, values))
            folder = "/".join(f"{c}={v}" for c, v in zip(columns, values))
            parts.append(f"PARTITION ({named}) LOCATION '{path}/{folder}'")
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts)}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def partitioned_table(
    spark: SparkSession, name: str, schema: StructType, columns: list[str], path: str
) -> None:
    """A catalog table over folders by ``columns``, none of which it knows yet."""
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(columns)
    spark.sql(f"CREATE TABLE {name} ({types}) USING parquet PARTITIONED BY ({by}) LOCATION '{path}'")


def bucket_count(*tables: DataFrame, least: int = 8) -> int:
    """Buckets for tables that are to be bucketed alike, as many as the longest of them needs.

    Rows are counted, which reads no more than the footers of Parquet files.
    """
    rows = max(df.count() for df in tables)
    return max(least, math.ceil(rows / BUCKET_ROWS))


def save_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a table in ``buckets`` by hash of ``keys``, each sorted by them.

    Tables that are bucketed alike join on these keys where they lie: neither side moves, however
    often they are joined. One file per bucket, as the rows are brought together first.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def empty_table_like(spark: SparkSession, name: str, like_path: str, path: str) -> DataFrame:
    """An empty table at ``path`` with the columns of the Parquet files at ``like_path``."""
    schema = spark.read.parquet(like_path).schema
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    return spark.table(name)


def copy_into(
    spark: SparkSession, name: str, path: str, mode: str = "overwrite"
) -> DataFrame:
    """Load the Parquet files at ``path`` into a table, matching columns by name.

    By default they replace its rows, so a load that is run again changes nothing.
    ``mode="append"`` adds them to what is there, and adds them again in each call.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode}")
    columns = spark.table(name).columns
    loaded = spark.read.parquet(path).select(*columns)
    loaded.write.insertInto(name, overwrite=mode == "overwrite")
    return spark.table(name)

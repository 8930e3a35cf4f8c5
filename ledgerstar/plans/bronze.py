"""Landing CSV to Parquet: a change of format only, the fact in folders by day."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ledgerstar.functions.dates import day_parts
from ledgerstar.schemas import BRONZE_FACT, DAY_PARTITIONS, LANDING_DIMENSIONS, LANDING_FACT
from ledgerstar.session import in_parallel
from ledgerstar.sources.csv import read_csv
from ledgerstar.sources.parquet import read_parquet, write_parquet, write_partitioned


def with_day(fact: DataFrame, ts: str = "trans_date_trans_time") -> DataFrame:
    """Add the partition columns year, month and day."""
    return fact.withColumns(day_parts(ts))


def bronze_dimension(
    spark: SparkSession, landing: str, out: str, name: str, **options
) -> DataFrame:
    """Convert one dimension; every column stays text. ``options`` go to the CSV reader."""
    landed = read_csv(spark, f"{landing}/{name}", LANDING_DIMENSIONS[name], **options)
    return write_parquet(landed, f"{out}/{name}")


def bronze_fact(
    spark: SparkSession,
    landing: str,
    out: str,
    days_only: bool = False,
    even_folders: bool = False,
    **options,
) -> DataFrame:
    """Convert the fact; ``days_only`` replaces just the days found in ``landing``."""
    fact = with_day(read_csv(spark, f"{landing}/fact_transactions", LANDING_FACT, **options))
    path = f"{out}/fact_transactions"
    write_partitioned(fact, path, DAY_PARTITIONS, days_only, even_folders=even_folders)
    return read_parquet(spark, path, BRONZE_FACT)


def bronze(
    spark: SparkSession,
    landing: str,
    out: str,
    days_only: bool = False,
    even_folders: bool = False,
    **options,
) -> dict[str, DataFrame]:
    """All four tables, as written; ``days_only`` replaces just the landed days of the fact."""
    jobs = {
        name: partial(bronze_dimension, spark, landing, out, name, **options)
        for name in LANDING_DIMENSIONS
    }
    fact = partial(bronze_fact, spark, landing, out, days_only, even_folders, **options)
    return in_parallel(jobs | {"fact_transactions": fact})


def read_bronze(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    schemas = LANDING_DIMENSIONS | {"fact_transactions": BRONZE_FACT}
    return {name: read_parquet(spark, f"{path}/{name}", s) for name, s in schemas.items()}

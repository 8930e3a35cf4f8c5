"""Counts and profiles of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """One row: the null count of every column, in one pass."""
    return df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])


def row_counts(df: DataFrame) -> DataFrame:
    """One row: rows, distinct_rows, duplicates. Counts equal rows first, so one scan does."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    rows = F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint")
    distinct = F.count(F.lit(1))
    return groups.agg(
        rows.alias("rows"), distinct.alias("distinct_rows"), (rows - distinct).alias("duplicates")
    )


def distinct_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: the number of distinct keys; null counts as a value."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("distinct_keys"))


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per column: (position, column, type, rows, nulls, distinct).

    ``distinct`` ignores nulls. The exact form groups each column on its own: every branch
    reads one column and combines equal values before the shuffle, where one aggregate over
    all columns would copy each row once per column. ``approximate`` takes a single pass
    without any shuffle of values.
    """
    if approximate:
        return _approximate_profile(df)
    parts = []
    for position, (name, type_) in enumerate(df.dtypes):
        groups = df.groupBy(F.col(name).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
        null_rows = F.when(F.col("_value").isNull(), F.col("_rows"))
        parts.append(
            groups.agg(
                F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("rows"),
                F.coalesce(F.sum(null_rows), F.lit(0)).cast("bigint").alias("nulls"),
                F.count("_value").alias("distinct"),
            ).select(
                F.lit(position).alias("position"),
                F.lit(name).alias("column"),
                F.lit(type_).alias("type"),
                "*",
            )
        )
    return reduce(DataFrame.unionAll, parts)


def _approximate_profile(df: DataFrame) -> DataFrame:
    figures = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(name).alias(f"_present{i}") for i, name in enumerate(df.columns)],
        *[F.approx_count_distinct(name).alias(f"_distinct{i}") for i, name in enumerate(df.columns)],
    )
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column"),
            F.lit(type_).alias("type"),
            F.col("_rows").alias("rows"),
            (F.col("_rows") - F.col(f"_present{i}")).alias("nulls"),
            F.col(f"_distinct{i}").alias("distinct"),
        )
        for i, (name, type_) in enumerate(df.dtypes)
    ]
    return figures.select(F.inline(F.array(*lines)))


def schema_report(df: DataFrame, count_nulls: bool = False) -> DataFrame:
    """One row per column: (position, column, type), from the metadata alone.

    ``count_nulls`` adds ``nulls``, for which every column is read once.
    """
    if not count_nulls:
        rows = [(i, name, type_) for i, (name, type_) in enumerate(df.dtypes)]
        return df.sparkSession.createDataFrame(rows, "position int, column string, type string")
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column"),
            F.lit(type_).alias("type"),
            F.col(f"_nulls{i}").alias("nulls"),
        )
        for i, (name, type_) in enumerate(df.dtypes)
    ]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_nulls{i}") for i, c in enumerate(df.columns)]
    return df.agg(*nulls).select(F.inline(F.array(*lines)))

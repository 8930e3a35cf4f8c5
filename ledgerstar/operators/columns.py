"""Projection and casting of whole column sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_at(df: DataFrame, position: int = 0) -> DataFrame:
    """Drop the column at ``position``."""
    return df.drop(df.columns[position])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Keep the columns named in ``names``, in that order, under their new names."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def spread(df: DataFrame, struct: Column) -> DataFrame:
    """Add every field of one struct expression as a column."""
    return df.withColumn("_spread", struct).select(*df.columns, "_spread.*")


def cast_columns(df: DataFrame, types: dict[str, str], strict: bool = True) -> DataFrame:
    """Cast the named columns in one projection.

    ``strict`` fails the job on a malformed value, as ANSI casts do; otherwise it becomes null.
    """
    return df.withColumns(
        {
            name: F.col(name).cast(type_) if strict else F.col(name).try_cast(type_)
            for name, type_ in types.items()
        }
    )


def _malformed(types: dict[str, str]) -> Column:
    """True where a value is present but does not cast."""
    tests = [
        F.col(name).isNotNull() & F.col(name).try_cast(type_).isNull()
        for name, type_ in types.items()
    ]
    return reduce(Column.__or__, tests)


def split_casts(df: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The rows that cast, cast; and the rows that do not, as they came (the quarantine)."""
    bad = _malformed(types)
    return cast_columns(df.filter(~bad), types, strict=False), df.filter(bad)


def to_int(column: str | Column) -> Column:
    """An int from text that may be written as a float ('1257.0'); null if not a whole number."""
    number = (F.col(column) if isinstance(column, str) else column).try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def preview(df: DataFrame, by: str | Column | list, rows: int = 20) -> DataFrame:
    """The first rows in a stated order; each task keeps only its own first rows."""
    by = by if isinstance(by, list) else [by]
    return df.orderBy(*by).limit(rows)

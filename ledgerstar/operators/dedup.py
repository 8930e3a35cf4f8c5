"""Concatenation, duplicates, latest rows and sorting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerstar.session import materialize
from ledgerstar.sources.snapshots import Snapshots, version_name


def concat(*frames: DataFrame) -> DataFrame:
    """Stack tables by column name; duplicates stay, columns missing in one become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def latest_per_key(
    df: DataFrame,
    keys: list[str],
    newest: str,
    tie_break: list[str] | None = None,
    few_keys: bool = False,
) -> DataFrame:
    """The row with the greatest ``newest`` per key; null keys form one group.

    Ties go to the lowest values of ``tie_break``, by default every other column, so the
    result is the same in each run. Filtering on row number 1 lets Spark keep one row per
    key and task before the shuffle, so a hot key never moves more rows than there are tasks.

    ``few_keys`` says that there are far fewer keys than rows. Then the greatest ``newest``
    of each key is found first, by hashing, and only rows that have it are sorted. ``df`` is
    read twice for that, so it should be cheap to read; ``newest`` is not text, which Spark
    does not aggregate by hashing.
    """
    if tie_break is None:
        tie_break = [name for name in df.columns if name not in {*keys, newest}]
    if few_keys:
        df = _newest_rows(df, keys, newest)
    order = [F.desc_nulls_last(newest), *[F.asc_nulls_last(name) for name in tie_break]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def _newest_rows(df: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """The rows that hold the greatest ``newest`` of their key.

    The greatest values are written first, so that the join knows their true size: Spark
    broadcasts them if they fit, and shuffles both sides if not.
    """
    greatest = materialize(df.groupBy(*keys).agg(F.max(newest)), "newest")
    names = [f"_latest{i}" for i in range(len(keys) + 1)]
    greatest = greatest.toDF(*names)
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip([*keys, newest], names)]
    return df.join(greatest, reduce(Column.__and__, same), "left_semi")


class LatestRows:
    """The latest row per key, kept up to date from new rows alone.

    The state is one row per key. The latest of a key's old and new rows is the latest of all,
    as ``latest_per_key`` orders rows in full, so batches may come in any order, overlap, or come
    again. Rows cannot be taken back. Each update writes a new version, which readers see when
    it is whole; the last two versions are kept.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        keys: list[str],
        newest: str,
        tie_break: list[str] | None = None,
    ):
        self.spark, self.keys, self.newest, self.tie_break = spark, keys, newest, tie_break
        self.snapshots = Snapshots(spark, folder)

    def read(self) -> DataFrame:
        return self.snapshots.read("latest")

    def update(self, rows: DataFrame) -> DataFrame:
        """Take in ``rows``, which are cut to one per key before they meet the state."""
        latest = self._latest(rows)
        if self.snapshots.current() is not None:
            latest = self._latest(latest.unionByName(self.read()))
        version = version_name()
        latest.write.parquet(f"{self.snapshots.path(version)}/latest")
        self.snapshots.publish(version)
        self.snapshots.expire(keep=2)
        return self.read()

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.keys, self.newest, self.tie_break)


def sort_rows(
    df: DataFrame, ascending: list[str], descending: list[str] | tuple[str, ...] = ()
) -> DataFrame:
    """Sort by the ascending columns, then the descending ones; missing values come last.

    Rows that tie are ordered by the other columns. That makes the order repeatable and lets
    the sort cut a large group of ties into ranges instead of handing it to one task.
    """
    others = [name for name in df.columns if name not in {*ascending, *descending}]
    return df.orderBy(
        *[F.asc_nulls_last(name) for name in ascending],
        *[F.desc_nulls_last(name) for name in descending],
        *[F.asc_nulls_last(name) for name in others],
    )

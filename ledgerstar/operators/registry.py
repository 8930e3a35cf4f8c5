"""Keys that stay the same when the other attributes of what they name change."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.session import file_system, materialize


class KeyRegistry:
    """A table of natural keys and the ids they were given when first seen.

    ``natural`` maps the columns that identify a record to their types. Ids are never changed or
    given twice: a load finds those of known keys and appends the others. The table only grows
    by Spark's committed appends, so a load that broke off, or runs again, gives the same ids.
    One load at a time may write.
    """

    def __init__(self, spark: SparkSession, path: str, natural: dict[str, str], key: str):
        self.spark, self.path, self.natural, self.key = spark, path, dict(natural), key

    def read(self) -> DataFrame:
        """(natural key columns, id); no rows before the first load."""
        columns = [f"`{name}` {type_}" for name, type_ in self.natural.items()]
        schema = ", ".join([*columns, f"`{self.key}` string"])
        place, system = file_system(self.spark, self.path)
        if not system.exists(place):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def _same(self, left: DataFrame, right: DataFrame) -> Column:
        tests = [left[name].eqNullSafe(right[f"_{name}"]) for name in self.natural]
        return reduce(Column.__and__, tests)

    def _known(self) -> DataFrame:
        return self.read().toDF(*[f"_{name}" for name in self.natural], f"_{self.key}")

    def register(self, records: DataFrame, new_id: Column) -> int:
        """Give ids to natural keys not seen before; returns how many there were.

        ``new_id`` is an expression over ``records``; of several records with one key the
        smallest counts. Keys are grouped before they meet the registry, so a key with very many
        records moves one row per task. A null part of a key is a value like any other.
        """
        known = self._known()
        found = records.groupBy(*self.natural).agg(F.min(new_id).alias(self.key))
        # Written first: a job may not read the table that it appends to.
        found = materialize(found, "keys")
        fresh = materialize(found.join(known, self._same(found, known), "left_anti"), "new_keys")
        count = fresh.count()
        if count:
            fresh.write.mode("append").parquet(self.path)
        return count

    def attach(self, records: DataFrame) -> DataFrame:
        """``records`` with the id of each row's natural key, null if it was never registered."""
        known = self._known()
        joined = records.join(known, self._same(records, known), "left")
        columns: Sequence[Column] = [records[c] for c in records.columns if c != self.key]
        return joined.select(*columns, F.col(f"_{self.key}").alias(self.key))

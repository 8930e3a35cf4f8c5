"""Column profiles of any range of days, from sketches kept per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.operators.day_checks import DayBatches
from ledgerstar.schemas import DAY_PARTITIONS

#: A sketch has 2 to this power buckets.
LOG_BUCKETS = 12
#: Bound of the relative error of a distinct count, three standard errors.
ERROR_BOUND = 3 * 1.04 / 2 ** (LOG_BUCKETS / 2)

_SKETCHED = {"int", "bigint", "string", "binary"}


class DaySketches(DayBatches):
    """Per day and column: rows, nulls, and a HyperLogLog sketch of the values.

    Sketches of days merge into that of any range of them, so a profile over days reads a few
    kilobytes per day and column and none of the table's rows. ``distinct`` is off by at most
    ``ERROR_BOUND`` of itself, but in a case in some hundreds. Values of types that a sketch
    does not take count as text.
    """

    _schemas = {
        "columns": "day string, position int, column string, type string, rows bigint, "
        "nulls bigint, sketch binary"
    }

    def __init__(self, spark: SparkSession, folder: str, days: Sequence[str] = DAY_PARTITIONS):
        super().__init__(spark, folder, days)

    def _figures(self, touched: DataFrame) -> dict[str, DataFrame]:
        """One pass over the rows of the touched days."""
        columns = [(name, type_) for name, type_ in touched.dtypes if name != "day"]
        figures, lines = [F.count(F.lit(1)).alias("_rows")], []
        for i, (name, type_) in enumerate(columns):
            value = F.col(f"`{name}`")
            if type_ not in _SKETCHED:
                value = value.cast("string")
            figures += [
                F.count_if(value.isNull()).alias(f"_nulls{i}"),
                F.hll_sketch_agg(value, LOG_BUCKETS).alias(f"_sketch{i}"),
            ]
            lines.append(
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(name).alias("column"),
                    F.lit(type_).alias("type"),
                    F.col("_rows").alias("rows"),
                    F.col(f"_nulls{i}").alias("nulls"),
                    F.col(f"_sketch{i}").alias("sketch"),
                )
            )
        daily = touched.groupBy("day").agg(*figures)
        return {"columns": daily.select("day", F.inline(F.array(*lines)))}

    def profile(
        self, first: str | None = None, last: str | None = None, staged: DayBatches | None = None
    ) -> DataFrame:
        """(position, column, type, rows, nulls, distinct) of the days from ``first`` to ``last``.

        Days are written as the day columns joined by ``-``; both ends belong to the range.
        """
        found = self._merged("columns", staged)
        if first is not None:
            found = found.filter(F.col("day") >= first)
        if last is not None:
            found = found.filter(F.col("day") <= last)
        return found.groupBy("position", "column", "type").agg(
            F.sum("rows").alias("rows"),
            F.sum("nulls").alias("nulls"),
            F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"),
        )

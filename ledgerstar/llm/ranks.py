"""Row numbers within groups of any size, by a global sort. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerstar.session import materialize

#: Rows that are numbered together.
BLOCK = 4096


def ranked(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``rank`` from 0 within each ``key``, in ascending ``order``, nulls first.

    Rows are sorted over ranges of key and order, so a key with very many rows is spread over
    tasks. Each is then numbered within its block of at most ``BLOCK`` neighbours, and the
    blocks of a key, one row each, are summed up. Rows that tie in all of ``order`` are
    numbered in any order; they should be alike.
    """
    ordered = rows.orderBy(key, *order).withColumn("_place", F.monotonically_increasing_id())
    ordered = materialize(ordered, name)  # a place, once written, stays
    block = F.shiftright("_place", BLOCK.bit_length() - 1)
    ordered = ordered.withColumn("_block", block)
    within = Window.partitionBy(key, "_block").orderBy("_place")
    numbered = ordered.withColumn("_number", F.row_number().over(within) - 1)
    sizes = ordered.groupBy(key, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(
        F.col(key).alias("_key"),
        F.col("_block").alias("_block2"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"),
    )
    same = numbered[key].eqNullSafe(base["_key"]) & (numbered["_block"] == base["_block2"])
    found = numbered.join(base, same).withColumn("rank", F.col("_base") + F.col("_number"))
    return found.select(*rows.columns, "rank")

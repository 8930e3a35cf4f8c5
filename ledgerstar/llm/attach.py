"""Join rows to one row per key when a key may hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with at least one in so many of all rows is hot; so there are at most so many hot keys.
HOT_KEYS = 500


def attach(
    rows: DataFrame, groups: DataFrame, key: str | list[str], size: str, rows_total: int
) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, which has each key once and its rows in ``size``.

    The sizes prove that at most ``HOT_KEYS`` groups are hot, so these few join by broadcast and
    their rows stay where they are. All others meet in a shuffle join. No row is lost or moved
    to one task. ``rows`` is read twice. Keys are not null.
    """
    hot_if = F.col(size) * HOT_KEYS >= F.lit(max(rows_total, HOT_KEYS * 2))
    hot, cold = groups.filter(hot_if), groups.filter(~hot_if)
    hot_keys = F.broadcast(hot.select(*([key] if isinstance(key, str) else key)))
    return rows.join(F.broadcast(hot), key).unionByName(
        rows.join(hot_keys, key, "left_anti").join(cold, key)
    )

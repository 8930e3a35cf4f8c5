"""Keys and choices derived from values.

Nothing here is random: a task that runs again after an executor is lost gives the same
keys, so the links between fact and dimensions hold.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_text(*columns: str | Column) -> Column:
    """One text for several values, different whenever any value differs.

    Each value is preceded by its length, so ('ab', 'c') and ('a', 'bc') differ; null is '-'.
    """
    parts = []
    for column in columns:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        sized = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.concat(*parts)


def surrogate_key(*columns: str | Column) -> Column:
    """A 36-character key, the md5 of the natural key in the 8-4-4-4-12 form."""
    digest = F.md5(key_text(*columns))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def draw(key: str | Column, label: str) -> Column:
    """A number from 0 to 2^32-1 that depends on ``key`` and ``label`` only."""
    key = (F.col(key) if isinstance(key, str) else key).cast("string")
    digest = F.md5(F.concat(key, F.lit(":" + label)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def choose(key: str | Column, label: str, options: list[str] | tuple[str, ...]) -> Column:
    """One of ``options`` per key."""
    position = draw(key, label) % F.lit(len(options)) + 1
    return F.element_at(F.array(*[F.lit(option) for option in options]), position.cast("int"))


def in_range(key: str | Column, label: str, low: int, high: int) -> Column:
    """An int from ``low`` to ``high`` inclusive per key."""
    return (F.lit(low) + draw(key, label) % F.lit(high - low + 1)).cast("int")


def in_steps(key: str | Column, label: str, low: Column, high: Column, step: Column) -> Column:
    """One of low, low+step, ... up to high inclusive per key; the bounds are columns."""
    choices = F.floor((high - low) / step) + 1
    return (low + step * (draw(key, label) % choices)).cast("int")

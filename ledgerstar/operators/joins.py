"""Joins of a large table to its dimensions.

A dimension within the session's broadcast threshold, or so small beside the large table that
copies of it cost less than a shuffle, joins without moving the large table.
Beyond it the join shuffles, and keys that hold a large part of the rows are salted: the
large side spreads them over several tasks and the dimension repeats their few rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.session import UNKNOWN_BYTES, broadcast_threshold, estimated_bytes, materialize

# A key with at least this share of the rows is salted, or with one shuffle partition's
# worth where that is more. Smaller skews are left to the adaptive skew join.
HOT_SHARE = 0.001
# Items a frequency sketch tracks; its error, about 3.5 / this, stays below half of HOT_SHARE.
SKETCH_ITEMS = 8_192

# A dimension of at most so many bytes, by Catalyst's estimate, is broadcast also beyond the
# session's threshold if the large table has so many times its bytes: copies of it for all
# executors are less than what a shuffle of the large table moves.
BROADCAST_MOST = 8 << 20
BROADCAST_RATIO = 50


@dataclass(frozen=True)
class Dimension:
    """A table to join: ``on`` maps columns of the large table to the dimension's key columns.

    ``derived`` says that the table is much smaller than what it is made from, as after a filter
    or ``distinct``. Catalyst sizes it like its parent; so it is written first, trimmed, and its
    true size decides whether it is broadcast. ``large`` never broadcasts: both sides shuffle.
    ``sized_by`` is a table of about its size, where Catalyst's estimate is a product, as of a
    join; it decides whether hot keys are looked for.
    """

    table: DataFrame
    on: dict[str, str]
    columns: Sequence[str] = ()
    derived: bool = False
    large: bool = False
    sized_by: DataFrame | None = None

    def trimmed(self) -> DataFrame:
        """Only what the join needs, with key names that cannot clash."""
        keys = [F.col(key).alias(f"_key{i}") for i, key in enumerate(self.on.values())]
        return self.table.select(*keys, *self.columns)

    def fits_broadcast(self) -> bool:
        most = broadcast_threshold(self.table.sparkSession)
        sized = self.trimmed() if self.sized_by is None else self.sized_by
        return not self.large and estimated_bytes(sized) <= most

    def worth_broadcast(self, fact: DataFrame) -> bool:
        """Whether copies of it move less than a shuffle of ``fact``, though the threshold is
        lower; never where the session has broadcasting off."""
        if self.large or broadcast_threshold(self.table.sparkSession) < 0:
            return False
        own, others = estimated_bytes(self.trimmed()), estimated_bytes(fact)
        return own <= BROADCAST_MOST and own * BROADCAST_RATIO <= others < UNKNOWN_BYTES

    def settled(self) -> Dimension:
        """Itself or, if derived and too large by its estimate, itself over a written table."""
        if not self.derived or self.large or self.fits_broadcast():
            return self
        names = list(dict.fromkeys([*self.on.values(), *self.columns]))
        table = materialize(self.table.select(*names), "dimension")
        return replace(self, table=table, derived=False)


@dataclass(frozen=True)
class HotKeys:
    """Hashes of the hot keys, and into how many pieces to cut each."""

    hashes: tuple[int, ...]
    pieces: int


def hot_keys(
    fact: DataFrame, key_sets: list[list[str]], least_share: float = HOT_SHARE
) -> list[HotKeys]:
    """Find the hot keys of several key sets in one pass over the key columns.

    A key is hot with at least ``least_share`` of the rows, or with a shuffle partition's worth
    where that is more; smaller skews are left to the adaptive skew join.
    Each task builds one small frequency sketch per key set, and groups of tasks merge
    theirs, so neither a task nor the driver sees more than a bounded number of items. The
    result only steers the layout of a join: a missed key costs time, never rows.
    """
    partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(least_share, 1 / partitions)
    most = math.ceil(1 / share)
    names = [f"_hash{i}" for i in range(len(key_sets))]
    hashed = fact.select(
        *[F.xxhash64(*keys).alias(name) for keys, name in zip(key_sets, names)],
        F.pmod(F.spark_partition_id(), F.lit(partitions)).alias("_group"),
    )
    frequent = hashed.groupBy("_group").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.expr(f"approx_top_k({n}, {2 * most}, {SKETCH_ITEMS})").alias(n) for n in names],
    )
    all_rows = F.array(
        F.struct(F.lit(None).cast("bigint").alias("item"), F.col("_rows").alias("count"))
    )
    counts = (
        frequent.select(F.posexplode(F.array(*names, all_rows)).alias("keys", "items"))
        .select("keys", F.inline("items"))
        .groupBy("keys", "item")
        .agg(F.sum("count").alias("rows"))
        .orderBy(F.desc("rows"))
        .limit(most * len(names) + 1)
        .collect()
    )
    rows = max((r["rows"] for r in counts), default=0)
    result = []
    for i in range(len(names)):
        hot = [r for r in counts if r["keys"] == i and r["rows"] > rows * share]
        largest = max((r["rows"] for r in hot), default=0)
        # Half a partition's worth each, as several pieces may land in one partition.
        pieces = max(2, math.ceil(2 * partitions * largest / rows)) if hot else 1
        result.append(HotKeys(tuple(r["item"] for r in hot), min(pieces, partitions)))
    return result


def _same_key(left: str, right: str, null_safe: bool) -> Column:
    return F.col(left).eqNullSafe(F.col(right)) if null_safe else F.col(left) == F.col(right)


def _check_key_types(fact: DataFrame, dim: Dimension) -> None:
    fact_types, dim_types = dict(fact.dtypes), dict(dim.table.dtypes)
    for fact_key, dim_key in dim.on.items():
        if fact_types[fact_key] != dim_types[dim_key]:
            raise TypeError(
                f"key types differ: {fact_key} {fact_types[fact_key]}, "
                f"{dim_key} {dim_types[dim_key]}; cast one side first"
            )


def _join_one(
    fact: DataFrame,
    dim: Dimension,
    how: str,
    null_safe: bool,
    hot: HotKeys | None,
    spread_by: Sequence[str],
    copied: bool = False,
) -> DataFrame:
    _check_key_types(fact, dim)
    table = dim.trimmed()
    if dim.large:
        table = table.hint("merge")
    elif copied:
        table = table.hint("broadcast")
    names = [f"_key{i}" for i in range(len(dim.on))]
    tests = [_same_key(key, name, null_safe) for key, name in zip(dim.on, names)]
    if hot is not None and hot.hashes:
        # The salt is a hash of the row, not a random number, so that a task that runs
        # again sends its rows to the same place.
        fact_hot = F.xxhash64(*dim.on).isin(*hot.hashes)
        row_piece = F.pmod(F.xxhash64(*spread_by), F.lit(hot.pieces)).cast("int")
        all_pieces = F.sequence(F.lit(0), F.lit(hot.pieces - 1))
        fact = fact.withColumn("_salt", F.when(fact_hot, row_piece).otherwise(F.lit(0)))
        dim_hot = F.xxhash64(*names).isin(*hot.hashes)
        table = table.withColumn(
            "_piece", F.explode(F.when(dim_hot, all_pieces).otherwise(F.array(F.lit(0))))
        )
        tests.append(F.col("_salt") == F.col("_piece"))
    joined = fact.join(table, reduce(Column.__and__, tests), how)
    return joined.drop(*names, "_salt", "_piece")


def join_dimensions(
    fact: DataFrame,
    dims: list[Dimension],
    how: str = "inner",
    null_safe: bool = False,
    spread_by: Sequence[str] = (),
    skew_from: DataFrame | None = None,
) -> DataFrame:
    """Join each dimension to ``fact`` in turn: all fact columns, then the chosen ones.

    ``how`` is inner, left, left_semi or left_anti. With ``null_safe``, a null key matches
    a null key. Dimensions that are small enough are left to Catalyst, which broadcasts them.
    ``spread_by`` names fact columns that differ from row to row, used to cut hot keys into
    pieces; all columns by default, which makes the scan read them all. Hot keys are looked
    for in ``fact``, or in ``skew_from`` where that has the same key columns and is cheaper
    to read, such as the table the keys came from.
    """
    spread_by = list(spread_by) or fact.columns
    dims = [dim.settled() for dim in dims]
    beyond = [dim for dim in dims if not dim.fits_broadcast()]
    copied = {id(dim) for dim in beyond if dim.worth_broadcast(fact)}
    large = [dim for dim in beyond if id(dim) not in copied]
    hot = {}
    if large:
        keys = fact if skew_from is None else skew_from
        hot = dict(zip(map(id, large), hot_keys(keys, [list(dim.on) for dim in large])))
    # Small ones first: an inner join may drop rows before the large table moves. Then those
    # that add the fewest columns, as what is added moves along in the next shuffle.
    ordered = sorted(dims, key=lambda dim: (id(dim) in hot, len(dim.columns)))
    joined = reduce(
        lambda df, dim: _join_one(
            df, dim, how, null_safe, hot.get(id(dim)), spread_by, id(dim) in copied
        ),
        ordered,
        fact,
    )
    return joined.select(*fact.columns, *[name for dim in dims for name in dim.columns])


def star_join(
    fact: DataFrame,
    dims: list[Dimension],
    spread_by: Sequence[str] = (),
    skew_from: DataFrame | None = None,
) -> DataFrame:
    """Inner star join; facts with a null or unmatched key drop out, see ``orphan_report``."""
    return join_dimensions(fact, dims, "inner", False, spread_by, skew_from)


def attach_key(
    fact: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    key: str,
    spread_by: Sequence[str] = (),
    derived: bool = False,
) -> DataFrame:
    """Look up ``key`` for every fact row; null keys match, unmatched rows get null.

    A fact row repeats when several dimension rows share its key. ``derived`` as in ``Dimension``.
    """
    return join_dimensions(fact, [Dimension(dim, on, [key], derived)], "left", True, spread_by)


def orphan_rows(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """The child rows whose key is present but missing in the parent."""
    parents = parent.select(parent_key).distinct()
    present = child.filter(F.col(key).isNotNull())
    return join_dimensions(present, [Dimension(parents, {key: parent_key})], "left_anti")


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """The missing keys and how many child rows each has: (key, rows).

    Both sides shrink to distinct keys before they move, so a hot key costs one row per task.
    """
    counts = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    parents = parent.select(F.col(parent_key).alias("_parent")).distinct()
    return counts.join(parents, F.col(key) == F.col("_parent"), "left_anti")


def orphan_report(fact: DataFrame, dims: dict[str, Dimension]) -> DataFrame:
    """Per dimension, the fact rows a star join would lose: (dimension, null_rows, orphan_rows)."""
    parts = []
    for name, dim in dims.items():
        [(key, parent_key)] = dim.on.items()
        counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        parents = dim.table.select(F.col(parent_key).alias("_parent")).distinct()
        matched = counts.join(parents, F.col(key) == F.col("_parent"), "left")
        no_key = F.when(F.col(key).isNull(), F.col("_rows"))
        no_parent = F.when(F.col(key).isNotNull() & F.col("_parent").isNull(), F.col("_rows"))
        parts.append(
            matched.agg(
                F.coalesce(F.sum(no_key), F.lit(0)).cast("bigint").alias("null_rows"),
                F.coalesce(F.sum(no_parent), F.lit(0)).cast("bigint").alias("orphan_rows"),
            ).select(F.lit(name).alias("dimension"), "*")
        )
    return reduce(DataFrame.unionAll, parts)

"""Connected components of an edge table, in rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.attach import attach
from ledgerstar.llm.common import ready_workers
from ledgerstar.session import materialize

#: Edges that one task may take in: 16 MB of longs.
FEW = 1 << 20


def _lowest(edges: DataFrame, key: str, other: str, name: str) -> DataFrame:
    """``other`` is replaced by the lowest of its ``key``; (key, other) must be distinct."""
    lowest = edges.groupBy(key).agg(
        F.least(F.min(other), F.col(key)).alias("lowest"), F.count(F.lit(1)).alias("degree")
    )
    lowest = materialize(lowest, name)
    total = lowest.agg(F.sum("degree")).first()[0] or 0
    return attach(edges, lowest, key, "degree", total)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _at_once(edges: DataFrame) -> DataFrame:
    """The components of at most ``FEW`` edges, joined edge by edge in one task."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
        found = [(x, low) for x in list(parent) if (low := find(x)) != x]
        columns = list(zip(*found)) or [(), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["node", "component"]
        )

    ready_workers(edges.sparkSession)
    return edges.coalesce(1).mapInArrow(join, "node bigint, component bigint")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` (its lowest node) of an undirected table ``a, b`` of distinct longs.

    Alternates two steps until nothing changes: each node's higher neighbours go to its lowest
    neighbour; then its lower neighbours do. Edges never grow in number. A round is a grouped
    minimum and a join that keeps hot nodes in place, written to the shared folder. At most
    ``FEW`` edges, whose rounds would take longer to start than to run, are joined in one task.
    A component's lowest node, and nodes without an edge, are not listed.
    """
    edges = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = materialize(edges.distinct(), name)
    before = _state(edges)
    if before[0] <= FEW:
        return materialize(_at_once(edges), name)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _lowest(materialize(both, name), "a", "b", name)
        large = large.filter("b > a").select(F.col("b").alias("a"), F.col("lowest").alias("b"))
        large = materialize(large.distinct(), name)
        small = _lowest(large, "a", "b", name)
        small = small.select(F.col("b").alias("a"), F.col("lowest").alias("b")).unionByName(
            small.select("a", F.col("lowest").alias("b"))
        )
        edges = materialize(small.filter("a <> b").distinct(), name)
        state = _state(edges)
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state

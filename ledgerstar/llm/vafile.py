"""Centroid clustering over a vector-approximation file: few-bit cells, whole vectors on need."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.llm.common import File, ready_workers, single_rows
from ledgerstar.session import materialize, scratch_path

#: Cells of a dimension are equal parts of the range that a block has there: 2 to this power.
BITS = 7
#: Vectors of a block.
BLOCK = 4096
#: Rows between two wanted ones that are read along rather than skipped.
GAP = 16
#: Components beyond this could give distances beyond 62 bits.
MOST = 1 << 26

_STATE = (
    "block bigint, rows int, file string, position bigint, cells binary, low binary, "
    "high binary, cluster binary, changes array<bigint>"
)
_FOUND = "vec_id bigint, cluster int, distance bigint"


def whole_rows(vectors: DataFrame, dims: int = 64, scale: int = 256) -> DataFrame:
    """``vec_id, vector``: rows of exactly ``dims`` components, each x as floor(scale * x).

    A vector that is null, has another length, or holds a null or non-finite component is left
    out. A null id stays.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v))
    kept = vectors.filter(x.isNotNull() & (F.size(x) == dims) & finite)
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("bigint"))
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("vector"))


def first_centroids(vectors: DataFrame, clusters: int, seed: str) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``seed`` and id; at most ``clusters`` rows.

    Rows that repeat an id follow by their components. Rows without an id do not start one.
    """
    key = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = vectors.filter(F.col("vec_id").isNotNull()).orderBy(key, "vector").limit(clusters)
    return [r["vector"] for r in first.collect()]


def build(vectors: DataFrame, dims: int) -> DataFrame:
    """Index every vector; returns blocks of cells, the whole vectors lie in files of their own.

    A block holds a cell per vector and dimension, the least and greatest component per
    dimension, which fix the cells, and where its vectors lie. A task writes files under new
    names, and only files that the returned table names count.
    """
    spark = vectors.sparkSession
    ready_workers(spark)
    folder = f"{scratch_path(spark, 'vectors')}/data"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, position, out = TaskContext.get().partitionId(), 0, 0, None
        file = f"{folder}/{part:06d}-{uuid.uuid4().hex}.vec"
        ids: list[int | None] = []
        parts: list[np.ndarray] = []

        def block(values: np.ndarray, names: list[int | None]) -> pa.RecordBatch:
            nonlocal made, position, out
            if np.abs(values).max(initial=0) > MOST:
                raise ValueError("components beyond 2^26 cannot be clustered exactly")
            low, high = values.min(axis=0), values.max(axis=0)
            cells = ((values - low) // _width(low, high)).astype(np.uint8)
            known = np.array([i is not None for i in names], "u1")
            numbers = np.array([i or 0 for i in names], "<i8")
            data = values.astype("<i4").tobytes() + numbers.tobytes() + known.tobytes()
            out = out or File.create(file)
            out.write(data)
            row = {
                "block": (part << 32) + made,
                "rows": len(names),
                "file": file,
                "position": position,
                "cells": cells.tobytes(),
                "low": low.tobytes(),
                "high": high.tobytes(),
                "cluster": np.full(len(names), -1, "<i4").tobytes(),
                "changes": None,
            }
            made, position = made + 1, position + len(data)
            return _rows([row])

        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            parts.append(flat.reshape(-1, dims))
            while len(ids) >= BLOCK:
                values = np.concatenate(parts)
                yield block(values[:BLOCK], ids[:BLOCK])
                ids, parts = ids[BLOCK:], [values[BLOCK:]]
        if ids:
            yield block(np.concatenate(parts), ids)
        if out:
            out.close()

    return materialize(vectors.select("vec_id", "vector").mapInArrow(write, _STATE), "cells")


_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("rows", pa.int32()),
        ("file", pa.string()),
        ("position", pa.int64()),
        ("cells", pa.binary()),
        ("low", pa.binary()),
        ("high", pa.binary()),
        ("cluster", pa.binary()),
        ("changes", pa.list_(pa.int64())),
    ]
)


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _ARROW)


def _width(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return ((high - low) >> BITS) + 1


def intervals(row: dict, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance of a block's vectors to each centroid, less a common part.

    With m the mean of the centroids, |x - c|^2 is |x - m|^2, the same for all centroids, plus
    the sum over dimensions of (c - m)(c - m - 2(x - m)). That is linear in x, so a cell bounds
    it far closer than it bounds the square. A table per dimension gives both bounds by cell and
    centroid, and a vector's interval is a sum of entries. All are whole, so none is rounded.
    """
    low, high = np.frombuffer(row["low"], "<i8"), np.frombuffer(row["high"], "<i8")
    width = _width(low, high)
    middle = centroids.sum(axis=0) // len(centroids)
    begin = low[:, None] + width[:, None] * np.arange(1 << BITS)
    begin = np.minimum(begin, high[:, None])
    stop = np.minimum(begin + width[:, None] - 1, high[:, None])
    q = (centroids - middle).T[:, None, :]  # dimension, cell, centroid
    ends = [q * (q - 2 * (x - middle[:, None])[:, :, None]) for x in (begin, stop)]
    tables = [np.minimum(*ends), np.maximum(*ends)]
    if max(np.abs(t).max(axis=(1, 2)).sum() for t in tables) < 1 << 31:
        tables = [t.astype(np.int32) for t in tables]
    cells = np.frombuffer(row["cells"], np.uint8).reshape(row["rows"], -1).T
    sums = [t[0][cells[0]] for t in tables]
    for i in range(1, len(cells)):
        for total, table in zip(sums, tables):
            total += table[i][cells[i]]
    return sums[0], sums[1]


def fetch(row: dict, wanted: np.ndarray, dims: int) -> np.ndarray:
    """Whole vectors of some rows of a block, in ascending order, read in as few runs as may be."""
    size = 4 * dims
    if not len(wanted):
        return np.zeros((0, dims), np.int64)
    cuts = np.flatnonzero(np.diff(wanted) > GAP) + 1
    found = []
    with File.open_at(row["file"]) as stream:
        for run in np.split(wanted, cuts):
            first, last = int(run[0]), int(run[-1])
            raw = stream.read_at((last - first + 1) * size, row["position"] + first * size)
            found.append(np.frombuffer(raw, "<i4").reshape(-1, dims)[run - first])
    return np.concatenate(found).astype(np.int64)


def _ids(row: dict, dims: int) -> pa.Array:
    with File.open_at(row["file"]) as stream:
        raw = stream.read_at(9 * row["rows"], row["position"] + 4 * dims * row["rows"])
    known = np.frombuffer(raw[8 * row["rows"] :], "u1")
    return pa.array(np.frombuffer(raw[: 8 * row["rows"]], "<i8"), mask=known == 0)


def distances(values: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.stack([((values - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _nearest(values: np.ndarray, centroids: np.ndarray, able: np.ndarray) -> tuple[np.ndarray, ...]:
    """Nearest of the ``able`` centroids, the smaller number if two are as near, and how far."""
    away = np.where(able, distances(values, centroids), np.iinfo(np.int64).max)
    nearest = away.argmin(axis=1)
    return nearest, away[np.arange(len(away)), nearest]


def assign(state: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """One round: each block with its vectors' new clusters, and a row of changes per task.

    A vector whose nearest centroid follows from its cells alone is not read, unless it changes
    its cluster: then sums and counts move with it. ``changes`` has the sums, cluster by cluster,
    then the counts and the number of vectors read.
    """
    points = np.array(centroids, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(points.shape, np.int64)
        counts, read = np.zeros(len(points), np.int64), 0
        for row in single_rows(batches):
            near, far = intervals(row, points)
            able = near <= far.min(axis=1)[:, None]
            old = np.frombuffer(row["cluster"], "<i4")
            new = np.where(able.sum(axis=1) == 1, able.argmax(axis=1), -1)
            wanted = np.flatnonzero((new < 0) | (new != old))
            values = fetch(row, wanted, points.shape[1])
            unsure = new[wanted] < 0
            new[wanted[unsure]] = _nearest(values[unsure], points, able[wanted[unsure]])[0]
            for sign, clusters in ((1, new[wanted]), (-1, old[wanted])):
                for k in np.unique(clusters[clusters >= 0]):
                    sums[k] += sign * values[clusters == k].sum(axis=0)
                    counts[k] += sign * (clusters == k).sum()
            read += len(wanted)
            yield _rows([row | {"cluster": new.astype("<i4").tobytes()}])
        if read:
            changes = [*sums.ravel().tolist(), *counts.tolist(), read]
            yield _rows([dict.fromkeys(_ARROW.names) | {"changes": changes}])

    return materialize(state.filter("block is not null").mapInArrow(run, _STATE), "clusters")


def _changes(state: DataFrame) -> dict[int, int]:
    """Changes of all tasks summed: a number per cluster and dimension comes to the driver."""
    rows = (
        state.filter("block is null")
        .select(F.posexplode("changes").alias("at", "change"))
        .groupBy("at")
        .agg(F.sum(F.col("change").cast("decimal(38,0)")).alias("change"))
        .collect()
    )
    return {r["at"]: int(r["change"]) for r in rows}


def _places(state: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Every vector with its nearest centroid and its distance, for which all are read."""
    points = np.array(centroids, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in single_rows(batches):
            near, far = intervals(row, points)
            values = fetch(row, np.arange(row["rows"]), points.shape[1])
            able = near <= far.min(axis=1)[:, None]
            nearest, away = _nearest(values, points, able)
            yield pa.RecordBatch.from_arrays(
                [_ids(row, points.shape[1]), nearest.astype(np.int32), away],
                ["vec_id", "cluster", "distance"],
            )

    return state.filter("block is not null").mapInArrow(run, _FOUND)


def cluster(
    vectors: DataFrame,
    clusters: int = 40,
    rounds: int = 5,
    seed: str = "2:",
    dims: int = 64,
    fetched: list[int] | None = None,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector.

    ``vectors`` has ``vec_id`` and whole-number ``vector`` of ``dims`` components (see
    ``whole_rows``). Centroids start as ``first_centroids``, fewer if there are fewer vectors.
    Each round moves every vector to the nearest (squared Euclidean distance, ties to the
    smaller number) and every non-empty centroid to the floor of its vectors' mean; then vectors
    are assigned once more. Repeated rows count each; an empty table, or one without any id,
    gives no rows. ``fetched`` gets the number of whole vectors read in each round.

    A round is one pass over cells; nothing is shuffled but a row of changes per task, and what
    goes to every task is the centroids.
    """
    spark: SparkSession = vectors.sparkSession
    vectors = materialize(vectors.select("vec_id", "vector"), "whole")
    centroids = first_centroids(vectors, clusters, seed)
    if not centroids:
        schema = f"{_FOUND}, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return spark.createDataFrame([], schema)
    state = build(vectors, dims)
    sums, counts = [[0] * dims for _ in centroids], [0] * len(centroids)
    for _ in range(rounds):
        state = assign(state, centroids)
        moved, size = _changes(state), len(centroids) * dims
        for k, total in enumerate(sums):
            for d in range(dims):
                total[d] += moved.get(k * dims + d, 0)
            counts[k] += moved.get(size + k, 0)
            if counts[k]:
                centroids[k] = [s // counts[k] for s in total]
        if fetched is not None:
            fetched.append(moved.get(size + len(centroids), 0))
    found = materialize(_places(state, centroids), "places")
    inertia = {
        r["cluster"]: r["inertia"]
        for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()
    }
    rows = [
        (
            k,
            inertia.get(k, 0),
            sum(inertia.values()),
            hashlib.sha256(",".join(map(str, c)).encode()).hexdigest(),
        )
        for k, c in enumerate(centroids)
    ]
    # A row per cluster, so its size is bounded by the number of clusters.
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    figures = spark.createDataFrame(rows, schema)
    return found.join(F.broadcast(figures), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

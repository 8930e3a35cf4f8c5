"""Exact largest inner products by a table of distances to pivots."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstar.llm.common import File, ready_workers
from ledgerstar.session import materialize, scratch_path

#: Pivots of the table, and the rows that they are chosen from; both bound what every task gets.
PIVOTS = 32
SAMPLE = 2048
#: Vectors of a block of candidates, and of a block of queries.
CANDIDATES = 4096
QUERIES = 1024
#: Candidates that are evaluated between two looks at the stopping bound.
STRIDE = 64
#: Queries for each block of candidates that a task searches at once, and most such blocks.
SHARE = 1 << 14
GROUP = 64
#: Sums of products beyond this are not exact in floating point.
EXACT = 1 << 53

_BLOCK = "block bigint, dim int, rows int, file string, position bigint, size bigint, bytes bigint"
_KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 3]
_HITS = "query_id bigint, query_row bigint, vec_id bigint, score bigint"


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, vector``: each component x as floor(scale * x).

    A null id, and a vector that is null or holds a null or non-finite component, takes no part.
    """
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v))
    doubles = F.col("embedding").cast("array<double>")
    whole = F.transform(x, lambda v: F.floor(v * scale).cast("double"))
    return (
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), doubles.alias("vector"))
        .filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
        .select("vec_id", whole.alias("vector"))
    )


def _far_apart(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots: start at the longest vector, then always the one farthest from those chosen."""
    chosen = [int(np.argmax((sample**2).sum(1)))]
    nearest = ((sample - sample[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(count, len(sample)) and nearest.max() > 0:
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """To each pivot, and last to the origin."""
    columns = [np.sqrt(((vectors - p) ** 2).sum(1)) for p in pivots]
    return np.stack([*columns, np.sqrt((vectors**2).sum(1))], axis=1)


def _blocks(vectors: DataFrame, pivots: dict[int, np.ndarray], rows: int, name: str) -> DataFrame:
    """The pivot table: rows of a task in blocks, with squared norms and distances to pivots.

    Blocks lie in files of the shared folder, and the rows returned say where. A task writes
    a file under a new name, and only files that the returned table names count.
    """
    folder = f"{scratch_path(vectors.sparkSession, name)}/data"

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, position, out = TaskContext.get().partitionId(), 0, 0, None
        file = f"{folder}/{part:06d}-{uuid.uuid4().hex}.blocks"
        waiting: dict[int, list[tuple[int, list[float]]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            nonlocal made, position, out
            ids, values = zip(*waiting.pop(dim))
            values = np.array(values, np.float64).reshape(len(ids), dim)
            norms = (values**2).sum(1)
            if norms.max(initial=0) >= EXACT:
                raise ValueError("inner products of these vectors exceed 53 bits")
            away = _distances(values, pivots.get(dim, values[:0]))
            data = b"".join(p.tobytes() for p in (np.array(ids, np.int64), values, norms, away))
            packed = pa.compress(data, "zstd", asbytes=True)
            out = out or File.create(file)
            out.write(packed)
            made += 1
            at, position = position, position + len(packed)
            columns = [(part << 32) + made, dim, len(ids), file, at, len(packed), len(data)]
            return pa.RecordBatch.from_arrays(
                [pa.array([c], k) for c, k in zip(columns, _KINDS)],
                [c.split()[0] for c in _BLOCK.split(", ")],
            )

        for batch in batches:
            for row in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist()):
                waiting.setdefault(len(row[1]), []).append(row)
                if len(waiting[len(row[1])]) == rows:
                    yield block(len(row[1]))
        for dim in list(waiting):
            yield block(dim)
        if out:
            out.close()

    return materialize(vectors.mapInArrow(table, _BLOCK), name)


def _arrays(row: dict) -> tuple[np.ndarray, ...]:
    """Of a block: ids, vectors, distances and squared norms, read from its file."""
    with File.open_at(row["file"]) as stream:
        packed = stream.read_at(row["size"], row["position"])
    values = pa.decompress(packed, row["bytes"], "zstd", asbytes=True)
    n, dim = row["rows"], row["dim"]
    ids, floats = np.frombuffer(values, np.int64, n), np.frombuffer(values, offset=8 * n)
    vectors, norms, distances = np.split(floats, [n * dim, n * dim + n])
    return ids, vectors.reshape(n, dim), distances.reshape(n, -1), norms


def _together(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, list[tuple]]]:
    """Length and arrays of up to ``most`` blocks whose vectors are of one length."""
    waiting: dict[int, list[tuple]] = {}
    for row in (r for batch in batches for r in batch.to_pylist()):
        waiting.setdefault(row["dim"], []).append(_arrays(row))
        if len(waiting[row["dim"]]) == most:
            yield row["dim"], waiting.pop(row["dim"])
    yield from waiting.items()


def _search(query, own_id, away, norm, floor, block, top, known):
    """Ids and scores of the ``top`` best for one query of a block and of those ``known`` so far.

    |q - x| is at least every difference of their distances to a pivot, so the largest of those
    bounds the product from above. Candidates come by falling bound; once the bound is below the
    score that the last of ``top`` has, so far or in the sample (``floor``), none that follows
    can be among the best.
    """
    ids, vectors, table, norms = block
    found_ids, found = known
    if len(found) >= top:
        floor = max(floor, found[top - 1])
    apart = np.abs(table - away).max(axis=1)
    # Distances are rounded; the bound gives way by more than that, and scores are whole.
    bound = np.floor((norm + norms - apart**2) / 2 + 1e-9 * (norm + norms) + 1e-6)
    able = np.flatnonzero((bound >= floor) & (ids != own_id))
    able = able[np.argsort(-bound[able], kind="stable")]
    for at in range(0, len(able), STRIDE):
        some = able[at : at + STRIDE]
        if len(found) >= top and bound[some[0]] < found[top - 1]:
            break
        found_ids = np.concatenate([found_ids, ids[some]])
        found = np.concatenate([found, vectors[some] @ query])
        best = np.lexsort((found_ids, -found))[:top]
        found_ids, found = found_ids[best], found[best]
    return found_ids, found


def top_products(
    vectors: DataFrame, query: Column, top: int = 5, pivots: int = PIVOTS, sample: int = SAMPLE
) -> DataFrame:
    """The ``top`` candidates of each row for which ``query`` holds: query_id, rank, vec_id, score.

    ``vectors`` has ``vec_id`` and whole-number ``vector`` (see ``whole_vectors``). Candidates
    are all rows of the same length but those with the query's own id; ties go to the smaller
    id, and fewer candidates give fewer rows. Equal vectors and repeated rows are candidates
    each; an id that is a query twice is searched twice, under its one id, in order of score.

    Every row is in the table of distances. Pivots are chosen from ``sample`` rows by a hash
    of their id, as are the scores that a query's best must reach at least; the driver gets
    these rows alone. Each query block meets each candidate block once, in the task that holds
    the candidates: neither is shuffled or sent to the driver, both are read from files. Per
    group of candidate blocks at most ``top`` hits of a query go on.
    """
    ready_workers(vectors.sparkSession)
    vectors = materialize(vectors, "vectors")
    # Written first: collected at once, the driver would get ``sample`` rows of every task.
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    chosen = materialize(chosen, "sample").collect()
    by_dim: dict[int, list] = {}
    for row in chosen:
        by_dim.setdefault(len(row["vector"]), []).append((row["vec_id"], row["vector"]))
    samples = {
        dim: (
            np.array([i for i, _ in rows], np.int64),
            np.array([v for _, v in rows], np.float64).reshape(len(rows), dim),
        )
        for dim, rows in by_dim.items()
    }
    table = {dim: _far_apart(values, pivots) for dim, (_, values) in samples.items()}

    candidates = _blocks(vectors, table, CANDIDATES, "candidate_blocks")
    queries = _blocks(vectors.filter(query), table, QUERIES, "query_blocks")
    asked_of: dict[int, list[dict]] = {}
    for row in queries.collect():  # a line for each block
        asked_of.setdefault(row["dim"], []).append(row.asDict())
    # Hits are those of a group, so a group grows with the queries; they stay below the blocks.
    total = sum(row["rows"] for rows in asked_of.values() for row in rows)
    most = max(1, min(GROUP, -(-total // SHARE)))
    parts = max(1, -(-candidates.count() // most))

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for dim, blocks in _together(batches, most):
            for row in asked_of.get(dim, ()):
                yield dim, blocks, row["block"], _arrays(row)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, blocks, number_of, asked in met(batches):
            none = asked[0][:0], asked[3][:0]
            known_ids, known = samples.get(dim, (asked[0][:0], asked[1][:0]))
            sampled = asked[1] @ known.T
            sampled[asked[0][:, None] == known_ids] = -np.inf
            floors = np.full(len(sampled), -np.inf)
            if len(known) >= top:
                floors = np.partition(sampled, -top, axis=1)[:, -top]
            hits = []
            for at, (own, vector, away, norm) in enumerate(zip(*asked)):
                best = none
                for block in blocks:
                    best = _search(vector, own, away, norm, floors[at], block, top, best)
                number = (number_of << 10) + at
                hits += [(own, number, i, s) for i, s in zip(best[0].tolist(), best[1].tolist())]
            columns = list(zip(*hits)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(x) for x in c], pa.int64()) for c in columns],
                ["query_id", "query_row", "vec_id", "score"],
            )

    hits = candidates.repartition(parts).mapInArrow(search, _HITS)
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")

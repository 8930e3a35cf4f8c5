"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# What the jobs expect of a session. Partition counts and memory stay with the caller.
SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Beyond 2000 shuffle partitions block sizes are averaged; keep those of skewed blocks.
    "spark.shuffle.accurateBlockSkewedFactor": "5",
    "spark.sql.ansi.enabled": "true",
    # Files are compressed; size estimates, and so broadcast decisions, allow for that.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.session.timeZone": "UTC",
}

# Estimates from here on are Catalyst's defaults for sizes that it does not know.
UNKNOWN_BYTES = 1 << 60

_SIZE_UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A folder that the caller gave to ``setCheckpointDir`` since then goes before it. Only a
    local session with neither gets a folder of its own; on a cluster, a folder below ``/tmp``
    of each machine is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()  # below the named one unless set anew
    if named and current and urlsplit(current).path.startswith(urlsplit(named).path):
        current = None
    folder = current or named
    if folder:
        parts = urlsplit(folder)
        if (
            parts.scheme in ("", "file")
            and parts.path.startswith("/tmp/")
            and not spark.sparkContext.master.startswith("local")
        ):
            raise RuntimeError(f"executors do not share {folder}; set spark.checkpoint.dir")
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="ledgerstar-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_scope: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; two calls never share one."""
    path = f"{shared_folder(spark)}/ledgerstar/{name}-{uuid.uuid4().hex}"
    if (paths := _scope.get()) is not None:
        paths.append(path)
    return path


def file_system(spark: SparkSession, path: str):
    """A path as Hadoop's object, and the file system that it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; none is fine."""
    place, system = file_system(spark, path)
    system.delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables that are made inside, at the end, also after an error.

    Frames that read them must not be used afterwards; write the results inside.
    """
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            delete(spark, path)


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each table that is written inside once it is written.

    Else they stay until the driver happens to collect its garbage. Frames that are made inside
    should be run once; a second run finds no shuffle files and makes them again.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Used where several outputs share one expensive frame. The readers get column pruning
    and a true size, and a lost executor costs a re-read instead of the whole lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_parallel(jobs: dict[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent jobs at the same time, so that small ones fill cores a large one leaves.

    Results keep the order of ``jobs``; all jobs end before an error of one is raised.
    """
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        running = {name: pool.submit(copy_context().run, job) for name, job in jobs.items()}
    return {name: job.result() for name, job in running.items()}


def _bytes_of(spark: SparkSession, setting: str) -> int:
    text = spark.conf.get(setting).strip().lower()
    digits = text.rstrip("b").rstrip("kmgt")
    unit = text[len(digits) :][:1] or "b"
    return int(digits) * _SIZE_UNITS[unit]


def broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; negative when broadcasting is off."""
    return _bytes_of(spark, "spark.sql.autoBroadcastJoinThreshold")


def merged_scan(df: DataFrame, scanned: DataFrame) -> DataFrame:
    """``df``, which reads ``scanned`` file by file, in no more tasks than the bytes of it need.

    Spark counts some megabytes for opening a file, so that a table of very many small files is
    read, and written again, in far more parts than its bytes fill. No row is shuffled. A scan
    that has fewer parts, or whose size is not known, stays as it is.
    """
    spark = df.sparkSession
    scanned_bytes = estimated_bytes(scanned)
    if scanned_bytes >= UNKNOWN_BYTES:
        return df
    parts = -(-scanned_bytes // _bytes_of(spark, "spark.sql.files.maxPartitionBytes"))
    return df.coalesce(max(parts, 2 * spark.sparkContext.defaultParallelism))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for ``df``, the figure its own broadcast decision uses."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))

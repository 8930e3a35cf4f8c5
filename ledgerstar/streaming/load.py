"""Load each new file of a folder exactly once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def load_new_files(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    files_per_batch: int = 10_000,
) -> None:
    """Append the Parquet files that arrived at ``source`` since the last call to ``target``.

    The checkpoint folder remembers what was loaded, so calling again, also after a failure,
    neither skips nor repeats a file, however old its modification time is: the source's own
    age limit, which would drop late files, is set to a century. So the names of all files stay
    in the checkpoint; move files that are done to another folder before they are millions.
    All waiting files are loaded; ``files_per_batch`` bounds what a failure has to repeat.
    """
    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", "36500d")
        .parquet(source)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def load_new_rows(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    keys: list[str],
    time: str,
    delay: str,
    files_per_batch: int = 10_000,
) -> None:
    """As ``load_new_files``, and a row that an earlier file brought already is not added again.

    Rows are the same if they agree in all of ``keys``. The state store keeps the keys of rows
    until the newest ``time`` seen has passed theirs by ``delay``, across calls; so a repeat is
    found if it comes within that delay, and state is bounded by it. A row whose ``time`` is
    further back than the delay when it arrives is dropped as too late: choose the delay so that
    overlapping drops lie within it. State is spread over the shuffle partitions by key.
    """
    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", "36500d")
        .parquet(source)
        .withColumn("_event_time", F.col(time).cast("timestamp"))  # a watermark needs a zone
        .withWatermark("_event_time", delay)
        .dropDuplicatesWithinWatermark(keys)
        .drop("_event_time")
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

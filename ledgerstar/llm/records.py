"""Token ids in length-delimited binary files with a separate offset index.

A file is a run of frames: length (unsigned 64 bits), masked CRC-32C of those eight bytes, the
record, masked CRC-32C of the record; all little-endian. A record is one document: a flag byte
that is 0 for a null id, the id (signed 64 bits), then the token ids as unsigned 16 bits.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerstar.llm.common import (
    File,
    WordTokenizer,
    crc32_of_ids,
    id_and_text,
    ready_workers,
    text_batches,
)
from ledgerstar.llm.crc32c import crc32c, masked, short_crc32c

_HEAD = struct.Struct("<QI")
_SUM = struct.Struct("<I")
_ID = struct.Struct("<?q")

_INDEX = "doc_id bigint, part int, file string, position bigint, length bigint, n_tokens bigint"
_READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def frames(records: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(r)) for r in records]
    heads, sums = masked(crc32c(lengths)), masked(crc32c(records))
    return [
        length + _SUM.pack(head) + record + _SUM.pack(total)
        for length, head, record, total in zip(lengths, heads, records, sums)
    ]


def unframe(stream: pa.NativeFile, batch_bytes: int = 4 << 20) -> Iterator[bytes]:
    """The records of a file in order; any damage is an error."""
    waiting: list[tuple[bytes, int]] = []
    size = 0

    def checked() -> Iterator[bytes]:
        for (record, total), found in zip(waiting, masked(crc32c([r for r, _ in waiting]))):
            if found != total:
                raise ValueError("a record does not match its checksum")
            yield record

    while head := stream.read(_HEAD.size):
        if len(head) < _HEAD.size:
            raise ValueError("the file ends inside a length")
        length, length_sum = _HEAD.unpack(head)
        if masked([short_crc32c(head[:8])])[0] != length_sum:
            raise ValueError("a length does not match its checksum")
        body = stream.read(length + _SUM.size)
        if len(body) < length + _SUM.size:
            raise ValueError("the file ends inside a record")
        waiting.append((body[:length], _SUM.unpack(body[length:])[0]))
        size += length
        if size >= batch_bytes:
            yield from checked()
            waiting, size = [], 0
    yield from checked()


def serialize(doc_id: int | None, ids: bytes) -> bytes:
    return _ID.pack(doc_id is not None, doc_id or 0) + ids


def deserialize(record: bytes) -> tuple[int | None, bytes]:
    known, doc_id = _ID.unpack_from(record)
    return (doc_id if known else None), record[_ID.size :]


def write_records(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, parts: int | None = None
) -> DataFrame:
    """Write the documents' ids below ``path`` in ascending ``doc_id`` order; returns the index.

    Null texts are empty, every document ends with ``end_id``; a null id comes first, rows that
    share an id are ordered by a hash of their text. Tasks own ranges of ids, a file each. A task
    that runs again writes a new file: the index (a Parquet table, committed by Spark) names
    the files that count. An empty table gives an empty index.
    """
    spark = docs.sparkSession
    ready_workers(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{path}/data"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordTokenizer.of(tokenizer).encode
        end = struct.pack("<H", end_id)
        part = TaskContext.get().partitionId()
        file, out, position = f"{folder}/{part:06d}-{uuid.uuid4().hex}.rec", None, 0
        for batch in text_batches(batches):
            out = out or File.create(file)
            doc_ids = batch.column("doc_id").to_pylist()
            ids = [i + end for i in encode(batch.column("text"))]
            framed = frames([serialize(d, i) for d, i in zip(doc_ids, ids)])
            out.write(b"".join(framed))
            lengths = [len(f) for f in framed]
            ends = np.cumsum(lengths) + position
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "part": pa.array([part] * len(ids), pa.int32()),
                    "file": pa.array([file] * len(ids)),
                    "position": ends - lengths,
                    "length": pa.array(lengths, pa.int64()),
                    "n_tokens": pa.array([len(i) // 2 for i in ids], pa.int64()),
                }
            )
            position = int(ends[-1])
        if out:
            out.close()

    ordered = (
        id_and_text(docs)
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(parts, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )
    ordered.select("doc_id", "text").mapInArrow(write, _INDEX).write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def read_records(index: DataFrame) -> DataFrame:
    """Read whole files in order and check every frame: id, first token's place, count, crc32.

    Only the number of tokens per file passes through the one ordered window, a row per file.
    """
    spark = index.sparkSession
    files = index.groupBy("part", "file").agg(
        F.count(F.lit(1)).alias("records"), F.sum("n_tokens").alias("tokens")
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            start, rows = row["base"], []
            with File.open(row["file"]) as stream:
                for doc_id, ids in map(deserialize, unframe(stream)):
                    rows.append((doc_id, start, len(ids) // 2, crc32_of_ids(ids)))
                    start += len(ids) // 2
            if (len(rows), start - row["base"]) != (row["records"], row["tokens"]):
                raise ValueError(f"{row['file']} does not hold what the index says")
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.select("file", "records", "tokens", "base").repartition(tasks).mapInArrow(
        read, _READ
    )


def read_shuffled(index: DataFrame, seed: int) -> DataFrame:
    """Ids of each document in an order that ``seed`` sets, read at the index's offsets.

    Documents are dealt over tasks and ordered by a seeded hash, as training reads them.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            records: list[bytes] = [b""] * len(rows)
            for file in {r["file"] for r in rows}:
                with File.open_at(file) as stream:
                    for at, row in enumerate(rows):
                        if row["file"] == file:
                            stream.seek(row["position"])
                            frame = stream.read(row["length"])
                            records[at] = next(unframe(pa.BufferReader(frame)))
            found = [deserialize(r) for r in records]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([d for d, _ in found], pa.int64()),
                    "ids": pa.array(
                        [np.frombuffer(i, "<u2").astype("i4") for _, i in found],
                        pa.list_(pa.int32()),
                    ),
                }
            )

    dealt = index.withColumn("place", F.xxhash64(F.lit(seed), "file", "position"))
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt.repartition(tasks, "place")
        .sortWithinPartitions("place")
        .select("file", "position", "length")
        .mapInArrow(read, "doc_id bigint, ids array<int>")
    )

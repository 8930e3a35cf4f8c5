"""Best-fit packing of documents into token sequences, by rounds over a tree of tasks."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import (
    WordTokenizer,
    crc32_of_ids,
    id_and_text,
    ready_workers,
    text_batches,
)
from ledgerstar.session import materialize

#: Items that one task packs at a time.
MOST_ITEMS = 200_000
#: Tasks of a round whose underfull bins meet in one task of the next.
FAN_IN = 8
#: A bin with at most this share of its space left is emitted at once.
NEARLY_FULL = 0.004

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_BINS = "fill int, items array<bigint>, offsets array<int>, done boolean"


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Ids of each document, null text as empty, with an end id; long ones in pieces.

    All pieces but the first hold ``capacity`` tokens, so only one piece has to be packed.
    """
    ready_workers(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordTokenizer.of(tokenizer).encode
        end = struct.pack("<H", end_id)
        for batch in text_batches(batches):
            rows = []
            encoded = encode(batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                ids += end
                length = len(ids) // 2
                starts = [0, *range(length % capacity or capacity, length, capacity)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], length])):
                    rows.append((doc_id, piece, a, b - a, crc32_of_ids(ids[2 * a : 2 * b])))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return id_and_text(docs).mapInArrow(cut, _PIECES)


def best_fit(
    items: list[tuple[int, list[int], list[int]]], capacity: int
) -> list[tuple[int, list[int], list[int]]]:
    """Best fit in descending order: each item goes to the fullest bin that still holds it.

    An item is (fill, members, offsets). Open bins are kept by the space they have left, and
    the bits of ``spaces`` say which amounts occur, so the tightest fit is the lowest set bit.
    """
    by_space: list[list[tuple[list[int], list[int]]]] = [[] for _ in range(capacity + 1)]
    spaces = 0
    for fill, members, offsets in sorted(items, key=lambda x: (-x[0], x[1])):
        if fitting := spaces >> fill:
            space = fill + (fitting & -fitting).bit_length() - 1
            into = by_space[space].pop()
            if not by_space[space]:
                spaces ^= 1 << space
            used = capacity - space
            into[0].extend(members)
            into[1].extend(o + used for o in offsets)
        else:
            space, into = capacity, (list(members), list(offsets))
        left = space - fill
        by_space[left].append(into)
        spaces |= 1 << left
    return [(capacity - left, *b) for left, bins in enumerate(by_space) for b in bins]


def _round(items: DataFrame, capacity: int, last: bool) -> DataFrame:
    enough = capacity - int(capacity * NEARLY_FULL)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, list[int], list[int]]] = []

        def packed() -> pa.RecordBatch:
            found = best_fit(waiting, capacity)
            return pa.RecordBatch.from_pydict(
                {
                    "fill": pa.array([f for f, _, _ in found], pa.int32()),
                    "items": pa.array([i for _, i, _ in found], pa.list_(pa.int64())),
                    "offsets": pa.array([o for _, _, o in found], pa.list_(pa.int32())),
                    "done": pa.array([last or f >= enough for f, _, _ in found]),
                }
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("fill", "items", "offsets")]
            waiting += zip(*columns)
            if len(waiting) >= MOST_ITEMS:
                yield packed()
                waiting = []
        if waiting:
            yield packed()

    return materialize(items.mapInArrow(pack, _BINS), "bins")


def pack(lengths: DataFrame, capacity: int = 2048) -> DataFrame:
    """Place items (``item`` unique, ``length`` from 1 to ``capacity``) into few sequences.

    Round 0 packs what each task holds; bins that are nearly full are done. The others, as
    items of their own, meet those of ``FAN_IN`` tasks in the next round, until one task
    holds the rest or, where the rest is larger than a task should hold, a round no longer
    saves a bin in a thousand. Rounds never split an item. Returns ``item, sequence_id, offset``.
    """
    small = lengths.filter(F.col("length") < capacity).select(
        F.col("length").cast("int").alias("fill"),
        F.array("item").alias("items"),
        F.array(F.lit(0)).alias("offsets"),
    )
    whole = lengths.filter(F.col("length") == capacity).select(
        F.array("item").alias("items"), F.array(F.lit(0)).alias("offsets")
    )
    done = []
    tasks = small.rdd.getNumPartitions()
    bins = _round(small, capacity, last=False)
    while True:
        done.append(bins.filter("done").select("items", "offsets"))
        rest = bins.filter("NOT done").select("fill", "items", "offsets")
        count = rest.count()
        if not count:
            break
        fewest = -(-count // MOST_ITEMS)
        before, tasks = tasks, max(fewest, -(-tasks // FAN_IN))
        last = tasks == 1
        bins = _round(rest.repartition(tasks), capacity, last)
        if last:
            done.append(bins.select("items", "offsets"))
            break
        if tasks == before and bins.count() > 0.999 * count:
            done.append(bins.select("items", "offsets"))
            break
    packed = whole
    for part in done:
        packed = packed.unionByName(part)
    packed = packed.withColumn("sequence_id", F.monotonically_increasing_id())
    packed = materialize(packed, "packed")
    return packed.select("sequence_id", F.inline(F.arrays_zip("items", "offsets"))).select(
        F.col("items").alias("item"), "sequence_id", F.col("offsets").cast("bigint").alias("offset")
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048
) -> DataFrame:
    """One row per piece with its sequence and place there; an empty table gives no rows.

    Empty and null texts are a single end id. Rows that repeat an id are packed each.
    """
    cut = pieces(docs, tokenizer, end_id, capacity)
    cut = materialize(cut.withColumn("item", F.monotonically_increasing_id()), "pieces")
    return cut.join(pack(cut.select("item", "length"), capacity), "item").drop("item")


def sequences(docs: DataFrame, packing: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """The packed token ids, ``sequence_id, ids``, from documents and their packing.

    ``doc_id`` must be unique here. A sequence is at most ``capacity`` tokens, so is each group.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokenizer.of(tokenizer).encode
        end = struct.pack("<H", end_id)
        for batch in batches:
            encoded = [i + end for i in tokens(batch.column("text"))]
            ids = [struct.unpack(f"<{len(i) // 2}H", i) for i in encoded]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    whole = id_and_text(docs).mapInArrow(encode, "doc_id bigint, ids array<int>")
    placed = packing.join(whole, "doc_id").select(
        "sequence_id",
        "offset",
        F.slice("ids", F.col("start").cast("int") + 1, F.col("length").cast("int")).alias("ids"),
    )
    return placed.groupBy("sequence_id").agg(
        F.flatten(
            F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])
        ).alias("ids")
    )

"""Ranked search by bit-sliced Bloom signatures that bound every score; the rest is rescored."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerstar.llm.common import id_and_text, ready_workers, single_rows
from ledgerstar.session import materialize

#: Documents of a block, and different terms summed over its documents, at most (or one document).
BLOCK_DOCS = 1024
BLOCK_TERMS = 1 << 17
#: Terms of all blocks that a task fills at a time; beyond it the largest block is closed.
OPEN_TERMS = 4 * BLOCK_TERMS
#: Slices that a term sets, and slices per entry of the document that has most.
HASHES = 3
SLICES_PER_ENTRY = 10
#: Entry i of a term says that it occurs at least 2^i times.
LEVELS = 16
#: Candidates that are rescored between two looks at the bound that stops the search.
STRIDE = 64
#: Terms of the items that are searched for together.
QUERY_TERMS = 20_000
#: One in so many blocks is searched first, for scores that the other blocks have to beat.
FIRST = 16

_INDEX = (
    "block bigint, docs int, length bigint, ids array<bigint>, lengths array<bigint>, "
    "n_slices int, slices binary, terms array<binary>, holders array<int>, starts binary, "
    "numbers binary, counts binary"
)
_HITS = "item_row bigint, doc_id bigint, score bigint"
#: Sorts before every id, as a null does.
_NO_ID = -(1 << 63)

# Lower case A-Z; every byte that is no digit, letter or part of a character beyond ASCII parts.
_TERM_BYTES = bytes(
    ord(chr(b).lower()) if b < 0x80 and chr(b).isalnum() else b if b >= 0x80 else 0x20
    for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Runs of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]`` in UTF-8, A-Z lower-cased."""
    return text.translate(_TERM_BYTES).split()


def _places(hashes: np.ndarray, level: int, slices: int) -> np.ndarray:
    """The slices of terms at a level, a row of ``HASHES`` each."""
    first = (hashes & 0xFFFFFFFF) + np.uint64(level * 0x9E3779B1)
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return (first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(slices)


def _hashes(some: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t) for t in some], np.uint64)


class _Block:
    """Documents of similar size, gathered until the block is full."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.number: dict[bytes, int] = {}
        self.numbers: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0
        self.closed = False

    def add(self, doc_id: int | None, found: Counter[bytes]) -> None:
        number = self.number
        self.ids.append(doc_id)
        self.numbers.append(
            np.array([number.setdefault(t, len(number)) for t in found], np.uint32)
        )
        self.counts.append(np.array(list(found.values()), np.uint32))
        self.lengths.append(int(self.counts[-1].sum()))
        self.size += len(found)

    @property
    def full(self) -> bool:
        return self.closed or len(self.ids) >= BLOCK_DOCS or self.size >= BLOCK_TERMS

    def row(self, block: int) -> pa.RecordBatch:
        known = sorted(self.number)
        place = np.zeros(len(known), np.int64)
        place[[self.number[t] for t in known]] = np.arange(len(known))
        sizes = [len(n) for n in self.numbers]
        doc = np.repeat(np.arange(len(sizes)), sizes)
        numbers, counts = place[np.concatenate(self.numbers)], np.concatenate(self.counts)
        order = np.lexsort((numbers, doc))
        numbers, counts = numbers[order], counts[order]

        top = np.minimum(np.frexp(counts)[1], LEVELS)  # entries of each term of a document
        entries = np.bincount(doc, weights=top)
        slices = max(64, ceil(SLICES_PER_ENTRY * entries.max()))
        bits = np.zeros((slices, len(sizes)), bool)
        hashes = _hashes(known)
        for level in range(int(top.max())):
            there = top > level
            at = _places(hashes, level, slices)[numbers[there]]
            bits[at, doc[there][:, None]] = True
        columns = {
            "block": pa.array([block], pa.int64()),
            "docs": pa.array([len(sizes)], pa.int32()),
            "length": pa.array([sum(self.lengths)], pa.int64()),
            "ids": pa.array([self.ids], pa.list_(pa.int64())),
            "lengths": pa.array([self.lengths], pa.list_(pa.int64())),
            "n_slices": pa.array([slices], pa.int32()),
            "slices": pa.array([np.packbits(bits, axis=1).tobytes()], pa.binary()),
            "terms": pa.array([known], pa.list_(pa.binary())),
            "holders": pa.array([np.bincount(numbers).astype(np.int32)], pa.list_(pa.int32())),
            "starts": pa.array([np.cumsum([0, *sizes]).astype("<i8").tobytes()], pa.binary()),
            "numbers": pa.array([numbers.astype("<u4").tobytes()], pa.binary()),
            "counts": pa.array([counts.astype("<u4").tobytes()], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(columns)


def build_index(docs: DataFrame) -> DataFrame:
    """Signatures and exact counts of all documents that hold a term, in blocks.

    ``slices`` is a bitmap of the block's documents per bit of their Bloom signatures: a term
    sets ``HASHES`` slices for each power of two that its count reaches. Documents of a block
    have about as many different terms, so one length of signature suits them. ``numbers`` and
    ``counts`` hold each document's terms, by their places in ``terms``.
    """
    ready_workers(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, waiting = TaskContext.get().partitionId() << 32, {}
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                found = Counter(terms(text.as_py()))
                if not found:
                    continue
                kind = len(found).bit_length()
                into = waiting.setdefault(kind, _Block())
                into.add(doc_id, found)
                if not into.full and sum(b.size for b in waiting.values()) > OPEN_TERMS:
                    kind = max(waiting, key=lambda k: waiting[k].size)
                    into = waiting[kind]
                    into.closed = True
                if into.full:
                    yield waiting.pop(kind).row(block)
                    block += 1
        for into in waiting.values():
            yield into.row(block)
            block += 1

    return materialize(id_and_text(docs).mapInArrow(write, _INDEX), "signatures")


@dataclass
class Queries:
    """Items that are searched for together: their rows, terms by number, and weights."""

    rows: list[int]
    known: list[bytes]
    places: list[np.ndarray]
    weights: list[np.ndarray]
    floors: list[int]


def weight(total: int, holders: int) -> int:
    return floor(1000 * log((2 * total + 2) / (2 * holders + 1)))


def _gains(levels: int, slowness: np.ndarray) -> np.ndarray:
    """What a level adds at most to the factor of a term, per document."""
    most = np.array([2.0 ** (i + 1) - 1 for i in range(levels - 1)])[:, None]
    reached = np.concatenate([1e9 * most / (1000 * most + 20 * slowness), [slowness * 0 + 1e6]])
    return np.diff(reached, axis=0, prepend=0)


class Block:
    """A block of the index, opened for one group of items."""

    def __init__(self, row: dict, queries: Queries, total: int, length: int):
        self.ids = np.array([_NO_ID if i is None else i for i in row["ids"]], np.int64)
        lengths = np.array(row["lengths"], np.int64)
        self.slowness = 100 - 50 + (50 * lengths * total) // length
        self.counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        starts = np.frombuffer(row["starts"], "<i8")
        doc = np.repeat(np.arange(len(lengths)), np.diff(starts))
        self.size = len(row["terms"])
        self.keys = doc * self.size + np.frombuffer(row["numbers"], "<u4").astype(np.int64)
        place = {t: i for i, t in enumerate(row["terms"])}
        self.local = np.array([place.get(t, -1) for t in queries.known])
        self.bounds = self._bounds(row, _hashes(queries.known))

    def _bounds(self, row: dict, hashes: np.ndarray) -> np.ndarray:
        """Per term of the items and document, a factor that the true one does not exceed.

        The slices of a term, and-ed, overestimate who holds it; each level that seems reached
        adds what it may be worth.
        """
        docs, slices = row["docs"], row["n_slices"]
        bits = np.frombuffer(row["slices"], np.uint8).reshape(slices, -1)
        gains = _gains(LEVELS, self.slowness.astype(np.float64)).astype(np.float32)
        found = np.zeros((len(hashes), docs), np.float32)
        some, before = np.arange(len(hashes)), None
        for level in range(LEVELS):
            held = np.bitwise_and.reduce(bits[_places(hashes[some], level, slices)], axis=1)
            if before is not None:
                held &= before
            kept = held.any(axis=1)
            if not kept.any():
                break
            some, before = some[kept], held[kept]
            found[some] += np.unpackbits(before, axis=1, count=docs) * gains[level]
        return found

    def exact(self, some: np.ndarray, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of some documents for the terms at ``places``."""
        local = self.local[places]
        there = local >= 0
        wanted = some[:, None] * self.size + local[there]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        count = np.where(self.keys[at] == wanted, self.counts[at], 0)
        factor = (1_000_000_000 * count) // (1000 * count + 20 * self.slowness[some][:, None])
        return (weights[there] * factor).sum(axis=1)

    def search(
        self, places: np.ndarray, weights: np.ndarray, least: int, top: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``top`` best of at least ``least``, ties by id.

        Documents come by falling bound. Once it is below the score of the last of ``top``, no
        document that follows can be among them.
        """
        bound = weights.astype(np.float32) @ self.bounds[places]
        bound = bound * np.float32(1.0001) + 1  # more than rounding can take away
        able = np.flatnonzero(bound >= max(least, 1))
        able = able[np.argsort(-bound[able], kind="stable")]
        ids, scores = self.ids[:0], self.ids[:0]
        for at in range(0, len(able), STRIDE):
            some = able[at : at + STRIDE]
            if len(scores) >= top and bound[some[0]] < scores[top - 1]:
                break
            ids = np.concatenate([ids, self.ids[some]])
            scores = np.concatenate([scores, self.exact(some, places, weights)])
            best = np.lexsort((ids, -scores))[:top]
            ids, scores = ids[best], scores[best]
        good = scores >= max(least, 1)
        return ids[good], scores[good]


def _search(index: DataFrame, queries: Queries, total: int, length: int, top: int) -> DataFrame:
    """Each block's ``top`` best of each item, at least as good as the item's floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in single_rows(batches):
            block, rows, ids, scores = Block(row, queries, total, length), [], [], []
            asked = zip(queries.rows, queries.places, queries.weights, queries.floors)
            for item, places, weights, least in asked:
                found_ids, found = block.search(places, weights, least, top)
                rows.append(np.full(len(found), item))
                ids.append(found_ids)
                scores.append(found)
            ids = np.concatenate(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(rows), pa.int64()),
                    pa.array(ids, pa.int64(), mask=ids == _NO_ID),
                    pa.array(np.concatenate(scores), pa.int64()),
                ],
                ["item_row", "doc_id", "score"],
            )

    return materialize(index.mapInArrow(run, _HITS), "hits")


def _best(hits: DataFrame, top: int) -> DataFrame:
    """Ranked hits; the limit works within each task before rows move."""
    order = Window.partitionBy("item_row").orderBy(F.desc("score"), "doc_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _items(items: DataFrame) -> DataFrame:
    """A row per item and different term: ``item_row`` tells rows that share an id apart."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for item_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                found = sorted(set(terms(text.as_py())))
                row += 1
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_row": pa.array([row] * len(found), pa.int64()),
                        "item_id": pa.array([item_id] * len(found), pa.int64()),
                        "term": pa.array(found, pa.binary()),
                    }
                )

    narrow = id_and_text(items, "item_id")
    split_items = narrow.mapInArrow(split, "item_row bigint, item_id bigint, term binary")
    return materialize(split_items, "items")


def search(docs: DataFrame, items: DataFrame, top: int = 50) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` best documents with a score above 0.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``. Equal scores go by ascending
    id, a null id first. Null and empty texts hold no term; such documents are never found, and
    such items find nothing. Repeated documents are found each, repeated items search each.

    The score sums over an item's different terms w * ((10^9 tf) div (1000 tf + 20 m)), with
    w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 50 + (50 n N) div L. Items are searched in
    groups of about ``QUERY_TERMS`` terms, which bounds what goes to every task. One in ``FIRST``
    blocks is searched first; an item's score at rank ``top`` there is the floor for the others.
    """
    spark = docs.sparkSession
    ready_workers(spark)
    index = build_index(docs)
    figures = index.agg(F.sum("docs").alias("docs"), F.sum("length").alias("length")).first()
    total, length = figures["docs"] or 0, figures["length"] or 0
    asked = _items(items)
    found = spark.createDataFrame([], f"item_id bigint, {_HITS}")
    if not total:
        return _best(found, top).select("item_id", "rank", "doc_id", "score")
    held = index.select(F.inline(F.arrays_zip("terms", "holders"))).withColumnRenamed("terms", "term")
    held = held.join(asked.select("term").distinct(), "term", "left_semi")
    held = held.groupBy("term").agg(F.sum("holders").alias("holders"))
    groups = max(1, ceil(asked.count() / QUERY_TERMS))
    group = F.pmod(F.xxhash64("item_row"), F.lit(groups))
    weighed = materialize(asked.join(held, "term").withColumn("group", group), "weighed")
    first = F.pmod(F.xxhash64("block"), F.lit(FIRST)) == 0
    hits = []
    for number in range(groups):
        queries = _queries(weighed.filter(F.col("group") == number), total)
        if not queries.rows:
            continue
        hits.append(_search(index.filter(first), queries, total, length, top))
        reached = {
            r["item_row"]: r["score"]
            for r in _best(hits[-1], top).filter(F.col("rank") == top).collect()
        }
        queries.floors = [reached.get(row, 1) for row in queries.rows]
        hits.append(_search(index.filter(~first), queries, total, length, top))
    if hits:
        rows = hits[0]
        for other in hits[1:]:
            rows = rows.unionByName(other)
        names = weighed.select("item_row", "item_id").distinct()
        found = _best(rows, top).join(names, "item_row")
        return found.select("item_id", "rank", "doc_id", "score")
    return _best(found, top).select("item_id", "rank", "doc_id", "score")


def _queries(weighed: DataFrame, total: int) -> Queries:
    """A group of items, brought to the driver: about ``QUERY_TERMS`` rows."""
    by_row: dict[int, list] = {}
    number: dict[bytes, int] = {}
    for r in weighed.select("item_row", "term", "holders").collect():
        at = number.setdefault(bytes(r["term"]), len(number))
        by_row.setdefault(r["item_row"], []).append((at, weight(total, r["holders"])))
    places = [np.array([at for at, _ in some]) for some in by_row.values()]
    weights = [np.array([w for _, w in some], np.int64) for some in by_row.values()]
    return Queries(list(by_row), list(number), places, weights, [1] * len(by_row))

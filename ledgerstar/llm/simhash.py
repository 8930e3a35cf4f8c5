"""Near duplicates by SimHash fingerprints in a hierarchical index over Gray order."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.attach import attach
from ledgerstar.llm.common import id_and_text, ready_workers
from ledgerstar.llm.components import components
from ledgerstar.session import materialize

#: Fingerprints of a leaf that one task compares with another.
LEAF = 4096
#: Leading bits by which a node that is too large is cut further.
STEP = 6
#: Codes, and then nodes, that share a node one level up within a leaf.
FAN_OUT = 4
#: Node pairs that are looked at together.
MOST_PAIRS = 1 << 16


def fingerprint(text: str, shingle: int = 3) -> int:
    """Bit i is set if over half the shingles' hashes have it; without words it is zero."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    digest = xxhash.xxh64_digest
    hashes = b"".join(
        [digest(joined[a : b - 1], 42) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    )
    ones, step = np.zeros(64, np.int64), 8 << 15
    for at in range(0, len(hashes), step):
        part = np.frombuffer(hashes[at : at + step], np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes) // 8).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, code``: the fingerprint as a signed long. Whole texts, row by row."""
    ready_workers(docs.sparkSession)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            signed = np.array(codes, np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), signed], ["doc_id", "code"])

    return id_and_text(docs).mapInArrow(code, "doc_id bigint, code bigint")


def with_fingerprint(docs: DataFrame, name: str, shingle: int = 3) -> DataFrame:
    """The rows of ``docs``, with all their columns, and the fingerprint of each in 16 hex digits.

    Equal to ``fingerprint`` of ``near_duplicates``.
    """
    ready_workers(docs.sparkSession)

    @F.arrow_udf("string")
    def code(texts: pa.Array) -> pa.Array:
        return pa.array([f"{fingerprint(t.as_py(), shingle):016x}" for t in texts], pa.string())

    return docs.withColumn(name, code(F.coalesce(F.col("text"), F.lit(""))))


def gray_rank(code: Column) -> Column:
    """Place of a code in Gray order: each bit is the parity of the bits from the top to it.

    Codes that share their first n bits are a run of that order, for every n.
    """
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("code", 64 - depth) if depth else F.lit(0).cast("bigint")


def _node(depth: int) -> Column:
    """Name of the node that holds all codes with the same first bits."""
    return F.concat(F.lit(f"{depth:02d}:"), F.hex(_prefix(depth)))


def _nodes(codes: DataFrame) -> DataFrame:
    """Each node's size, the bits that all its codes share, and their values."""
    summed = codes.groupBy("node").agg(
        F.count(F.lit(1)).alias("codes"),
        F.bit_and("code").alias("ones"),
        F.bit_or("code").alias("any"),
    )
    mask = F.bitwise_not(F.col("ones").bitwiseXOR(F.col("any")))
    return summed.select("node", "codes", mask.alias("mask"), F.col("ones").alias("bits"))


def _near(bits: int) -> Column:
    """Nodes whose shared bits alone differ too often hold no pair; the whole group is pruned."""
    shared = F.col("mask").bitwiseAND(F.col("mask2"))
    differ = F.col("bits").bitwiseXOR(F.col("bits2")).bitwiseAND(shared)
    return F.bit_count(differ) <= bits


def _first_pairs(nodes: DataFrame, depth: int, bits: int) -> DataFrame:
    """Pairs of nodes of one depth: flip every choice of up to ``bits`` of the leading bits."""
    flips, level = [0], [0]
    for _ in range(min(bits, depth)):
        level = [f | (1 << i) for f in level for i in range(depth) if 1 << i > f]
        flips += level
    prefix = F.conv(F.substring("node", 4, 16), 16, 10).cast("bigint")
    keyed = nodes.withColumn("prefix", prefix)
    probes = keyed.withColumn("flip", F.explode(F.lit(flips).cast("array<bigint>"))).withColumn(
        "prefix2", F.col("prefix").bitwiseXOR(F.col("flip"))
    )
    others = keyed.select(*[F.col(c).alias(f"{c}2") for c in keyed.columns])
    found = probes.filter("prefix2 >= prefix").join(others, "prefix2").filter(_near(bits))
    return found.select(*_PAIR)


_SIDE = ["node", "codes", "mask", "bits"]
_PAIR = [*_SIDE, *[f"{c}2" for c in _SIDE]]


def _descend(pairs: DataFrame, family: DataFrame, bits: int) -> DataFrame:
    """Replace each node by its parts (``parent`` to node; small nodes are their own part)."""
    first = pairs.select(F.col("node").alias("parent"), F.col("node2").alias("parent2"))
    both = first.join(family, "parent").join(
        family.select(F.col("parent").alias("parent2"), *[F.col(c).alias(f"{c}2") for c in _SIDE]),
        "parent2",
    )
    # A node's pair with itself gives each pair of its parts twice.
    once = (F.col("parent") != F.col("parent2")) | (F.col("node") <= F.col("node2"))
    return both.filter(once & _near(bits)).select(*_PAIR)


def _levels(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """From single codes up to the root: (mask, bits) of runs of ``FAN_OUT`` to the power i."""
    ones, any_ = codes, codes
    found = []
    while True:
        found.append((~(ones ^ any_), ones))
        if len(ones) == 1:
            return found
        starts = np.arange(0, len(ones), FAN_OUT)
        ones = np.bitwise_and.reduceat(ones, starts)
        any_ = np.bitwise_or.reduceat(any_, starts)


def close_pairs(
    left: np.ndarray, right: np.ndarray, bits: int, same: bool = False
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of codes that differ in at most ``bits`` bits, both arrays in Gray order.

    Walks both trees from the roots at once. A pair of nodes goes on only while the differences
    in the bits that each shares stay within bounds; at single codes these are all bits. With
    ``same`` the arrays are one, and each pair is found once.
    """
    a, b = _levels(left), _levels(right)
    start = np.zeros(1, np.int64)
    waiting = [(len(a) - 1, len(b) - 1, start, start)]
    while waiting:
        i, j, x, y = waiting.pop()
        (mask, ones), (mask2, ones2) = a[i], b[j]
        near = np.bitwise_count((ones[x] ^ ones2[y]) & mask[x] & mask2[y]) <= bits
        x, y = x[near], y[near]
        if not len(x):
            continue
        if i == j == 0:
            yield x, y
            continue
        if i >= j:
            i, x, y = i - 1, *_children(x, y, len(a[i - 1][0]))
        if j > i:
            j, (y, x) = j - 1, _children(y, x, len(b[j - 1][0]))
        if same:
            ordered = x < y if i == j == 0 else x <= y
            if i == j:
                x, y = x[ordered], y[ordered]
        for at in range(0, len(x), MOST_PAIRS):
            waiting.append((i, j, x[at : at + MOST_PAIRS], y[at : at + MOST_PAIRS]))


def _children(x: np.ndarray, y: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    below = (x[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
    there = below < size
    return below[there], np.repeat(y, FAN_OUT)[there]


def _spanning(
    left: np.ndarray, right: np.ndarray, bits: int, same: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same codes as all close pairs do, fewer than there are codes."""
    codes = left if same else np.concatenate([left, right])
    label = np.arange(len(codes))
    shift = 0 if same else len(left)
    for x, y in close_pairs(left, right, bits, same):
        y = y + shift
        while True:
            low = np.minimum(label[x], label[y])
            if (label[x] == low).all() and (label[y] == low).all():
                break
            np.minimum.at(label, label[x], low)
            np.minimum.at(label, label[y], low)
            while not (label[label] == label).all():
                label = label[label]
    linked = np.flatnonzero(label != np.arange(len(codes)))
    return codes[linked], codes[label[linked]]


def close_links(codes: DataFrame, bits: int = 2, leaf: int = LEAF) -> DataFrame:
    """Links ``a, b`` that connect distinct ``code`` longs as all pairs within ``bits`` bits do.

    The index cuts Gray order into nodes by their leading bits, deeper where codes are dense,
    until a leaf has at most ``leaf`` codes. Pairs of nodes are pruned by the bits they share;
    those left are pairs of leaves, each compared in a task by the trees of both. Only links
    that connect something new within a pair of leaves are returned, so a dense cluster gives
    no more links than it has codes per pair of leaves. Nothing is capped.
    """
    ready_workers(codes.sparkSession)
    total = codes.count()
    depth = max(0, ceil(log2(max(1, total) / leaf)) + 1)
    codes = codes.select("code", _node(depth).alias("node"))
    nodes = materialize(_nodes(codes), "nodes")
    pairs = materialize(_first_pairs(nodes, depth, bits), "node_pairs")
    while nodes.filter(F.col("codes") > leaf).count():
        depth = min(64, depth + STEP)
        dense = nodes.filter(F.col("codes") > leaf).select("node", F.lit(True).alias("dense"))
        parts = codes.join(dense, "node", "left").select(
            "code",
            F.col("node").alias("parent"),
            F.when(F.col("dense"), _node(depth)).otherwise(F.col("node")).alias("node"),
        )
        parts = materialize(parts, "codes")
        codes = parts.select("code", "node")
        nodes = materialize(_nodes(codes), "nodes")
        family = nodes.join(parts.select("parent", "node").distinct(), "node")
        family = materialize(family, "family")
        pairs = materialize(_descend(pairs, family, bits), "node_pairs")

    ranked = F.struct(_unsigned(gray_rank(F.col("code"))).alias("rank"), "code")
    leaves = codes.groupBy("node").agg(
        F.sort_array(F.collect_list(ranked))["code"].alias("leaf")
    )
    leaves = materialize(leaves, "leaves")
    couples = (
        pairs.select("node", "node2")
        .join(leaves, "node")
        .join(leaves.select(F.col("node").alias("node2"), F.col("leaf").alias("leaf2")), "node2")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = batch.column("same").to_pylist()
            for row, is_same in enumerate(same):
                left, right = (
                    batch.column(c)[row].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    for c in ("leaf", "leaf2")
                )
                a, b = _spanning(left, right, bits, is_same)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
                )

    tasks = couples.select((F.col("node") == F.col("node2")).alias("same"), "leaf", "leaf2")
    return tasks.mapInArrow(compare, "a bigint, b bigint")


def _unsigned(rank: Column) -> Column:
    """Order of signed longs that is the order of their unsigned values."""
    return rank.bitwiseXOR(F.lit(-(1 << 63)).cast("bigint"))


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable.

    ``component`` names the component by one of its fingerprints, also where ids repeat.
    Documents link when their fingerprints differ in at most ``bits`` bits. Equal fingerprints
    are one code, so copies of any number cost one comparison. Null and empty texts have the
    fingerprint zero and link like others; null ids count as absent when the smallest id is
    taken, and a component of null ids alone has a null one. Repeated rows are documents each.
    """
    coded = materialize(fingerprints(docs, shingle), "fingerprints")
    codes = materialize(
        coded.groupBy("code").agg(
            F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("docs")
        ),
        "codes",
    )
    found = components(materialize(close_links(codes.select("code"), bits), "links"))
    named = codes.join(found.withColumnRenamed("node", "code"), "code", "left").select(
        "code", "first_id", "docs", F.coalesce("component", "code").alias("component")
    )
    named = materialize(named, "named")
    smallest = named.groupBy("component").agg(
        F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("codes")
    )
    smallest = materialize(smallest, "smallest")
    classes = attach(named, smallest, "component", "codes", codes.count())
    classes = materialize(classes.select("code", "docs", "component_id", "component"), "classes")
    digits = lambda code: F.lpad(F.lower(F.hex(code)), 16, "0").alias
    return attach(coded, classes, "code", "docs", coded.count()).select(
        "doc_id", digits("code")("fingerprint"), "component_id", digits("component")("component")
    )

"""From documents to packed token sequences: toxic texts go, copies go, near copies go, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of
``documents``, whole rows, whatever other columns the table has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.llm import exact, packing, simhash, toxicity
from ledgerstar.llm.common import table
from ledgerstar.llm.queries import BYTE_BPE
from ledgerstar.session import delete, materialize, scratch, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of the threshold or more go; each row is judged alone."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays, of repeated rows one of them."""
    found = materialize(exact.exact_duplicates(docs), "copies")
    names, digest = docs.columns, _free(docs, "digest")
    texts = docs.withColumn(digest, F.sha2(F.coalesce("text", F.lit("")), 256))
    gone = found.filter(~F.col("kept")).select(
        F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_digest")
    )
    same = texts["doc_id"].eqNullSafe(gone["gone_id"]) & (texts[digest] == gone["gone_digest"])
    left = texts.join(gone.distinct(), same, "left_anti")
    repeats = found.filter("kept").groupBy("doc_id", "text_sha256").count().filter("count > 1")
    if not repeats.isEmpty():
        left = left.dropDuplicates(["doc_id", digest])
    return left.select(*[left[c] for c in names])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays.

    Where rows of a group share the smallest id, or none has an id, the one with the smallest
    fingerprint of these stays, and of rows that share both one of them.
    """
    found = materialize(simhash.near_duplicates(docs), "near_duplicates")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    seen = found.filter(first).groupBy("component", "doc_id", "fingerprint")
    codes = materialize(seen.agg(F.count(F.lit(1)).alias("rows")), "first_codes")
    least = codes.groupBy("component").agg(
        F.min("fingerprint").alias("least"), F.count(F.lit(1)).alias("n")
    )
    others = codes.join(least.filter("n > 1"), "component").filter("fingerprint <> least")
    gone = found.filter(~first).select("doc_id", "fingerprint").distinct()
    gone = gone.unionByName(others.select("doc_id", "fingerprint"))
    gone = materialize(gone.toDF("gone_id", "gone_code"), "near_copies")
    names, code = docs.columns, _free(docs, "code")
    coded = simhash.with_fingerprint(docs, code)
    same = coded["doc_id"].eqNullSafe(gone["gone_id"]) & (coded[code] == gone["gone_code"])
    left = coded.join(gone, same, "left_anti")
    if not codes.filter("rows > 1").isEmpty():
        left = left.dropDuplicates(["doc_id", code])
    return left.select(*[left[c] for c in names])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, BYTE_BPE)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack),
]

# Scoring, fingerprints and packing are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage wrote on its way goes when its output is written."""
    docs, paths = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        paths.append(scratch_path(spark, name))
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(paths[-1])
        docs = spark.read.schema(kept.schema).parquet(paths[-1])
        for path in paths[:-1]:
            delete(spark, path)
    return STAGES[-1][1](spark, docs, sf_dir)

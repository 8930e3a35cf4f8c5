"""Exact duplicates by a persistent index of digests. DataFrame operations only."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.llm.attach import attach
from ledgerstar.llm.common import id_and_text
from ledgerstar.session import materialize


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the SHA-256 of the whole text in UTF-8; a null text is empty."""
    return id_and_text(docs).select("doc_id", F.sha2("text", 256).alias("text_sha256"))


class DigestIndex:
    """One row per digest, bucketed and sorted by it, so that a join never moves the index.

    A table in the session's catalog: ``text_sha256``, ``keep_id`` (largest id of the batch
    that brought the digest, null if all its ids were), ``group_size`` (rows of that batch).
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark, self.table = spark, table
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, digested: DataFrame) -> None:
        """Append the digests that the index lacks.

        The new rows are summed per digest before they move, so a text with very many copies
        sends one row per task. The sums are written, as Catalyst would push the join below them
        and so move every row. Then a sort-merge anti-join against the index drops the known;
        with as many shuffle partitions as buckets, only the new side moves. Adding a batch
        twice changes nothing.
        """
        fresh = digested.groupBy("text_sha256").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        fresh = materialize(fresh, "sums")
        if not self.exists():
            self._append(fresh.filter(F.lit(False)))
        known = self.read().select("text_sha256").hint("merge")
        # Written first, as a query may not read the table that it appends to.
        self._append(materialize(fresh.join(known, "text_sha256", "left_anti"), "fresh"))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def _append(self, rows: DataFrame) -> None:
        writer = rows.write.mode("append").bucketBy(self.buckets, "text_sha256")
        writer.sortBy("text_sha256").saveAsTable(self.table)


def exact_duplicates(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row per document: its group of equal texts and whether it is the one to keep.

    Of equal texts the row with the largest ``doc_id`` stays. With an ``index`` of earlier
    batches, a text that it already knows is dropped here, ``keep_id`` names the earlier
    document and ``group_size`` the copies of the batch that brought the text. The batch is
    then in the index. Null and empty texts are equal; a null id is below all others. Rows that
    repeat an id together with its text are the same document, so they are marked alike.

    Without an ``index`` the documents go through one of their own, which is dropped at the end,
    in two batches: first the upper half of the ids, then the others. So a text's first batch
    holds the id that stays, and what the second brings of it the anti-join drops.
    """
    digested = materialize(digests(docs), "digests")
    if index is None:
        return _in_two_batches(digested)
    earlier = None
    if index.exists():
        known = index.read().select("text_sha256")
        earlier = materialize(known.join(digested, "text_sha256", "left_semi"), "earlier")
    index.add(digested)
    # Sizes in the index are those of older batches; hot texts show in this batch's own.
    groups = _sizes(digested, "own").join(index.read(), "text_sha256")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    if earlier is not None:
        groups = groups.join(earlier.withColumn("known", F.lit(True)), "text_sha256", "left")
        kept = F.col("known").isNull() & kept
    found = attach(digested, groups, "text_sha256", "own", digested.count())
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def _sizes(digested: DataFrame, name: str) -> DataFrame:
    return digested.groupBy("text_sha256").agg(F.count(F.lit(1)).alias(name))


def _in_two_batches(digested: DataFrame) -> DataFrame:
    index = DigestIndex(digested.sparkSession, f"digests_{uuid.uuid4().hex}")
    middle = digested.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    upper = F.coalesce(F.col("doc_id") >= F.lit(middle), F.lit(False))
    try:
        for batch in (digested.filter(upper), digested.filter(~upper)):
            index.add(batch)
        keepers = index.read().select("text_sha256", "keep_id")
        groups = materialize(_sizes(digested, "group_size").join(keepers, "text_sha256"), "groups")
    finally:
        index.drop()
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    found = attach(digested, groups, "text_sha256", "group_size", digested.count())
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")

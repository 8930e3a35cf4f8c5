"""Split flat transactions into three dimensions and a fact."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ledgerstar.functions.cards import PROVIDERS, enrich_cards
from ledgerstar.functions.keys import surrogate_key
from ledgerstar.operators.columns import drop_at
from ledgerstar.operators.dedup import concat, latest_per_key
from ledgerstar.operators.joins import Dimension, join_dimensions
from ledgerstar.schemas import (
    CARD_COLUMNS,
    CUSTOMER_COLUMNS,
    CUSTOMER_KEY,
    FACT_COLUMNS,
    LANDING_FACT,
    MERCHANT_COLUMNS,
    RAW_COLUMNS,
    RAW_SCHEMA,
)
from ledgerstar.session import in_parallel, materialize
from ledgerstar.sources.csv import read_csv, write_csv


OUTPUTS = ("dim_customer", "dim_merchant", "dim_card", "fact_transactions")


def _schema_of(spark: SparkSession, path: str, **options) -> StructType:
    """The types of a flat file's columns in the order of its own header, which is read here."""
    index, *names = read_csv(spark, path, **options).columns
    if sorted(names) != sorted(RAW_COLUMNS):
        missing, unknown = set(RAW_COLUMNS) - set(names), set(names) - set(RAW_COLUMNS)
        raise ValueError(f"{path}: columns missing {sorted(missing)}, unknown {sorted(unknown)}")
    # The reader's own name for an unnamed cell; each file's header is checked against "".
    index = "" if index == "_c0" else index
    first = StructField(index, RAW_SCHEMA[0].dataType)
    return StructType([first, *[RAW_SCHEMA[name] for name in names]])


def read_transactions(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """The flat files as one table, without the index column and without repeated rows.

    Columns are aligned by the names in each file's header, after its first, the index. A file
    that lacks a column or has one more is an error. ``options`` go to the CSV reader, such as
    ``multiLine=True`` for texts with line breaks.
    """
    files = [
        drop_at(read_csv(spark, path, _schema_of(spark, path, **options), **options), 0)
        for path in paths
    ]
    return concat(*files).select(*RAW_COLUMNS).dropDuplicates()


def customers(transactions: DataFrame) -> DataFrame:
    """One row per distinct customer record, with its key; keeps the card number."""
    records = transactions.select(*CUSTOMER_KEY).distinct()
    return records.withColumn("cust_uuid", surrogate_key(*CUSTOMER_KEY))


def merchants(transactions: DataFrame) -> DataFrame:
    """One row per merchant with its newest location."""
    seen = transactions.select(
        "merchant", "trans_date_trans_time", "trans_num", "merch_lat", "merch_long"
    )
    latest = latest_per_key(
        seen,
        ["merchant"],
        "trans_date_trans_time",
        ["trans_num", "merch_lat", "merch_long"],
        few_keys=True,
    )
    return latest.withColumn("merch_uuid", surrogate_key("merchant")).select(*MERCHANT_COLUMNS)


def cards(
    customer_records: DataFrame,
    as_of: datetime.date | str | Column | None = None,
    providers: tuple[str, ...] = PROVIDERS,
    seed: str = "",
) -> DataFrame:
    """One row per card number with derived attributes."""
    numbers = customer_records.select("cc_num").distinct()
    return enrich_cards(numbers, "cc_num", as_of, providers, seed).select(*CARD_COLUMNS)


def shared_cards(customer_records: DataFrame) -> DataFrame:
    """The customer records of card numbers that have several; they repeat fact rows."""
    counts = customer_records.groupBy("cc_num").agg(F.count(F.lit(1)).alias("records"))
    several = materialize(counts.filter("records > 1").select("cc_num"), "several")
    if several.isEmpty():
        return several.select("cc_num", F.lit(None).cast("string").alias("cust_uuid"))
    found = join_dimensions(
        customer_records,
        [Dimension(several, {"cc_num": "cc_num"})],
        "left_semi",
        null_safe=True,
        spread_by=["cust_uuid"],
    )
    return materialize(found.select("cc_num", "cust_uuid"), "shared")


def fact(transactions: DataFrame, shared: DataFrame) -> DataFrame:
    """Every transaction with its merchant and customer key.

    Both keys follow from the row itself, so the two lookups need no join: each row's own
    merchant and customer record are in the dimensions by construction. Only a card number
    with several customer records yields several rows, and only those numbers, usually none,
    are joined.
    """
    keyed = transactions.withColumns(
        {"merch_uuid": surrogate_key("merchant"), "cust_uuid": surrogate_key(*CUSTOMER_KEY)}
    )
    if shared.isEmpty():
        return keyed.select(*LANDING_FACT.names)
    others = shared.withColumnRenamed("cust_uuid", "_other")
    joined = join_dimensions(
        keyed,
        [Dimension(others, {"cc_num": "cc_num"}, ["_other"])],
        "left",
        null_safe=True,
        spread_by=["trans_num"],
    )
    joined = joined.withColumn("cust_uuid", F.coalesce("_other", "cust_uuid"))
    return joined.select(*LANDING_FACT.names)


def build_dimensions(
    transactions: DataFrame,
    as_of: datetime.date | str | Column | None = None,
    providers: tuple[str, ...] = PROVIDERS,
    seed: str = "",
    narrow_fact: bool = False,
    outputs: Sequence[str] = OUTPUTS,
) -> dict[str, DataFrame]:
    """Customer, merchant, card and fact tables from deduplicated transactions.

    Several ``outputs`` share the transactions and the customer records, so each of these is
    written once to the shared folder; one dimension alone writes nothing. ``narrow_fact``
    keeps only the nine columns of the silver fact.
    """
    # Grouping turns -0.0 into 0.0; adding zero does so for every row, so that a row's own
    # key text is that of its group.
    doubles = {name: F.col(name) + 0.0 for name, type_ in transactions.dtypes if type_ == "double"}
    transactions = transactions.withColumns(doubles)
    shared = len(outputs) > 1 or "fact_transactions" in outputs
    if shared:
        transactions = materialize(transactions, "transactions")
    records = customers(transactions)
    jobs = {"records": partial(materialize, records, "customers")} if shared else {}
    if "dim_merchant" in outputs:
        jobs["dim_merchant"] = partial(merchants, transactions)
    found = in_parallel(jobs)
    records = found.get("records", records)
    built = {}
    if "dim_customer" in outputs:
        built["dim_customer"] = records.select(*CUSTOMER_COLUMNS)
    if "dim_merchant" in outputs:
        built["dim_merchant"] = found["dim_merchant"]
    if "dim_card" in outputs:
        built["dim_card"] = cards(records, as_of, providers, seed)
    if "fact_transactions" in outputs:
        facts = fact(transactions, shared_cards(records))
        built["fact_transactions"] = facts.select(*FACT_COLUMNS) if narrow_fact else facts
    return built


def land(tables: dict[str, DataFrame], folder: str) -> None:
    """Write the tables as CSV files with a header, one folder each."""
    in_parallel({name: partial(write_csv, df, f"{folder}/{name}") for name, df in tables.items()})

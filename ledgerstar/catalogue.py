"""Every operator and job as a query over the test tables.

Each query takes a session and the folder of a scale factor. ``oracles.py`` states the same
results in SQL. Queries that write use new paths in the shared folder.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from contextlib import suppress
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.functions.cards import enrich_cards, tier
from ledgerstar.functions.dates import add_years, day_parts, year_diff
from ledgerstar.functions.flags import flag, is_top_card_by_limit
from ledgerstar.functions.keys import in_range, surrogate_key
from ledgerstar.functions.text import clean_token
from ledgerstar.operators import checks, joins, profile
from ledgerstar.operators.columns import (
    cast_columns,
    drop_at,
    preview,
    rename,
    split_casts,
    spread,
    to_int,
)
from ledgerstar.operators.day_checks import DayCounts
from ledgerstar.operators.day_profile import ERROR_BOUND, DaySketches
from ledgerstar.operators.dedup import LatestRows, concat, latest_per_key, sort_rows
from ledgerstar.operators.registry import KeyRegistry
from ledgerstar.plans import bronze, dimensions, gold, medallion, silver
from ledgerstar.schemas import DAY_PARTITIONS, RAW_COLUMNS, text_schema
from ledgerstar.session import in_parallel, materialize, scratch_path
from ledgerstar.sources.csv import read_csv, read_csv_split, write_csv
from ledgerstar.sources.parquet import (
    read_parquet,
    write_observed,
    write_parquet,
    write_partitioned,
)
from ledgerstar.sources.tables import (
    Sources,
    as_view,
    bucket_count,
    copy_into,
    empty_table_like,
    save_bucketed,
    save_table,
    table_from_parquet,
)
from ledgerstar.streaming.load import load_new_files, load_new_rows

# Ages and issue dates are counted from this day, so that results do not move.
AS_OF = "2026-01-01"

TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def tables(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(spark, {name: f"{sf_dir}/{name}.parquet" for name in TABLES})


# --- the flat transaction file -------------------------------------------------------------


def _named_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, with its customer and the first supplier among its lines."""
    t = tables(spark, sf_dir)
    firsts = t["lineitem"].groupBy("l_orderkey").agg(F.min("l_suppkey").alias("suppkey"))
    supplier = joins.Dimension(t["supplier"], {"suppkey": "s_suppkey"}, ["s_name"])
    # Suppliers meet two columns here, the whole order otherwise. Hot ones are hot in the lines,
    # which need not be grouped to look.
    named = joins.join_dimensions(
        firsts,
        [supplier],
        "left",
        spread_by=["l_orderkey"],
        skew_from=t["lineitem"].select(F.col("l_suppkey").alias("suppkey")),
    )
    same = F.col("o_orderkey") == F.col("l_orderkey")
    with_merchant = t["orders"].join(named, same, "left")
    customer = joins.Dimension(
        t["customer"], {"o_custkey": "c_custkey"}, ["c_name", "c_nationkey", "c_mktsegment"]
    )
    o = joins.star_join(with_merchant, [customer], ["o_orderkey"], skew_from=t["orders"])
    return o.drop("l_orderkey", "suppkey")


def _flat(named: DataFrame) -> DataFrame:
    """Named orders in the shape of the flat file; every column follows from the row."""
    nation = F.col("c_nationkey")
    return named.select(
        F.col("o_orderdate").alias("trans_date_trans_time"),
        (F.lit(4000000000000000) + F.col("o_custkey")).alias("cc_num"),
        F.concat(F.lit("fraud_"), F.coalesce("s_name", F.lit("unlisted"))).alias("merchant"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").alias("amt"),
        F.col("c_name").alias("first"),
        F.col("c_mktsegment").alias("last"),
        F.when(nation < 12, "F").otherwise("M").alias("gender"),
        F.concat("o_custkey", F.lit(" Main Street, Unit "), nation).alias("street"),
        F.concat(F.lit('The "'), "c_mktsegment", F.lit('" Quarter')).alias("city"),
        F.concat(F.lit("S"), nation).alias("state"),
        (F.col("o_custkey") % 99000 + 501).cast("int").alias("zip"),
        (nation + F.lit(0.5)).alias("lat"),
        (F.lit(0.25) - nation).alias("long"),
        ((nation + 1) * 1000).alias("city_pop"),
        F.col("c_mktsegment").alias("job"),
        F.date_add(F.lit("1950-01-01").cast("date"), (F.col("o_custkey") % 18000).cast("int")).alias(
            "dob"
        ),
        F.concat(F.lit("t"), "o_orderkey").alias("trans_num"),
        (F.lit(1325376000) + F.col("o_orderkey")).alias("unix_time"),
        (F.col("o_orderkey") % 180 - 90).cast("double").alias("merch_lat"),
        (F.col("o_orderkey") % 360 - 180).cast("double").alias("merch_long"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_fraud"),
        "o_orderstatus",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of the flat file: one row per order, with its customer and a merchant.

    The merchant is the first supplier among the order's lines.
    """
    return _flat(_named_orders(spark, sf_dir))


def source_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """Two flat CSV files with an index column, their other columns in different orders.

    Orders of status O, here null, are in both. The orders are joined once and written narrow,
    before the texts of the flat file are made of them; both files are then written side by side.
    """
    rows = _flat(materialize(_named_orders(spark, sf_dir), "orders"))
    index = F.substring("trans_num", 2, 20).cast("bigint")
    status = F.nullif("o_orderstatus", F.lit("O"))
    # Every row but those of P is in the first file, every row but those of F in the second.
    parts = (
        (rows.filter(~status.eqNullSafe(F.lit("P"))), index, RAW_COLUMNS),
        (rows.filter(~status.eqNullSafe(F.lit("F"))), -index, RAW_COLUMNS[::-1]),
    )
    jobs = {}
    for part, position, columns in parts:
        flat = part.select(position.alias("row_index"), *columns)
        path = scratch_path(spark, "source")
        jobs[path] = partial(write_csv, flat, path)
    in_parallel(jobs)
    return list(jobs)


def landing(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "landing")
    medallion.prepare_landing(spark, source_files(spark, sf_dir), path, AS_OF)
    return path


def _landed(spark: SparkSession, tables: dict[str, DataFrame]) -> str:
    path = scratch_path(spark, "landing")
    dimensions.land(tables, path)
    return path


def built(spark: SparkSession, sf_dir: str, *outputs: str) -> dict[str, DataFrame]:
    flat = transactions(spark, sf_dir).select(*RAW_COLUMNS)
    return dimensions.build_dimensions(flat, AS_OF, outputs=outputs or dimensions.OUTPUTS)


def warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The gold tables of the whole run."""
    place = scratch_path(spark, "warehouse")
    return medallion.run(spark, landing(spark, sf_dir), place, AS_OF, even_folders=True)


# --- sources and sinks ---------------------------------------------------------------------


def csv_scan_all_string(spark, sf_dir):
    customer = tables(spark, sf_dir)["customer"]
    path = scratch_path(spark, "csv")
    write_csv(customer, path)
    return read_csv(spark, path, text_schema(customer.columns))


def csv_scan_typed(spark, sf_dir):
    lineitem = tables(spark, sf_dir)["lineitem"]
    path = scratch_path(spark, "csv")
    write_csv(lineitem, path)
    return read_csv(spark, path, lineitem.schema)


def csv_scan_inferred(spark, sf_dir):
    customer = tables(spark, sf_dir)["customer"]
    path = scratch_path(spark, "csv")
    write_csv(customer, path)
    return read_csv(spark, path, infer=True)


def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    write_parquet(tables(spark, sf_dir)["part"], path)
    return read_parquet(spark, path)


def _partitioned_orders(spark, sf_dir):
    """Orders in folders by day, and the schema that reads them back."""
    orders = bronze.with_day(tables(spark, sf_dir)["orders"], "o_orderdate")
    path = scratch_path(spark, "by-day")
    write_partitioned(orders, path, DAY_PARTITIONS, even_folders=True)
    return path, orders.schema


def partitioned_fact(spark, sf_dir):
    path, schema = _partitioned_orders(spark, sf_dir)
    return read_parquet(spark, path, schema)


def rebalanced_days(spark, sf_dir):
    """Orders in folders by day, where a hot day would be split over tasks."""
    orders = bronze.with_day(tables(spark, sf_dir)["orders"], "o_orderdate")
    path = scratch_path(spark, "by-day")
    write_partitioned(orders, path, DAY_PARTITIONS)
    return read_parquet(spark, path, orders.schema)


def rebalanced_fact(spark, sf_dir):
    """Orders in folders by year; the adaptive plan sizes the tasks."""
    orders = bronze.with_day(tables(spark, sf_dir)["orders"], "o_orderdate")
    path = scratch_path(spark, "by-year")
    write_partitioned(orders, path, ["year"])
    return read_parquet(spark, path, orders.schema)


def partition_pruned_read(spark, sf_dir):
    path, schema = _partitioned_orders(spark, sf_dir)
    return read_parquet(spark, path, schema).filter("year = '1997' and month = '12'")


def day_overwrite(spark, sf_dir):
    """Write all days, then replace January 1996 with corrected amounts."""
    path, schema = _partitioned_orders(spark, sf_dir)
    orders = bronze.with_day(tables(spark, sf_dir)["orders"], "o_orderdate")
    rerun = orders.filter("year = '1996' and month = '01'").withColumn("o_totalprice", F.lit(0.5))
    write_partitioned(rerun, path, DAY_PARTITIONS, replace_touched_only=True)
    return read_parquet(spark, path, schema)


def _set_age(spark: SparkSession, folder: str, days: int) -> None:
    """Date the files of a folder back."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    then = int((time.time() - days * 86_400) * 1000)
    for status in system.listStatus(place):
        system.setTimes(status.getPath(), then, -1)


def incremental_load(spark, sf_dir):
    """Two drops of files, each followed by two loads: every row arrives once.

    The files of the second drop are older than those of the first by a year.
    """
    status = F.nullif("o_orderstatus", F.lit("P"))
    orders = tables(spark, sf_dir)["orders"].withColumn("o_orderstatus", status)
    drop, target = scratch_path(spark, "drop"), scratch_path(spark, "loaded")
    checkpoint = scratch_path(spark, "progress")
    finished = F.col("o_orderstatus").eqNullSafe(F.lit("F"))
    for batch, age in ((orders.filter(finished), 0), (orders.filter(~finished), 365)):
        part = scratch_path(spark, "part")
        write_parquet(batch, part)
        _set_age(spark, part, age)
        moved = spark._jvm.org.apache.hadoop.fs.Path(drop)
        system = moved.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(moved)
        for found in system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{part}/*.parquet")):
            system.rename(found.getPath(), moved)
        for _ in range(2):
            load_new_files(spark, drop, orders.schema, target, checkpoint)
    return read_parquet(spark, target)


def overlapping_drops(spark, sf_dir):
    """Two drops of orders, those of status O in both: every order arrives once."""
    orders = tables(spark, sf_dir)["orders"]
    drop, target = scratch_path(spark, "drop"), scratch_path(spark, "loaded")
    checkpoint = scratch_path(spark, "progress")
    for status in ("P", "F"):
        orders.filter(F.col("o_orderstatus") != status).write.mode("append").parquet(drop)
        load_new_rows(
            spark, drop, orders.schema, target, checkpoint, ["o_orderkey"], "o_orderdate", "4000 days"
        )
    return read_parquet(spark, target)


def _ragged_customers(spark, sf_dir):
    """Customers as CSV: some lines lack a field, some have one more, some a word for a number."""
    customer = tables(spark, sf_dir)["customer"]
    names = customer.columns
    fields = [F.col(c).cast("string") for c in names]
    kind = F.col("c_custkey") % 8
    balance = F.when(kind == 2, "n/a").otherwise(fields[3])
    line = F.concat_ws(",", *fields[:3], balance)
    line = F.when(kind == 0, line).otherwise(F.concat_ws(",", line, fields[4]))
    line = F.when(kind == 1, F.concat(line, F.lit(",more"))).otherwise(line)
    path = scratch_path(spark, "ragged")
    # One column whose name and values are whole lines; the separator never occurs in them.
    whole = customer.select(line.alias(",".join(names)))
    whole.write.options(header=True, sep="\x01").csv(path)
    return read_csv_split(spark, path, customer.schema)


def csv_survivors(spark, sf_dir):
    return _ragged_customers(spark, sf_dir)[0]


def csv_quarantine(spark, sf_dir):
    return _ragged_customers(spark, sf_dir)[1].select("line")


def _table_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex}"


def table_from_parquet_query(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    write_parquet(tables(spark, sf_dir)["supplier"], path)
    return table_from_parquet(spark, _table_name("supplier"), path)


def partitioned_table(spark, sf_dir):
    path, _ = _partitioned_orders(spark, sf_dir)
    return table_from_parquet(spark, _table_name("orders"), path, partitioned=True)


def bulk_load(spark, sf_dir):
    """An empty table shaped like the files, then the same load twice."""
    path = scratch_path(spark, "parquet")
    write_parquet(tables(spark, sf_dir)["customer"], path)
    name = _table_name("customer")
    empty_table_like(spark, name, path, scratch_path(spark, "table"))
    copy_into(spark, name, path)
    return copy_into(spark, name, path)


def view_materialization(spark, sf_dir):
    part = rename(tables(spark, sf_dir)["part"], {"p_brand": "brand", "p_partkey": "part_id"})
    return as_view(part, _table_name("stg_part"))


def table_materialization(spark, sf_dir):
    segments = tables(spark, sf_dir)["customer"].groupBy("c_mktsegment", "c_nationkey")
    counted = segments.agg(F.count(F.lit(1)).alias("customers"))
    return save_table(counted, _table_name("segments"), scratch_path(spark, "table"))


# --- projections, predicates, scalar functions ---------------------------------------------


def drop_columns(spark, sf_dir):
    return drop_at(tables(spark, sf_dir)["customer"], 0).drop("c_acctbal")


def project_allowlist(spark, sf_dir):
    return tables(spark, sf_dir)["lineitem"].select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
    )


def rename_canonical(spark, sf_dir):
    names = {"s_nationkey": "nation", "s_name": "name", "s_suppkey": "id", "s_acctbal": "balance"}
    return rename(tables(spark, sf_dir)["supplier"], names)


def in_list_flag(spark, sf_dir):
    segment = F.nullif("c_mktsegment", F.lit("MACHINERY"))
    customer = tables(spark, sf_dir)["customer"].withColumn("c_mktsegment", segment)
    wanted = F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE")
    return customer.select("*", flag(wanted).alias("is_wanted"))


def threshold_flag(spark, sf_dir):
    customer = tables(spark, sf_dir)["customer"]
    return customer.select("*", is_top_card_by_limit("c_acctbal", 5000).alias("is_top"))


def regex_clean(spark, sf_dir):
    cleaned = clean_token("c_name", "Customer#")
    return tables(spark, sf_dir)["customer"].select("c_custkey", cleaned.alias("name"))


def regex_clean_anchored(spark, sf_dir):
    doubled = F.concat("c_name", F.lit(" "), "c_name")
    cleaned = clean_token(doubled, "Customer#", anchored=True)
    return tables(spark, sf_dir)["customer"].select("c_custkey", cleaned.alias("name"))


def _texts(spark, sf_dir):
    """Customer figures as text; two nations and one segment are spoilt."""
    spoilt = F.when(F.col("c_nationkey").isin(3, 7), F.concat(F.lit("x"), "c_nationkey"))
    nation = F.coalesce(spoilt, F.col("c_nationkey").cast("string"))
    balance = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "n/a")
    return tables(spark, sf_dir)["customer"].select(
        F.col("c_custkey").cast("string").alias("custkey"),
        F.when(F.col("c_nationkey") != 5, nation).alias("nation"),
        F.coalesce(balance, F.col("c_acctbal").cast("string")).alias("balance"),
        F.when(F.col("c_nationkey") == 9, "soon").otherwise("1999-12-31").alias("since"),
    )


_TEXT_TYPES = {"nation": "int", "balance": "double", "since": "date"}


def safe_casts(spark, sf_dir):
    return cast_columns(_texts(spark, sf_dir), _TEXT_TYPES, strict=False)


def cast_quarantine(spark, sf_dir):
    return split_casts(_texts(spark, sf_dir), _TEXT_TYPES)[1]


def cast_survivors(spark, sf_dir):
    return split_casts(_texts(spark, sf_dir), _TEXT_TYPES)[0]


def strict_casts(spark, sf_dir):
    lineitem = tables(spark, sf_dir)["lineitem"]
    as_text = cast_columns(lineitem, dict.fromkeys(lineitem.columns, "string"))
    types = {"l_linenumber": "int", "l_tax": "double", "l_shipdate": "date"}
    return cast_columns(as_text, types).select("l_orderkey", *types)


def int_from_float_text(spark, sf_dir):
    text = F.col("p_retailprice").cast("string")
    return tables(spark, sf_dir)["part"].select("p_partkey", to_int(text).alias("whole_price"))


def date_parts(spark, sf_dir):
    events = tables(spark, sf_dir)["events"]
    return events.select("event_id", *[c.alias(name) for name, c in day_parts("ts").items()])


def year_boundary_diff(spark, sf_dir):
    years = year_diff("o_orderdate", AS_OF)
    return tables(spark, sf_dir)["orders"].select("o_orderkey", years.alias("years"))


def date_plus_years(spark, sf_dir):
    years = in_range("o_orderkey", "years", 3, 5)
    due = add_years(F.col("o_orderdate").cast("date"), years)
    return tables(spark, sf_dir)["orders"].select("o_orderkey", years.alias("years"), due.alias("due"))


def surrogate_key_query(spark, sf_dir):
    orders = tables(spark, sf_dir)["orders"]
    priority = F.nullif("o_orderpriority", F.lit("5-LOW"))
    key = surrogate_key("o_custkey", priority, "o_orderdate")
    return orders.select("o_orderkey", key.alias("key"))


def card_enrichment(spark, sf_dir):
    cards = tables(spark, sf_dir)["customer"].select(F.col("c_custkey").alias("cc_num"))
    return enrich_cards(cards, "cc_num", AS_OF)


def tier_lookup(spark, sf_dir):
    cards = card_enrichment(spark, sf_dir).select("cc_num", "card_category")
    return spread(cards, tier("card_category"))


# --- joins ---------------------------------------------------------------------------------


def star_join(spark, sf_dir):
    t = tables(spark, sf_dir)
    # Customers meet the orders, so the lines need not move once more for them.
    order_columns, customer_columns = (
        ["o_custkey", "o_orderdate", "o_orderpriority"],
        ["c_name", "c_mktsegment"],
    )
    customer = joins.Dimension(t["customer"], {"o_custkey": "c_custkey"}, customer_columns)
    plain = t["orders"].select("o_orderkey", *order_columns)
    orders = joins.star_join(plain, [customer], ["o_orderkey"])
    names = [*order_columns, *customer_columns]
    dims = [
        joins.Dimension(orders, {"l_orderkey": "o_orderkey"}, names, sized_by=plain),
        joins.Dimension(t["part"], {"l_partkey": "p_partkey"}, ["p_name", "p_brand"]),
        joins.Dimension(t["supplier"], {"l_suppkey": "s_suppkey"}, ["s_name"]),
    ]
    lines = joins.star_join(t["lineitem"], dims)
    names = [*t["lineitem"].columns, *order_columns, "p_name", "p_brand", "s_name"]
    return lines.select(*names, *customer_columns)


def bucketed_join(spark, sf_dir):
    """Lines with their orders, both kept in buckets by order, so neither moves."""
    t = tables(spark, sf_dir)
    buckets = bucket_count(t["lineitem"], t["orders"])
    saved = [
        save_bucketed(df, _table_name(name), scratch_path(spark, "buckets"), [key], buckets)
        for name, df, key in (
            ("lines", t["lineitem"], "l_orderkey"),
            ("orders", t["orders"].select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey"),
        )
    ]
    lines, orders = saved
    return lines.join(orders.hint("merge"), lines["l_orderkey"] == orders["o_orderkey"])


def pruned_by_join(spark, sf_dir):
    """Orders of Mondays: the calendar's filter decides while running which days are scanned."""
    path, schema = _partitioned_orders(spark, sf_dir)
    orders = tables(spark, sf_dir)["orders"]
    dates = orders.select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    calendar = write_parquet(
        bronze.with_day(dates, "date").withColumn("weekday", F.weekday("date")),
        scratch_path(spark, "calendar"),
    )
    mondays = calendar.filter("weekday = 0").select(*DAY_PARTITIONS)
    return read_parquet(spark, path, schema).join(mondays, DAY_PARTITIONS)


def salted_join(spark, sf_dir):
    """A third of the lines are of one supplier; both sides shuffle, that supplier salted."""
    t = tables(spark, sf_dir)
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("bigint"))
    lines = t["lineitem"].withColumn("l_suppkey", F.coalesce(hot, "l_suppkey"))
    supplier = joins.Dimension(t["supplier"], {"l_suppkey": "s_suppkey"}, ["s_name"], large=True)
    return joins.star_join(lines, [supplier], ["l_orderkey", "l_linenumber", "l_partkey"])


def left_key_attach(spark, sf_dir):
    """Only customers in credit have a key; orders of the others get null."""
    t = tables(spark, sf_dir)
    keyed = t["customer"].filter("c_acctbal >= 0").withColumn("cust_uuid", surrogate_key("c_custkey"))
    on = {"o_custkey": "c_custkey"}
    return joins.attach_key(t["orders"], keyed, on, "cust_uuid", derived=True)


def null_safe_key_attach(spark, sf_dir):
    """A null segment is a key like any other, and keys with several rows repeat the fact."""
    t = tables(spark, sf_dir)
    segment = F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("segment")
    nations = t["customer"].select(segment, "c_nationkey").distinct()
    dim = nations.withColumn("key", surrogate_key("segment", "c_nationkey"))
    customers = t["customer"].select("c_custkey", segment)
    return joins.attach_key(customers, dim, {"segment": "segment"}, "key", derived=True)


def aligned_key_join(spark, sf_dir):
    t = tables(spark, sf_dir)
    events = cast_columns(t["events"].select("event_id", "user_id"), {"user_id": "string"})
    users = cast_columns(t["customer"].select("c_custkey", "c_name"), {"c_custkey": "string"})
    return joins.star_join(events, [joins.Dimension(users, {"user_id": "c_custkey"}, ["c_name"])])


def orphan_rows(spark, sf_dir):
    t = tables(spark, sf_dir)
    return joins.orphan_rows(t["orders"], "o_orderkey", t["lineitem"], "l_orderkey")


def orphan_keys(spark, sf_dir):
    t = tables(spark, sf_dir)
    in_credit = t["customer"].filter("c_acctbal >= 0")
    return joins.orphan_keys(t["orders"], "o_custkey", in_credit, "c_custkey")


def orphan_report(spark, sf_dir):
    t = tables(spark, sf_dir)
    orders = t["orders"].withColumn(
        "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    )
    in_credit = t["customer"].filter("c_acctbal >= 0")
    dims = {
        "customer": joins.Dimension(in_credit, {"o_custkey": "c_custkey"}),
        "lines": joins.Dimension(t["lineitem"], {"o_orderkey": "l_orderkey"}),
    }
    return joins.orphan_report(orders, dims)


# --- duplicates, counts, sorting, sets ------------------------------------------------------


def dedup_rows(spark, sf_dir):
    lines = tables(spark, sf_dir)["lineitem"].select("l_partkey", "l_linenumber", "l_returnflag")
    return lines.dropDuplicates()


def concat_by_name(spark, sf_dir):
    t = tables(spark, sf_dir)
    customer = t["customer"].selectExpr("c_name name", "c_acctbal balance", "c_mktsegment segment")
    supplier = t["supplier"].selectExpr("s_acctbal balance", "s_name name")
    return concat(customer, supplier)


def concat_dedup(spark, sf_dir):
    return drop_at(concat(*_status_files(spark, sf_dir)), 0).dropDuplicates()


def _status_files(spark, sf_dir):
    orders = tables(spark, sf_dir)["orders"]
    status = F.nullif("o_orderstatus", F.lit("O"))
    orders = orders.withColumn("o_orderstatus", status)
    first = orders.filter("NOT o_orderstatus <=> 'P'").select(F.lit(1).alias("file"), "*")
    second = orders.filter("NOT o_orderstatus <=> 'F'").select(F.lit(2).alias("file"), "*")
    return first, second


def dimension_extract(spark, sf_dir):
    return tables(spark, sf_dir)["orders"].select("o_custkey", "o_orderpriority").distinct()


def latest_per_key_query(spark, sf_dir):
    orders = tables(spark, sf_dir)["orders"]
    return latest_per_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


def latest_by_batches(spark, sf_dir):
    """The newest order of each customer, from a state that takes in one status after another."""
    orders = tables(spark, sf_dir)["orders"]
    state = LatestRows(
        spark, scratch_path(spark, "latest"), ["o_custkey"], "o_orderdate", ["o_orderkey"]
    )
    for status in ("O", "F", "P"):
        state.update(orders.filter(F.col("o_orderstatus") == status))
    return state.read()


def stable_keys(spark, sf_dir):
    """Orders with the key of their customer, who may have moved between two loads.

    The first load knows two thirds of the customers. In the second all are there, and those
    who moved have another segment; keys given in the first load stay, so every order of either
    load finds its customer.
    """
    t = tables(spark, sf_dir)
    registry = KeyRegistry(
        spark, scratch_path(spark, "registry"), {"c_custkey": "bigint"}, "cust_uuid"
    )
    attributes = ["c_custkey", "c_name", "c_mktsegment"]
    moved = F.when(F.col("c_custkey") % 5 == 0, "MOVED").otherwise(F.col("c_mktsegment"))
    first = t["customer"].select(*attributes).filter("c_custkey % 3 <> 0")
    second = t["customer"].select(*attributes).withColumn("c_mktsegment", moved)
    orders = t["orders"].select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    facts = []
    for known, part in ((first, "c_custkey % 3 <> 0"), (second, "c_custkey % 3 = 0")):
        registry.register(known, surrogate_key(*attributes))
        facts.append(materialize(registry.attach(orders.filter(part)), "facts"))
    fact = facts[0].unionByName(facts[1]).drop("c_custkey")
    dim = registry.attach(second)
    return fact.join(dim, "cust_uuid").select("o_orderkey", "cust_uuid", "c_name", "c_mktsegment")


def latest_of_few_keys(spark, sf_dir):
    """The newest line of each supplier: newest dates first, by hashing, then their lines."""
    lines = tables(spark, sf_dir)["lineitem"]
    return latest_per_key(lines, ["l_suppkey"], "l_shipdate", few_keys=True)


def multi_key_sort(spark, sf_dir):
    return sort_rows(tables(spark, sf_dir)["orders"], ["o_orderpriority"], ["o_orderdate"])


def preview_query(spark, sf_dir):
    by = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey"]
    return preview(tables(spark, sf_dir)["lineitem"], by)


def null_profile(spark, sf_dir):
    customer = tables(spark, sf_dir)["customer"]
    with_nulls = customer.withColumns(
        {
            "c_mktsegment": F.nullif("c_mktsegment", F.lit("BUILDING")),
            "c_nationkey": F.nullif("c_nationkey", F.lit(7)),
        }
    )
    return profile.null_profile(with_nulls)


def row_and_distinct_counts(spark, sf_dir):
    lines = tables(spark, sf_dir)["lineitem"].select("l_orderkey", "l_linenumber")
    return profile.row_counts(lines)


def distinct_key_count(spark, sf_dir):
    segment = F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    return profile.distinct_count(tables(spark, sf_dir)["customer"].select(segment), ["segment"])


def distinct_values(spark, sf_dir):
    return tables(spark, sf_dir)["lineitem"].select("l_returnflag").distinct()


def profile_table(spark, sf_dir):
    orders = tables(spark, sf_dir)["orders"]
    status = F.nullif("o_orderstatus", F.lit("P"))
    return profile.profile(orders.withColumn("o_orderstatus", status))


def sketched_profile(spark, sf_dir):
    """The profile of the orders of 1995 and 1996 from sketches per day, written in two runs.

    ``close`` says whether the distinct count lies within the stated bound of the true one.
    """
    orders = bronze.with_day(tables(spark, sf_dir)["orders"], "o_orderdate")
    orders = orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    kept = DaySketches(spark, scratch_path(spark, "sketches"))
    early = F.col("year") < "1996"
    for run in (orders.filter(early), orders.filter(~early)):
        kept.keep(kept.stage(run, scratch_path(spark, "staged")))
    found = kept.profile("1995-01-01", "1996-12-31")
    years = orders.filter(F.col("year").isin("1995", "1996")).drop(*DAY_PARTITIONS)
    true = profile.profile(years).select("column", F.col("distinct").alias("true"))
    away = F.abs(F.col("distinct") - F.col("true")) <= F.col("true") * ERROR_BOUND
    joined = found.join(true, "column").withColumn("close", away)
    return joined.select("position", "column", "type", "rows", "nulls", "close")


def schema_report(spark, sf_dir):
    return profile.schema_report(tables(spark, sf_dir)["lineitem"], count_nulls=True)


# --- data tests ----------------------------------------------------------------------------


def unique_failures(spark, sf_dir):
    return checks.repeated_keys(tables(spark, sf_dir)["lineitem"], ["l_orderkey", "l_linenumber"])


def not_null_tests(spark, sf_dir):
    orders = tables(spark, sf_dir)["orders"]
    with_nulls = orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return checks.not_null_failures(with_nulls, ["o_orderkey", "o_orderpriority", "o_orderdate"])


def data_test_report(spark, sf_dir):
    t = tables(spark, sf_dir)
    found = {
        "orders": t["orders"].withColumn(
            "o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW"))
        ),
        "in_credit": t["customer"].filter("c_acctbal >= 0"),
    }
    declared = {
        "orders": {
            "not_null": ["o_orderkey", "o_orderpriority"],
            "unique": ["o_orderkey", "o_custkey"],
            "relationships": {"o_custkey": ("in_credit", "c_custkey")},
        },
        "in_credit": {"not_null": ["c_name"], "unique": ["c_custkey"]},
    }
    return checks.data_test_report(found, declared)


def observed_not_null(spark, sf_dir):
    """The counts of ``not_null_tests``, gathered by the write of the table itself."""
    orders = tables(spark, sf_dir)["orders"]
    with_nulls = orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    figures = checks.null_figures(["o_orderkey", "o_orderpriority", "o_orderdate"])
    _, found = write_observed(with_nulls, scratch_path(spark, "observed"), figures)
    return checks.not_null_observed(spark, found)


def tests_by_day(spark, sf_dir):
    """Tests over all days from counts per day: two runs, then January 1996 again, now without
    the rows that the first run had twice."""
    t = tables(spark, sf_dir)
    orders = bronze.with_day(t["orders"], "o_orderdate")
    orders = orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    in_credit = t["customer"].filter("c_acctbal >= 0")
    declared = {
        "not_null": ["o_orderkey", "o_orderpriority"],
        "unique": ["o_orderkey", "o_custkey"],
        "relationships": {"o_custkey": ("in_credit", "c_custkey")},
    }
    kept = DayCounts(
        spark, scratch_path(spark, "counts"), declared["unique"], declared["not_null"]
    )
    january = orders.filter("year = '1996' and month = '01'")
    early = F.col("year") < "1997"
    for run in (orders.filter(early).unionByName(january), orders.filter(~early)):
        kept.keep(kept.stage(run, scratch_path(spark, "staged")))
    staged = kept.stage(january, scratch_path(spark, "staged"))
    return kept.report("orders", declared, {"in_credit": in_credit}, staged)


# --- jobs ----------------------------------------------------------------------------------


def flat_files_read(spark, sf_dir):
    return dimensions.read_transactions(spark, source_files(spark, sf_dir))


def build_dim_customer(spark, sf_dir):
    return built(spark, sf_dir, "dim_customer")["dim_customer"]


def build_dim_merchant(spark, sf_dir):
    return built(spark, sf_dir, "dim_merchant")["dim_merchant"]


def build_dim_card(spark, sf_dir):
    return built(spark, sf_dir, "dim_card")["dim_card"]


def build_fact(spark, sf_dir):
    return built(spark, sf_dir, "fact_transactions")["fact_transactions"]


def build_fact_shared_cards(spark, sf_dir):
    """Pairs of customers share a card number, so each of their transactions appears twice."""
    flat = transactions(spark, sf_dir).select(*RAW_COLUMNS)
    paired = F.lit(4000000000000000) + F.floor((F.col("cc_num") - 4000000000000000) / 2)
    flat = flat.withColumn("cc_num", paired.cast("bigint"))
    return dimensions.build_dimensions(flat, AS_OF, narrow_fact=True)["fact_transactions"]


def flat_files_with_line_breaks(spark, sf_dir):
    """The same rows from files whose street names have line breaks and quotes."""
    flat = transactions(spark, sf_dir)
    street = F.regexp_replace("street", ", ", ',\n"')
    path = scratch_path(spark, "source")
    write_csv(flat.withColumn("street", street).select(F.lit(0).alias("n"), *RAW_COLUMNS), path)
    return dimensions.read_transactions(spark, [path], multiLine=True)


def bronze_fact(spark, sf_dir):
    place = scratch_path(spark, "bronze")
    return bronze.bronze_fact(spark, landing(spark, sf_dir), place, even_folders=True)


def _bronze_dimension(spark, sf_dir, name):
    out = scratch_path(spark, "bronze")
    return bronze.bronze_dimension(spark, landing(spark, sf_dir), out, name)


def bronze_dim_customer(spark, sf_dir):
    return _bronze_dimension(spark, sf_dir, "dim_customer")


def bronze_dim_merchant(spark, sf_dir):
    return _bronze_dimension(spark, sf_dir, "dim_merchant")


def bronze_dim_card(spark, sf_dir):
    return _bronze_dimension(spark, sf_dir, "dim_card")


def _silver(spark, sf_dir, name):
    if name == "fact_transactions":
        table = bronze_fact(spark, sf_dir)
    else:
        table = _bronze_dimension(spark, sf_dir, name)
    return silver.silver({name: table}, scratch_path(spark, "silver"))[name]


def silver_dim_customer(spark, sf_dir):
    return _silver(spark, sf_dir, "dim_customer")


def silver_dim_merchant(spark, sf_dir):
    return _silver(spark, sf_dir, "dim_merchant")


def silver_dim_card(spark, sf_dir):
    return _silver(spark, sf_dir, "dim_card")


def silver_fact(spark, sf_dir):
    return _silver(spark, sf_dir, "fact_transactions")


def gold_dim_card(spark, sf_dir):
    return gold.dim_card(silver_dim_card(spark, sf_dir))


def gold_dim_card_by_limit(spark, sf_dir):
    return gold.dim_card(silver_dim_card(spark, sf_dir), top_limit=10_000)


def gold_dim_customer(spark, sf_dir):
    return gold.dim_customer(silver_dim_customer(spark, sf_dir), AS_OF)


def gold_dim_merchant(spark, sf_dir):
    return warehouse(spark, sf_dir)["dim_merchant"]


def bronze_silver_gold(spark, sf_dir):
    return warehouse(spark, sf_dir)["fact_transactions"]


def daily_rerun(spark, sf_dir):
    """All days, then the days of January 1996 again with corrected amounts."""
    built_tables = built(spark, sf_dir)
    place = scratch_path(spark, "warehouse")
    medallion.run_days(spark, _landed(spark, built_tables), place, AS_OF, even_folders=True)
    fact = built_tables["fact_transactions"]
    moment = F.col("trans_date_trans_time")
    month = fact.filter((moment >= "1996-01-01") & (moment < "1996-02-01"))
    again = built_tables | {"fact_transactions": month.withColumn("amt", F.lit(0.5))}
    return medallion.run_days(spark, _landed(spark, again), place, AS_OF)["fact_transactions"]


def named_gold_fact(spark, sf_dir):
    """The gold fact and a staging view, read by name after a run."""
    names = _table_name("wh") + "_"
    place = scratch_path(spark, "warehouse")
    medallion.run(spark, landing(spark, sf_dir), place, AS_OF, names, even_folders=True)
    fact, staged = spark.table(f"{names}fact_transactions"), spark.table(f"{names}stg_dim_merchant")
    return fact.join(staged.select("merch_uuid", "merch_lat"), "merch_uuid")


def publish_after_tests(spark, sf_dir):
    """A second run has some transactions twice and fails its tests: readers keep the first's."""
    names, place = _table_name("wh") + "_", scratch_path(spark, "warehouse")
    built_tables = built(spark, sf_dir)
    fact = built_tables["fact_transactions"]
    twice = built_tables | {"fact_transactions": fact.unionByName(fact.filter("is_fraud = 1"))}
    medallion.run(spark, _landed(spark, built_tables), place, AS_OF, names, even_folders=True)
    with suppress(checks.DataTestFailure):
        medallion.run(spark, _landed(spark, twice), place, AS_OF, names, even_folders=True)
    return spark.table(f"{names}fact_transactions")


def named_days(spark, sf_dir):
    """The gold fact by name after two daily runs, each of which registers its own days alone."""
    names, place = _table_name("wh") + "_", scratch_path(spark, "warehouse")
    built_tables = built(spark, sf_dir)
    fact = built_tables["fact_transactions"]
    moment = F.col("trans_date_trans_time")
    for days in (moment < "1996-02-01", moment >= "1996-01-01"):
        part = built_tables | {"fact_transactions": fact.filter(days)}
        medallion.run_days(
            spark, _landed(spark, part), place, AS_OF, even_folders=True, names=names
        )
    return spark.table(f"{names}fact_transactions")


def gold_tests(spark, sf_dir):
    return gold.gold_test_report(warehouse(spark, sf_dir))


def gold_lost_facts(spark, sf_dir):
    """What the gold join would lose if the customers of one segment were missing."""
    raw = bronze.bronze(spark, landing(spark, sf_dir), scratch_path(spark, "bronze"))
    cleaned = silver.silver(raw, scratch_path(spark, "silver"))
    cleaned["dim_customer"] = cleaned["dim_customer"].filter("job <> 'BUILDING'")
    return gold.lost_facts(cleaned)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "star_join": star_join,
    "csv_scan_all_string": csv_scan_all_string,
    "csv_scan_typed": csv_scan_typed,
    "csv_scan_inferred": csv_scan_inferred,
    "parquet_roundtrip": parquet_roundtrip,
    "partitioned_fact": partitioned_fact,
    "rebalanced_fact": rebalanced_fact,
    "rebalanced_days": rebalanced_days,
    "partition_pruned_read": partition_pruned_read,
    "day_overwrite": day_overwrite,
    "incremental_load": incremental_load,
    "table_from_parquet": table_from_parquet_query,
    "partitioned_table": partitioned_table,
    "bulk_load": bulk_load,
    "view_materialization": view_materialization,
    "table_materialization": table_materialization,
    "drop_columns": drop_columns,
    "project_allowlist": project_allowlist,
    "rename_canonical": rename_canonical,
    "in_list_flag": in_list_flag,
    "threshold_flag": threshold_flag,
    "regex_clean": regex_clean,
    "regex_clean_anchored": regex_clean_anchored,
    "safe_casts": safe_casts,
    "cast_quarantine": cast_quarantine,
    "cast_survivors": cast_survivors,
    "strict_casts": strict_casts,
    "int_from_float_text": int_from_float_text,
    "date_parts": date_parts,
    "year_boundary_diff": year_boundary_diff,
    "date_plus_years": date_plus_years,
    "surrogate_key": surrogate_key_query,
    "card_enrichment": card_enrichment,
    "tier_lookup": tier_lookup,
    "salted_join": salted_join,
    "bucketed_join": bucketed_join,
    "pruned_by_join": pruned_by_join,
    "overlapping_drops": overlapping_drops,
    "csv_survivors": csv_survivors,
    "csv_quarantine": csv_quarantine,
    "latest_by_batches": latest_by_batches,
    "stable_keys": stable_keys,
    "observed_not_null": observed_not_null,
    "tests_by_day": tests_by_day,
    "publish_after_tests": publish_after_tests,
    "named_days": named_days,
    "left_key_attach": left_key_attach,
    "null_safe_key_attach": null_safe_key_attach,
    "aligned_key_join": aligned_key_join,
    "orphan_rows": orphan_rows,
    "orphan_keys": orphan_keys,
    "orphan_report": orphan_report,
    "dedup_rows": dedup_rows,
    "concat_by_name": concat_by_name,
    "concat_dedup": concat_dedup,
    "dimension_extract": dimension_extract,
    "latest_per_key": latest_per_key_query,
    "latest_of_few_keys": latest_of_few_keys,
    "multi_key_sort": multi_key_sort,
    "preview": preview_query,
    "null_profile": null_profile,
    "row_and_distinct_counts": row_and_distinct_counts,
    "distinct_key_count": distinct_key_count,
    "distinct_values": distinct_values,
    "profile_table": profile_table,
    "sketched_profile": sketched_profile,
    "schema_report": schema_report,
    "unique_failures": unique_failures,
    "not_null_tests": not_null_tests,
    "data_test_report": data_test_report,
    "flat_files_read": flat_files_read,
    "flat_files_with_line_breaks": flat_files_with_line_breaks,
    "build_dim_customer": build_dim_customer,
    "build_dim_merchant": build_dim_merchant,
    "build_dim_card": build_dim_card,
    "build_fact": build_fact,
    "build_fact_shared_cards": build_fact_shared_cards,
    "bronze_fact": bronze_fact,
    "bronze_dim_customer": bronze_dim_customer,
    "bronze_dim_merchant": bronze_dim_merchant,
    "bronze_dim_card": bronze_dim_card,
    "silver_dim_customer": silver_dim_customer,
    "silver_dim_merchant": silver_dim_merchant,
    "silver_dim_card": silver_dim_card,
    "silver_fact": silver_fact,
    "gold_dim_card": gold_dim_card,
    "gold_dim_card_by_limit": gold_dim_card_by_limit,
    "gold_dim_customer": gold_dim_customer,
    "gold_dim_merchant": gold_dim_merchant,
    "bronze_silver_gold": bronze_silver_gold,
    "daily_rerun": daily_rerun,
    "named_gold_fact": named_gold_fact,
    "gold_tests": gold_tests,
    "gold_lost_facts": gold_lost_facts,
}

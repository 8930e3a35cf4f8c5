"""The whole run: flat files to tested gold tables."""

from __future__ import annotations

import datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.operators.checks import data_test_report, gate
from ledgerstar.operators.day_checks import DayCounts
from ledgerstar.plans import gold as gold_layer
from ledgerstar.plans.bronze import bronze, bronze_dimension, bronze_fact, with_day
from ledgerstar.plans.dimensions import build_dimensions, land, read_transactions
from ledgerstar.plans.silver import silver, silver_table
from ledgerstar.schemas import (
    DAY_PARTITIONS,
    GOLD_TESTS,
    LANDING_DIMENSIONS,
    LANDING_FACT,
    STAGING_COLUMNS,
)
from ledgerstar.session import delete, in_parallel, scratch
from ledgerstar.sources.csv import read_csv
from ledgerstar.sources.parquet import read_parquet, write_parquet, write_partitioned
from ledgerstar.sources.snapshots import Snapshots, move, switch_table, version_name
from ledgerstar.sources.tables import as_view, partitioned_table, register_partitions

FACT = "fact_transactions"


def prepare_landing(
    spark: SparkSession,
    paths: list[str],
    landing: str,
    as_of: datetime.date | str | Column | None = None,
    **options,
) -> None:
    """Split the flat source files and write the landing CSV files.

    Intermediate tables are deleted when the landing is written. ``options`` go to the reader.
    """
    with scratch(spark):
        land(build_dimensions(read_transactions(spark, paths, **options), as_of), landing)


def run(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    as_of: datetime.date | str | Column | None = None,
    names: str | None = None,
    even_folders: bool = False,
    **options,
) -> dict[str, DataFrame]:
    """Bronze, silver, gold, then the data tests; raises when a test fails.

    Gold tables are written beside the published ones and replace them only when all tests have
    passed; a run that fails leaves what readers see as it was, and its own tables below
    ``gold/versions`` to look at. Null counts are gathered while gold is written. The test
    results and the facts lost in the gold join are written below ``reports`` first. Each layer
    reads what the one before wrote, so a run that broke off is simply started again.

    Without ``names`` the tables are moved to ``gold/<table>``. With ``names`` they stay in their
    version, which ``Snapshots`` publishes at once, and can be queried by name: a view
    ``{names}stg_{table}`` per staging table, a table ``{names}{table}`` per gold one. Older
    versions than the last two are deleted. ``even_folders`` as in ``write_partitioned``;
    ``options`` go to the CSV reader.
    """
    raw = bronze(spark, landing, f"{warehouse}/bronze", even_folders=even_folders, **options)
    cleaned = silver(raw, f"{warehouse}/silver")
    snapshots = Snapshots(spark, f"{warehouse}/gold")
    version = version_name()
    staged = snapshots.path(version)
    tables, nulls = gold_layer.gold_observed(cleaned, staged, as_of)
    tests = gold_layer.gold_test_report(tables, nulls)
    _report(tests, gold_layer.lost_facts(cleaned), warehouse)
    if names is not None:
        tables = publish(spark, cleaned, snapshots, version, names)
    else:
        for name in tables:
            move(spark, f"{staged}/{name}", f"{warehouse}/gold/{name}")
        tables = gold_layer.read_gold(spark, f"{warehouse}/gold")
    snapshots.expire()
    return tables


def _report(tests: DataFrame, lost: DataFrame, warehouse: str) -> None:
    """Write both reports, then raise if a test failed."""
    reports = in_parallel(
        {
            name: partial(write_parquet, report.coalesce(1), f"{warehouse}/reports/{name}")
            for name, report in {"data_tests": tests, "lost_facts": lost}.items()
        }
    )
    gate(reports["data_tests"])


def publish(
    spark: SparkSession,
    cleaned: dict[str, DataFrame],
    snapshots: Snapshots,
    version: str,
    names: str,
) -> dict[str, DataFrame]:
    """Let readers see a tested version: by ``Snapshots.read`` at once, then by name."""
    snapshots.publish(version)
    for name, staged in gold_layer.staging(cleaned).items():
        as_view(staged, f"{names}stg_{name}")
    return {
        name: switch_table(spark, f"`{names}{name}`", f"{snapshots.path(version)}/{name}")
        for name in STAGING_COLUMNS
    }


def run_days(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    as_of: datetime.date | str | Column | None = None,
    even_folders: bool = False,
    names: str | None = None,
    **options,
) -> dict[str, DataFrame]:
    """Bring the days of the landed fact through all layers and leave the other days as they are.

    For daily runs and backfill: bronze, silver and gold keep their facts in folders by day
    (below ``days`` for silver and gold), and only the folders of the landed days are replaced,
    so a run that broke off is started again. The landed dimensions replace the old ones whole
    and must know the keys of all days. A day's gold rows take the names of the run that wrote
    them.

    The data tests and reports cover all days at the cost of the landed ones: counts per key and
    day are kept (``DayCounts``), and other days' facts are not read. Gold, dimensions and facts,
    and the counts are staged first and published only if all tests pass. With ``names`` each
    gold table has a name, and the fact's learns of the landed days alone.
    """
    days = {"replace_touched_only": True, "even_folders": even_folders}
    dimensions = in_parallel(
        {
            name: partial(
                bronze_dimension, spark, landing, f"{warehouse}/bronze", name, **options
            )
            for name in LANDING_DIMENSIONS
        }
    )
    bronze_fact(spark, landing, f"{warehouse}/bronze", True, even_folders, **options)
    cleaned = silver(dimensions, f"{warehouse}/silver")
    landed = read_csv(spark, f"{landing}/{FACT}", LANDING_FACT, **options)
    touched = with_day(silver_table(FACT, landed))
    write_partitioned(touched, f"{warehouse}/silver/days/{FACT}", DAY_PARTITIONS, **days)
    tables = gold_layer.gold_tables(cleaned | {FACT: touched.drop(*DAY_PARTITIONS)}, as_of)

    gold_path = f"{warehouse}/gold"
    snapshots = Snapshots(spark, gold_path)
    staged = snapshots.path(version_name())
    schema = with_day(tables[FACT]).schema
    write_partitioned(
        with_day(tables[FACT]), f"{staged}/{FACT}", DAY_PARTITIONS, even_folders=even_folders
    )
    facts = read_parquet(spark, f"{staged}/{FACT}", schema)
    others = in_parallel(
        {
            name: partial(write_parquet, df, f"{staged}/{name}")
            for name, df in tables.items()
            if name != FACT
        }
    )

    declared = GOLD_TESTS[FACT]
    keys = dict.fromkeys([*declared["unique"], *declared["relationships"]])
    kept = DayCounts(spark, f"{warehouse}/counts/gold", list(keys), declared["not_null"])
    dims = gold_layer.fact_dimensions(gold_layer.staging(cleaned | {FACT: touched}))
    joined = {name: next(iter(dim.on.items())) for name, dim in dims.items()}
    lost_by = [key for key, _ in joined.values()]
    kept_silver = DayCounts(spark, f"{warehouse}/counts/silver", lost_by)
    counts = kept.stage(facts, f"{staged}/counts/gold")
    counts_silver = kept_silver.stage(touched, f"{staged}/counts/silver")
    tests = data_test_report(others, {n: t for n, t in GOLD_TESTS.items() if n != FACT})
    tests = tests.unionByName(kept.report(FACT, declared, others, counts))
    lost = [
        kept_silver.key_failures(key, dims[name].table, parent_key, counts_silver).select(
            F.lit(name).alias("dimension"), "null_rows", "orphan_rows"
        )
        for name, (key, parent_key) in joined.items()
    ]
    _report(tests, reduce(DataFrame.unionAll, lost), warehouse)

    # Staged by day already, so rows need not move again.
    days = {"replace_touched_only": True, "rebalance": False}
    write_partitioned(facts, f"{gold_path}/days/{FACT}", DAY_PARTITIONS, **days)
    kept.keep(counts)
    kept_silver.keep(counts_silver)
    for name in others:
        move(spark, f"{staged}/{name}", f"{gold_path}/{name}")
    written = {name: read_parquet(spark, f"{gold_path}/{name}") for name in others}
    if names is not None:
        for name in others:
            switch_table(spark, f"`{names}{name}`", f"{gold_path}/{name}")
        table = f"`{names}{FACT}`"
        if not spark.catalog.tableExists(table):
            partitioned_table(spark, table, schema, DAY_PARTITIONS, f"{gold_path}/days/{FACT}")
        rows = [tuple(r) for r in facts.select(*DAY_PARTITIONS).distinct().collect()]
        register_partitions(spark, table, DAY_PARTITIONS, rows, f"{gold_path}/days/{FACT}")
    delete(spark, staged)
    facts = read_parquet(spark, f"{gold_path}/days/{FACT}", schema)
    return written | {FACT: facts.select(*tables[FACT].columns)}

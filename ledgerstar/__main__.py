"""Run a stage of the job by itself: ``python -m ledgerstar land|run|days ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgerstar.plans import medallion
from ledgerstar.session import SESSION_SETTINGS


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgerstar", description=__doc__)
    stages = top.add_subparsers(dest="stage", required=True)
    land = stages.add_parser("land", help="split flat files and write the landing CSV files")
    land.add_argument("files", nargs="+")
    run = stages.add_parser("run", help="landing to bronze, silver and gold, then the data tests")
    days = stages.add_parser("days", help="the same, replacing only the days of the landed fact")
    for stage in (run, days):
        stage.add_argument("--warehouse", required=True)
        stage.add_argument("--names", help="prefix under which the results can be queried by name")
    for stage in (land, run, days):
        stage.add_argument("--landing", required=True)
        stage.add_argument("--as-of", help="the day that ages and card dates count from")
        stage.add_argument("--multi-line", action="store_true", help="texts have line breaks")
    return top


def main(arguments: list[str] | None = None) -> None:
    """Settings such as ``spark.checkpoint.dir`` come from ``spark-submit`` or its defaults."""
    given = parser().parse_args(arguments)
    spark = SparkSession.builder.config(map=SESSION_SETTINGS).getOrCreate()
    options = {"multiLine": True} if given.multi_line else {}
    if given.stage == "land":
        medallion.prepare_landing(spark, given.files, given.landing, given.as_of, **options)
    elif given.stage == "run":
        medallion.run(
            spark, given.landing, given.warehouse, given.as_of, given.names, **options
        )
    else:
        medallion.run_days(
            spark, given.landing, given.warehouse, given.as_of, names=given.names, **options
        )


if __name__ == "__main__":
    main()

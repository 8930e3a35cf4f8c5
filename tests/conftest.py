import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import pytest
from pyspark.sql import SparkSession

from ledgerstar.session import SESSION_SETTINGS

SMALL = "/root/testdata/sf0.001"


def local_session(cpus: int = 8) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("ledgerstar")
    settings = SESSION_SETTINGS | {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture
def rows(spark):
    """Make a DataFrame from a DDL schema and row tuples."""

    def make(schema: str, *values: tuple):
        return spark.createDataFrame(list(values), schema)

    return make

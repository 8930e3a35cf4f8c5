"""Run queries next to their SQL in DuckDB and compare columns, types and rows.

``python tests/parity.py [scale folder] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import pyarrow as pa

import __spark_entry__ as spark_entry


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _kind(type_: pa.DataType) -> str:
    if pa.types.is_string(type_) or pa.types.is_large_string(type_):
        return "string"
    if pa.types.is_timestamp(type_):
        return "timestamp"
    return str(type_)


def difference(spark_table: pa.Table, duck_table: pa.Table) -> str | None:
    """What differs, or None. Rows count as a multiset, columns by name."""
    found = {f.name: _kind(f.type) for f in spark_table.schema}
    wanted = {f.name: _kind(f.type) for f in duck_table.schema}
    if found != wanted:
        return f"columns {sorted(found.items() ^ wanted.items())}"
    if spark_table.num_rows != duck_table.num_rows:
        return f"{spark_table.num_rows} rows, expected {duck_table.num_rows}"
    names = sorted(found)
    rows = Counter(zip(*[spark_table.column(n).to_pylist() for n in names]))
    expected = Counter(zip(*[duck_table.column(n).to_pylist() for n in names]))
    if rows != expected:
        return f"{names} has {list((rows - expected))[:2]}, expected {list((expected - rows))[:2]}"
    return None


def check(spark, con, sf_dir: str, name: str) -> str | None:
    result = spark_entry.queries()[name](spark, sf_dir).toArrow()
    return difference(result, con.sql(spark_entry.oracle_sql()[name]).to_arrow_table())


def main() -> None:
    from conftest import local_session

    sf_dir, *names = sys.argv[1:] or ["/root/testdata/sf0.01"]
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name in names or spark_entry.queries():
        start = time.time()
        try:
            problem = check(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:26s} {time.time() - start:6.2f}s {problem or 'same'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()

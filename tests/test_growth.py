"""Steps that decide how the time of the jobs grows."""

import threading

from ledgerstar import catalogue
from ledgerstar.plans import bronze, dimensions, medallion, silver
from ledgerstar.schemas import RAW_COLUMNS
from ledgerstar.sources.csv import read_csv
from test_jobs import AS_OF, HEADER, line


def _tables(rows, folder):
    """Two orders, one without lines, as the smallest tables that ``transactions`` reads."""
    made = {
        "customer": rows(
            "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
            (1, "Ann", 3, "BUILDING"),
        ),
        "supplier": rows("s_suppkey bigint, s_name string", (5, "S5"), (6, "S6")),
        "orders": rows(
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
            " o_orderdate timestamp_ntz, o_orderpriority string",
            (7, 1, "F", 1.5, None, "1-URGENT"),
            (8, 1, "O", 2.5, None, "5-LOW"),
        ),
        "lineitem": rows("l_orderkey bigint, l_suppkey bigint", (7, 6), (7, 5)),
    }
    for name, df in made.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_source_files_are_written_side_by_side_from_narrow_orders(
    spark, rows, tmp_path, monkeypatch
):
    both, kept = threading.Barrier(2, timeout=30), []
    write, keep = catalogue.write_csv, catalogue.materialize

    def together(df, path):
        both.wait()
        write(df, path)

    def seen(df, name):
        kept.append(df.columns)
        return keep(df, name)

    monkeypatch.setattr(catalogue, "write_csv", together)
    monkeypatch.setattr(catalogue, "materialize", seen)
    first, second = catalogue.source_files(spark, _tables(rows, tmp_path))
    assert "s_name" in kept[-1] and not {"street", "city", "merchant"} & set(kept[-1])
    one, two = read_csv(spark, first), read_csv(spark, second)
    assert one.columns[1:] == RAW_COLUMNS and two.columns[1:] == RAW_COLUMNS[::-1]
    found = sorted((r.trans_num, r.merchant, r.row_index) for r in one.collect())
    assert found == [("t7", "fraud_S5", "7"), ("t8", "fraud_unlisted", "8")]
    assert [(r.trans_num, r.row_index) for r in two.collect()] == [("t8", "-8")]


def test_merchants_do_not_wait_for_customers(spark, tmp_path, monkeypatch):
    path = tmp_path / "flat.csv"
    path.write_text("\n".join([HEADER, line(1), line(2, first="Bob")]) + "\n")
    both = threading.Barrier(2, timeout=30)
    keep, latest = dimensions.materialize, dimensions.merchants

    def kept(df, name):
        if name == "customers":
            both.wait()
        return keep(df, name)

    def found(transactions):
        both.wait()
        return latest(transactions)

    monkeypatch.setattr(dimensions, "materialize", kept)
    monkeypatch.setattr(dimensions, "merchants", found)
    built = dimensions.build_dimensions(dimensions.read_transactions(spark, [str(path)]), AS_OF)
    assert built["dim_customer"].count() == 2 and built["dim_merchant"].count() == 1


def test_silver_merges_small_files(spark, tmp_path):
    days = [f"2019-{1 + n // 28:02d}-{1 + n % 28:02d}" for n in range(60)]
    flat = [HEADER, *[line(n, day=day) for n, day in enumerate(days)]]
    (tmp_path / "flat.csv").write_text("\n".join(flat) + "\n")
    landing = str(tmp_path / "landing")
    medallion.prepare_landing(spark, [str(tmp_path / "flat.csv")], landing, AS_OF)
    raw = bronze.bronze_fact(spark, landing, str(tmp_path / "bronze"), even_folders=True)
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "4m")
    try:
        cleaned = silver.silver({"fact_transactions": raw}, str(tmp_path / "silver"))
    finally:
        spark.conf.set(setting, before)
    files = list((tmp_path / "silver" / "fact_transactions").glob("part-*"))
    assert len(files) <= 2 * spark.sparkContext.defaultParallelism < len(days)
    assert cleaned["fact_transactions"].count() == len(days)

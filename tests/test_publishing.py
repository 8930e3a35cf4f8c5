"""Snapshots, staged runs, counts per day, and figures gathered by a write."""

import pytest
from pyspark.sql import functions as F
from test_jobs import AS_OF, HEADER, flat, landed, line  # noqa: F401

from ledgerstar.operators import checks
from ledgerstar.operators.checks import DataTestFailure
from ledgerstar.operators.day_checks import DayCounts
from ledgerstar.operators.day_profile import ERROR_BOUND, DaySketches
from ledgerstar.plans import bronze, dimensions, gold, medallion
from ledgerstar.schemas import GOLD_TESTS, LANDING_FACT
from ledgerstar.sources.parquet import read_parquet, write_observed, write_partitioned
from ledgerstar.sources.snapshots import Snapshots, switch_table, version_name


def test_snapshots(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "s"))
    assert store.current() is None and store.expire() == []
    with pytest.raises(FileNotFoundError):
        store.read("t")
    names = []
    for n in range(4):
        names.append(version_name())
        spark.range(n + 1).write.parquet(f"{store.path(names[-1])}/t")
    assert names == sorted(names) == store.versions()
    store.publish(names[0])
    old = store.read("t")
    assert store.read("t").count() == 1
    store.publish(names[2])
    assert store.read("t").count() == 3 and old.count() == 1  # begun readers go on
    store.publish(names[0])
    assert store.expire(keep=1) == names[1:3]
    assert store.versions() == [names[0], names[3]] and store.read("t").count() == 1


def test_a_name_switches_to_other_files(spark, tmp_path):
    for n, columns in ((1, "id"), (2, "id"), (3, "id as other")):
        spark.range(n).selectExpr(columns).write.parquet(str(tmp_path / str(n)))
    assert switch_table(spark, "switched", str(tmp_path / "1")).count() == 1
    assert switch_table(spark, "switched", str(tmp_path / "2")).count() == 2
    assert spark.table("switched").count() == 2
    assert switch_table(spark, "switched", str(tmp_path / "3")).columns == ["other"]
    spark.sql("DROP TABLE switched")


@pytest.fixture
def broken(spark, tmp_path):
    """Landing files in which two customers share a card, so transactions repeat."""
    lines = [line(1, first="Ann"), line(2, first="Bob")]
    (tmp_path / "broken.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    landing = str(tmp_path / "broken")
    medallion.prepare_landing(spark, [str(tmp_path / "broken.csv")], landing, AS_OF)
    return landing


def test_a_failed_run_leaves_what_readers_see(spark, landed, broken, tmp_path):  # noqa: F811
    out = str(tmp_path / "wh")
    for names in (None, "kept_"):
        first = medallion.run(spark, landed, out, AS_OF, names)
        rows = sorted(first["fact_transactions"].collect())
        with pytest.raises(DataTestFailure, match="unique fact_transactions.trans_num"):
            medallion.run(spark, broken, out, AS_OF, names)
        if names:
            assert sorted(spark.table("kept_fact_transactions").collect()) == rows
            store = Snapshots(spark, f"{out}/gold")
            assert sorted(store.read("fact_transactions").collect()) == rows
            assert len(store.versions()) >= 2 and store.current() != store.versions()[-1]
        else:
            found = gold.read_gold(spark, f"{out}/gold")["fact_transactions"]
            assert sorted(found.collect()) == rows
    failed = read_parquet(spark, f"{out}/reports/data_tests").filter("failures > 0")
    assert failed.count() == 1


def test_a_failed_daily_run_leaves_days_counts_and_dimensions(spark, landed, broken, tmp_path):  # noqa: F811
    out = str(tmp_path / "wh")
    rows = {n: sorted(t.collect()) for n, t in medallion.run_days(spark, landed, out, AS_OF).items()}
    with pytest.raises(DataTestFailure):
        medallion.run_days(spark, broken, out, AS_OF)
    found = read_parquet(spark, f"{out}/gold/days/fact_transactions")
    assert sorted(r.trans_num for r in found.collect()) == ["t1", "t2", "t3", "t4"]
    for name in ("dim_card", "dim_customer", "dim_merchant"):
        assert sorted(read_parquet(spark, f"{out}/gold/{name}").collect()) == rows[name]
    kept = DayCounts(spark, f"{out}/counts/gold", ["trans_num"])
    assert kept.key_rows("trans_num").filter("rows > 1").isEmpty()
    # The next good run goes through.
    again = medallion.run_days(spark, landed, out, AS_OF)
    assert {n: sorted(t.collect()) for n, t in again.items()} == rows


def test_observed_nulls_equal_a_scan(spark, rows, tmp_path):
    df = rows("a int, b string", (1, None), (None, None), (3, "x")).repartition(3)
    written, found = write_observed(df, str(tmp_path / "t"), checks.null_figures(["a", "b"]))
    assert found == {"a": 1, "b": 2} and written.count() == 3
    scanned = checks.not_null_failures(written, ["a", "b"])
    assert sorted(checks.not_null_observed(spark, found).collect()) == sorted(scanned.collect())
    empty, found = write_observed(df.limit(0), str(tmp_path / "e"), checks.null_figures(["a"]))
    assert found == {"a": 0} and empty.count() == 0


def test_a_run_does_not_read_gold_for_not_null(spark, landed, tmp_path, capsys):  # noqa: F811
    tables = medallion.run(spark, landed, str(tmp_path / "wh"), AS_OF)
    nulls = {name: dict.fromkeys(t["not_null"], 0) for name, t in GOLD_TESTS.items()}
    report = gold.gold_test_report(tables, nulls)
    assert sorted(report.collect()) == sorted(gold.gold_test_report(tables).collect())
    report.explain()
    lines = capsys.readouterr().out.splitlines()
    scans = "".join(text.rsplit("ReadSchema:", 1)[1] for text in lines if "ReadSchema:" in text)
    assert "trans_num" in scans and "amt" not in scans and "credit_limit" not in scans


DAY = "d string, k string, v int, year string, month string, day string"


def _day(spark, day, *values):
    made = [("", k, v, "2020", "01", day) for k, v in values]
    return spark.createDataFrame(made, DAY).drop("d")


def test_counts_per_day_equal_a_full_test(spark, rows, tmp_path):
    kept = DayCounts(spark, str(tmp_path / "kept"), ["k"], ["v"])
    parent = rows("p string", ("a",), ("b",))
    days = {
        "01": [("a", 1), ("b", None), (None, 2)],
        "02": [("a", 3), ("z", 4)],
        "03": [("c", None)],
    }
    declared = {"unique": ["k"], "relationships": {"k": ("parent", "p")}, "not_null": ["v"]}

    def full():
        whole = [("", k, v, "2020", "01", d) for d, some in days.items() for k, v in some]
        table = spark.createDataFrame(whole, DAY)
        wanted = checks.data_test_report({"t": table, "parent": parent}, {"t": declared})
        return sorted(tuple(r) for r in wanted.collect())

    def report(staged=None):
        found = kept.report("t", declared, {"parent": parent}, staged)
        return sorted(tuple(r) for r in found.select("table", "column", "test", "failures").collect())

    assert report() == [(*r[:3], 0) for r in full()]
    for name, some in days.items():
        kept.keep(kept.stage(_day(spark, name, *some), str(tmp_path / f"stage-{name}")))
    assert report() == full()
    days["02"] = [("b", None)]
    staged = kept.stage(_day(spark, "02", *days["02"]), str(tmp_path / "again"))
    before = report()
    assert report(staged) == full() != before
    kept.keep(staged)
    assert report() == full()
    kept.compact(str(tmp_path / "compact"))
    assert report() == full()
    assert len(list((tmp_path / "kept/days").glob("batch=*"))) == 1


def test_daily_tests_read_only_touched_days(spark, landed, tmp_path, monkeypatch):  # noqa: F811
    """The facts of other days may even be gone: their counts are enough."""
    out = str(tmp_path / "wh")
    medallion.run_days(spark, landed, out, AS_OF)
    raw = bronze.read_bronze(spark, f"{out}/bronze")
    day = raw["fact_transactions"].filter("year = '2020'").select(*LANDING_FACT.names)
    again = dict(raw) | {"fact_transactions": day}
    dimensions.land(again, str(tmp_path / "again"))
    seen = []
    original = read_parquet

    def watched(spark, path, schema=None):
        seen.append(path)
        return original(spark, path, schema)

    monkeypatch.setattr(medallion, "read_parquet", watched)
    medallion.run_days(spark, str(tmp_path / "again"), out, AS_OF)
    # The published facts are only handed back to the caller, after the tests.
    assert [p for p in seen if p.endswith("days/fact_transactions")] == [seen[-1]]
    report = read_parquet(spark, f"{out}/reports/data_tests")
    assert report.count() == 29 and report.filter("failures > 0").isEmpty()
    # A transaction of another day comes again: found from the counts alone.
    raw = bronze.read_bronze(spark, f"{out}/bronze")
    other = raw["fact_transactions"].filter("trans_num = 't1'").select(*LANDING_FACT.names)
    moved = other.withColumn(
        "trans_date_trans_time", F.lit("2021-05-05 10:00:00").cast("timestamp_ntz")
    )
    dimensions.land(dict(raw) | {"fact_transactions": moved}, str(tmp_path / "twice"))
    with pytest.raises(DataTestFailure, match="unique fact_transactions.trans_num: 1"):
        medallion.run_days(spark, str(tmp_path / "twice"), out, AS_OF)


def test_a_named_fact_learns_of_touched_days_alone(spark, landed, tmp_path):  # noqa: F811
    out = str(tmp_path / "wh")
    raw = None
    for part in ("year(trans_date_trans_time) = 2019", "year(trans_date_trans_time) = 2020"):
        raw = raw or bronze.bronze(spark, landed, str(tmp_path / "b"))
        days = raw["fact_transactions"].filter(part).select(*LANDING_FACT.names)
        dimensions.land(dict(raw) | {"fact_transactions": days}, str(tmp_path / part[-4:]))
        medallion.run_days(spark, str(tmp_path / part[-4:]), out, AS_OF, names="daily_")
    assert sorted(r[0] for r in spark.sql("SHOW PARTITIONS daily_fact_transactions").collect()) == [
        "year=2019/month=01/day=05", "year=2020/month=12/day=31",
    ]
    assert spark.table("daily_fact_transactions").count() == 4
    assert spark.table("daily_dim_customer").count() == 2


def test_sketches_of_days_merge(spark, tmp_path):
    def day(name, low, high):
        made = spark.range(low, high).selectExpr(
            "id as k", "id % 7 as few", "cast(null as double) as none",
            "'2020' as year", "'01' as month", f"'{name}' as day",
        )
        return made

    kept = DaySketches(spark, str(tmp_path / "kept"))
    assert kept.profile().isEmpty()
    parts = [("01", 0, 5_000), ("02", 2_500, 9_000), ("03", 100_000, 130_000)]
    for name, low, high in parts:
        kept.keep(kept.stage(day(name, low, high), str(tmp_path / f"s{name}")))

    def figures(*days):
        return {r["column"]: (r["rows"], r["nulls"], r["distinct"]) for r in kept.profile(*days).collect()}

    whole = figures()
    assert whole["few"] == (41_500, 0, 7) and whole["none"] == (41_500, 41_500, 0)
    assert abs(whole["k"][2] - 39_000) <= 39_000 * ERROR_BOUND
    two = figures("2020-01-01", "2020-01-02")["k"]
    assert two[0] == 11_500 and abs(two[2] - 9_000) <= 9_000 * ERROR_BOUND
    # The third day again, now small: only its own figures change.
    kept.keep(kept.stage(day("03", 0, 10), str(tmp_path / "again")))
    assert figures("2020-01-03")["k"] == (10, 0, 10)
    kept.compact(str(tmp_path / "compact"))
    assert figures("2020-01-01", "2020-01-02")["k"] == two and figures("2020-01-03")["k"] == (10, 0, 10)


def test_gold_days_are_published_without_moving_rows(spark, landed, tmp_path, monkeypatch):  # noqa: F811
    """They are staged in folders by day; their rows were shuffled once more to publish them."""
    out, moved = str(tmp_path / "wh"), {}

    def watched(df, path, columns, *given, **options):
        moved[path.removeprefix(out)] = options.get("rebalance", True)
        return write_partitioned(df, path, columns, *given, **options)

    monkeypatch.setattr(medallion, "write_partitioned", watched)
    medallion.run_days(spark, landed, out, AS_OF)
    assert moved["/gold/days/fact_transactions"] is False
    staged = [rebalanced for path, rebalanced in moved.items() if "/gold/versions/" in path]
    assert staged == [True]
    for folder in (tmp_path / "wh/gold/days/fact_transactions").glob("year=*/month=*/day=*"):
        assert len(list(folder.glob("*.parquet"))) == 1

"""Keys, latest rows and loads that go on from what earlier calls left."""

import pytest
from pyspark.sql import functions as F

from ledgerstar.functions.keys import surrogate_key
from ledgerstar.operators.dedup import LatestRows, latest_per_key
from ledgerstar.operators.registry import KeyRegistry
from ledgerstar.schemas import schema
from ledgerstar.sources.csv import read_csv, read_csv_split
from ledgerstar.sources import tables as sources_tables
from ledgerstar.sources.tables import save_bucketed
from ledgerstar.streaming.load import load_new_rows

PEOPLE = "card bigint, street string"


def test_keys_stay_when_attributes_change(spark, rows, tmp_path):
    registry = KeyRegistry(spark, str(tmp_path / "r"), {"card": "bigint"}, "id")
    key = surrogate_key("card", "street")
    first = rows(PEOPLE, (1, "a"), (2, "b"), (2, "c"), (None, "n"))
    assert registry.read().isEmpty()
    assert registry.register(first, key) == 3
    assert registry.register(first, key) == 0  # again changes nothing
    ids = {r.card: r.id for r in registry.read().collect()}
    second = rows(PEOPLE, (1, "moved"), (3, "d"), (None, "other"))
    assert registry.register(second, key) == 1
    found = {r.card: r.id for r in registry.attach(second).collect()}
    assert found[1] == ids[1] and found[None] == ids[None] and found[3] not in ids.values()
    assert len({r.id for r in registry.read().collect()}) == 4
    unknown = registry.attach(rows(PEOPLE, (9, "x")))
    assert unknown.first().id is None and unknown.columns == ["card", "street", "id"]


def test_attach_replaces_an_older_id_column(spark, rows, tmp_path):
    registry = KeyRegistry(spark, str(tmp_path / "r"), {"card": "bigint"}, "id")
    people = rows("card bigint, id string", (1, "old"))
    registry.register(people, F.lit("new"))
    assert [tuple(r) for r in registry.attach(people).collect()] == [(1, "new")]


def test_latest_rows_by_batches(spark, rows, tmp_path):
    ddl = "k int, t int, v string"
    values = [(k, t, v) for k in (1, 2, None) for t in (5, 9, 7, None) for v in ("b", "a")]
    state = LatestRows(spark, str(tmp_path / "s"), ["k"], "t")
    for at in range(0, len(values), 5):
        state.update(rows(ddl, *values[at : at + 5]))
    wanted = latest_per_key(rows(ddl, *values), ["k"], "t")
    assert sorted(map(tuple, state.read().collect()), key=str) == sorted(
        map(tuple, wanted.collect()), key=str
    )
    before = state.read().collect()
    state.update(rows(ddl, *values[:7]))  # a batch that comes again
    assert sorted(state.read().collect(), key=str) == sorted(before, key=str)
    assert len(state.snapshots.versions()) == 2
    state.update(rows(ddl, *values).limit(0))
    assert state.read().count() == 3


CUSTOMER = schema({"id": "int", "name": "string", "balance": "double"})


def test_bad_csv_rows_with_their_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,balance\n1,"x, y",2.5\n2,z\n3,w,n/a\n,,\n')
    (tmp_path / "b.csv").write_text("id,name,balance\n4,v,1.0,more\n5,u,7\n")
    good, bad = read_csv_split(spark, str(tmp_path), CUSTOMER)
    assert sorted((r.id, r.name, r.balance) for r in good.collect() if r.id) == [
        (1, "x, y", 2.5), (5, "u", 7.0),
    ]
    assert good.count() == 3 and good.select("name").count() == 3
    found = sorted((r.line, r.file.rsplit("/", 1)[1]) for r in bad.collect())
    assert found == [("2,z", "a.csv"), ("3,w,n/a", "a.csv"), ("4,v,1.0,more", "b.csv")]
    assert bad.count() == 3
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        read_csv(spark, str(tmp_path), CUSTOMER).collect()
    (tmp_path / "c.csv").write_text("id,other,balance\n")
    with pytest.raises(Exception, match="header"):
        read_csv_split(spark, str(tmp_path), CUSTOMER)[0].collect()


def test_overlapping_drops_arrive_once(spark, rows, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def drop(*values):
        made = rows("k int, d int, v string", *values)
        dated = made.withColumn("at", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(d)"))
        dated = dated.select("k", "at", "v")
        dated.write.mode("append").parquet(source)
        load_new_rows(spark, source, dated.schema, target, progress, ["k"], "at", "10 days")

    drop((1, 0, "a"), (2, 1, "b"), (2, 1, "b"))
    drop((2, 1, "b"), (3, 2, "c"))
    drop()
    found = sorted((r.k, r.v) for r in spark.read.parquet(target).collect())
    assert found == [(1, "a"), (2, "b"), (3, "c")]


def test_buckets_join_without_moving(spark, tmp_path, capsys):
    sides = [
        save_bucketed(
            spark.range(100).selectExpr("id % 10 as k", f"id as v{n}"),
            f"bucketed_{n}", str(tmp_path / str(n)), ["k"], 4,
        )
        for n in range(2)
    ]
    joined = sides[0].join(sides[1].hint("merge"), "k")
    joined.explain()
    assert "Exchange" not in capsys.readouterr().out
    assert joined.count() == 1000
    for n in range(2):
        spark.sql(f"DROP TABLE bucketed_{n}")


def test_days_are_pruned_by_a_join(spark, capsys):
    import __spark_entry__ as spark_entry

    found = spark_entry.queries()["pruned_by_join"](spark, "/root/testdata/sf0.001")
    capsys.readouterr()
    found.explain()
    assert "dynamicpruning" in capsys.readouterr().out


def test_star_join_runs_no_job_while_it_is_built(spark):
    from ledgerstar.catalogue import star_join

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    star_join(spark, "/root/testdata/sf0.001")
    jobs = tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 6  # the schemas of five files, one of them named twice


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    """Eight buckets at any size let the memory of a task grow with the table."""
    monkeypatch.setattr(sources_tables, "BUCKET_ROWS", 100)
    few, many = spark.range(10), spark.range(2_050)
    assert sources_tables.bucket_count(few) == 8
    assert sources_tables.bucket_count(few, many) == 21

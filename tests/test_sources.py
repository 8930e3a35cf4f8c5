"""Readers, writers, tables and incremental loads."""

import datetime
import os
import time
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from ledgerstar.schemas import DAY_PARTITIONS, schema, text_schema
from ledgerstar.session import (
    broadcast_threshold,
    in_parallel,
    materialize,
    scratch,
    scratch_path,
    shared_folder,
)
from ledgerstar.sources import csv as csv_module
from ledgerstar.sources.csv import read_csv, write_csv
from ledgerstar.sources.parquet import read_parquet, write_partitioned
from ledgerstar.sources.tables import (
    Sources,
    as_view,
    copy_into,
    empty_table_like,
    save_table,
    table_from_parquet,
)
from ledgerstar.streaming.load import load_new_files


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_keeps_quotes_commas_spaces_and_nulls(spark, rows, tmp_path):
    data = [('say "hi", x', " padded "), ("x", None), (None, "back\\slash"), ("a,b", '"')]
    write_csv(rows("a string, b string", *data), str(tmp_path / "t"))
    found = read_csv(spark, str(tmp_path / "t"), text_schema(["a", "b"]))
    assert values(found) == sorted(data, key=repr)


def test_csv_empty_text_reads_as_null(spark, rows, tmp_path):
    write_csv(rows("a int, b string", (1, ""), (2, None)), str(tmp_path / "t"))
    found = read_csv(spark, str(tmp_path / "t"), schema({"a": "int", "b": "string"}))
    assert values(found) == [(1, None), (2, None)]


def test_csv_doubled_quote_in_a_foreign_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n"say ""hi"", x",01257\n,2\n')
    found = read_csv(spark, str(tmp_path / "t.csv"), schema({"a": "string", "b": "int"}))
    assert values(found) == [('say "hi", x', 1257), (None, 2)]


def test_csv_line_breaks_in_text_need_an_option_and_never_shift_fields(spark, rows, tmp_path):
    data = [(1, "two\nlines"), (2, "one")]
    write_csv(rows("a int, b string", *data), str(tmp_path / "t"))
    typed = schema({"a": "int", "b": "string"})
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv(spark, str(tmp_path / "t"), typed).collect()
    assert values(read_csv(spark, str(tmp_path / "t"), typed, multiLine=True)) == data


def test_csv_times_survive(spark, rows, tmp_path):
    times = [datetime.datetime(2019, 1, 5, 23, 59, 59, 123456), datetime.datetime(2019, 3, 31, 2, 30)]
    write_csv(rows("t timestamp_ntz", *[(t,) for t in times]), str(tmp_path / "t"))
    typed = read_csv(spark, str(tmp_path / "t"), schema({"t": "timestamp"}))
    assert values(typed) == [(t,) for t in sorted(times)]


def test_csv_wrong_header_or_value_fails(spark, tmp_path):
    (tmp_path / "t.csv").write_text("b,a\n1,x\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, str(tmp_path / "t.csv"), schema({"a": "int", "b": "string"})).collect()
    (tmp_path / "u.csv").write_text("a,b\nx,1\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv(spark, str(tmp_path / "u.csv"), schema({"a": "int", "b": "string"})).collect()


def test_csv_inferred_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("zip,amt,t,d\n01257,1.5,2019-01-05 10:00:00,2019-01-05\n")
    found = read_csv(spark, str(tmp_path / "t.csv"), infer=True)
    assert dict(found.dtypes) == {"zip": "int", "amt": "double", "t": "timestamp", "d": "date"}
    assert {t for _, t in read_csv(spark, str(tmp_path / "t.csv")).dtypes} == {"string"}


@pytest.fixture
def days(rows):
    data = [(i, "2019", "01", "05") for i in range(400)]
    data += [(1000 + i, "2019", "12", f"{i % 20 + 1:02d}") for i in range(200)]
    return rows("id int, year string, month string, day string", *data)


def test_partition_folders_and_text_values(spark, days, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(days, path, DAY_PARTITIONS)
    assert (tmp_path / "t" / "year=2019" / "month=01" / "day=05").is_dir()
    assert values(read_parquet(spark, path, days.schema)) == values(days)


def test_partition_filter_reaches_the_scan(spark, days, tmp_path, capsys):
    path = str(tmp_path / "t")
    write_partitioned(days, path, DAY_PARTITIONS)
    found = read_parquet(spark, path, days.schema).filter("year = '2019' and month = '12'")
    found.explain()
    scan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(year" in scan and "month" in scan
    assert found.count() == 200


def test_one_day_is_replaced_and_the_rest_stays(spark, days, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(days, path, DAY_PARTITIONS)
    rerun = days.filter("day = '05' and month = '01'").limit(1).withColumn("id", F.lit(-1))
    write_partitioned(rerun, path, DAY_PARTITIONS, replace_touched_only=True)
    found = read_parquet(spark, path, days.schema)
    assert found.filter("month = '01'").count() == 1
    assert found.filter("month = '12'").count() == 200


def test_a_hot_day_is_split_over_files(spark, tmp_path):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "20KB")
    hot = spark.range(0, 40_000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 3 > 0, "05").otherwise("06").alias("day"),
    )
    try:
        write_partitioned(hot, str(tmp_path / "t"), ["day"])
    finally:
        spark.conf.unset(name)
    assert len(list((tmp_path / "t" / "day=05").glob("*.parquet"))) > 1
    assert read_parquet(spark, str(tmp_path / "t")).count() == 40_000


@pytest.mark.parametrize("even", [True, False])
def test_thin_days_have_one_file_each(spark, days, tmp_path, even):
    write_partitioned(days, str(tmp_path / "t"), DAY_PARTITIONS, even_folders=even)
    for folder in (tmp_path / "t").glob("year=*/month=*/day=*"):
        assert len(list(folder.glob("*.parquet"))) == 1


def test_tables(spark, rows, tmp_path):
    df = rows("id int, name string", (1, "a"), (2, "b"))
    df.write.parquet(str(tmp_path / "p"))
    assert values(table_from_parquet(spark, "tbl_over_files", str(tmp_path / "p"))) == values(df)
    empty = empty_table_like(spark, "tbl_loaded", str(tmp_path / "p"), str(tmp_path / "l"))
    assert empty.count() == 0 and empty.dtypes == df.dtypes
    copy_into(spark, "tbl_loaded", str(tmp_path / "p"))
    assert copy_into(spark, "tbl_loaded", str(tmp_path / "p")).count() == 2
    assert copy_into(spark, "tbl_loaded", str(tmp_path / "p"), mode="append").count() == 4
    with pytest.raises(ValueError):
        copy_into(spark, "tbl_loaded", str(tmp_path / "p"), mode="merge")
    saved = save_table(df, "tbl_saved", str(tmp_path / "s"))
    assert values(save_table(saved.limit(0).unionAll(df), "tbl_saved2", str(tmp_path / "s2"))) == values(df)
    as_view(df, "some_view")
    sources = Sources(spark, {"some_view": None, "files": str(tmp_path / "p")})
    assert values(sources["some_view"]) == values(sources["files"])
    assert sources.names() == ["files", "some_view"]


def test_partitioned_table_finds_its_rows(spark, days, tmp_path):
    write_partitioned(days, str(tmp_path / "t"), DAY_PARTITIONS)
    assert table_from_parquet(spark, "tbl_days", str(tmp_path / "t"), True).count() == days.count()


def test_each_file_is_loaded_once(spark, rows, tmp_path):
    drop, target, progress = (str(tmp_path / n) for n in ("drop", "target", "progress"))
    for batch in range(3):
        df = rows("id int", *[(batch * 10 + i,) for i in range(10)])
        df.write.mode("append").parquet(drop)
        for _ in range(2):
            load_new_files(spark, drop, df.schema, target, progress, files_per_batch=2)
            assert read_parquet(spark, target).count() == (batch + 1) * 10
    assert values(read_parquet(spark, target)) == sorted([(i,) for i in range(30)], key=repr)


def test_late_files_are_loaded_too(spark, rows, tmp_path):
    """Each file is older than the one before, the last by far more than a week."""
    drop, target, progress = (tmp_path / n for n in ("drop", "target", "progress"))
    for batch in range(4):
        part = tmp_path / f"part{batch}"
        rows("id int", *[(batch * 10 + i,) for i in range(10)]).coalesce(1).write.parquet(str(part))
        [file] = part.glob("*.parquet")
        drop.mkdir(exist_ok=True)
        then = time.time() - batch * 30 * 86_400
        os.utime(file, (then, then))
        file.rename(drop / file.name)
        if batch:  # the first two together, one file per batch
            schema_ = spark.read.parquet(str(drop)).schema
            load_new_files(spark, str(drop), schema_, str(target), str(progress), 1)
            assert read_parquet(spark, str(target)).count() == (batch + 1) * 10


@pytest.mark.parametrize("text", ["k,v\n1,2\n4,5,6\n", "k,v\n1,2\n4\n"])
@pytest.mark.parametrize("infer", [True, False])
def test_ragged_rows_fail_without_a_schema(spark, tmp_path, text, infer):
    (tmp_path / "t.csv").write_text(text)
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv(spark, str(tmp_path / "t.csv"), infer=infer).collect()


def test_scratch_of_a_scope_is_deleted(spark, rows):
    df = rows("id int", (1,))
    with scratch(spark):
        made = in_parallel({n: lambda: materialize(df, "gone") for n in "ab"})
        paths = [t.inputFiles()[0] for t in made.values()]
        assert all(os.path.exists(urlsplit(p).path) for p in paths)
    assert not any(os.path.exists(urlsplit(p).path) for p in paths)
    stays = materialize(df, "stays").inputFiles()[0]
    with pytest.raises(KeyError), scratch(spark):
        lost = materialize(df, "lost").inputFiles()[0]
        raise KeyError
    assert os.path.exists(urlsplit(stays).path) and not os.path.exists(urlsplit(lost).path)


def test_a_folder_set_anew_is_honoured(spark, tmp_path):
    before = shared_folder(spark)
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        assert str(tmp_path) in shared_folder(spark)
    finally:
        spark.sparkContext.setCheckpointDir(before)


def test_scratch_is_below_the_shared_folder(spark, rows):
    folder = shared_folder(spark)
    paths = {scratch_path(spark, "x") for _ in range(10)}
    assert len(paths) == 10 and all(p.startswith(folder) for p in paths)
    df = rows("id int, v string", (1, None), (2, "b"))
    assert values(materialize(df, "m")) == values(df)
    assert materialize(df.filter("id > 2"), "m").isEmpty()


def test_in_parallel_keeps_order_and_raises():
    def fail():
        raise ValueError("broken")

    assert list(in_parallel({"b": lambda: 2, "a": lambda: 1}).items()) == [("b", 2), ("a", 1)]
    done = []
    with pytest.raises(ValueError, match="broken"):
        in_parallel({"bad": fail, "good": lambda: done.append(1)})
    assert done == [1]


@pytest.mark.parametrize(
    "text, size", [("-1", -1), ("10485760b", 10 << 20), ("10MB", 10 << 20), ("1g", 1 << 30), ("5", 5)]
)
def test_broadcast_threshold(spark, text, size):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, text)
    try:
        assert broadcast_threshold(spark) == size
    finally:
        spark.conf.set(name, before)


def test_csv_files_are_packed_and_bounded(spark, tmp_path, monkeypatch):
    """Plain files took three times the space; a packed one is read by one task, so it is bounded."""
    monkeypatch.setitem(csv_module._PACKED, "maxRecordsPerFile", 300)
    data = spark.range(0, 1000, 1, 1).select("id", F.repeat(F.lit("same text, "), 20).alias("text"))
    write_csv(data, str(tmp_path / "packed"))
    write_csv(data, str(tmp_path / "plain"), packed=False)
    packed = list((tmp_path / "packed").glob("part-*.csv.gz"))
    plain = list((tmp_path / "plain").glob("part-*.csv"))
    assert len(packed) == 4 and len(plain) == 1
    assert 3 * sum(f.stat().st_size for f in packed) < plain[0].stat().st_size
    for name in ("packed", "plain"):
        found = read_csv(spark, str(tmp_path / name), data.schema)
        assert sorted(found.collect()) == sorted(data.collect())

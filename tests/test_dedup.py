"""Concatenation, duplicates, latest rows, counts and profiles."""

import random
from contextlib import nullcontext

import pytest
from pyspark.sql import functions as F
from test_joins import no_broadcast

from ledgerstar.operators.columns import drop_at
from ledgerstar.operators.dedup import concat, latest_per_key, sort_rows
from ledgerstar.operators.profile import (
    distinct_count,
    null_profile,
    profile,
    row_counts,
    schema_report,
)


def values(df):
    return [tuple(r) for r in df.collect()]


def test_duplicate_row_across_files_is_kept_once(rows):
    one = rows("i int, a int, b string", (0, 1, "x"), (1, 2, None))
    two = rows("i int, b string, a int", (7, "x", 1), (8, None, 2), (9, "y", 1))
    found = drop_at(concat(one, two), 0).dropDuplicates()
    assert sorted(values(found), key=repr) == [(1, "x"), (1, "y"), (2, None)]


def test_concat_fills_missing_columns(rows):
    found = concat(rows("a int, b int", (1, 2)), rows("b int", (3,)))
    assert sorted(values(found), key=repr) == [(1, 2), (None, 3)]


def test_latest_with_tie_takes_the_lowest(rows):
    df = rows("k string, ts int, v int", ("a", 5, 3), ("a", 5, 1), ("a", 4, 0), (None, 1, 2), (None, None, 1))
    assert sorted(values(latest_per_key(df, ["k"], "ts")), key=repr) == [("a", 5, 1), (None, 1, 2)]


def test_latest_is_the_same_for_every_layout(spark, rows):
    rng = random.Random(3)
    data = [(rng.choice("abc"), rng.randrange(4), rng.randrange(1000)) for _ in range(400)]
    df = rows("k string, ts int, v int", *data)
    wanted = sorted(
        max((r for r in data if r[0] == k), key=lambda r: (r[1], -r[2])) for k in "abc"
    )
    for parts in (1, 3, 11):
        assert sorted(values(latest_per_key(df.repartition(parts), ["k"], "ts"))) == wanted


@pytest.mark.parametrize("broadcast", [True, False])
def test_latest_of_few_keys(spark, broadcast, capsys):
    """As the plain way, with null keys, null and repeated times, -0.0 and NaN."""
    rng = random.Random(5)
    times = [None, -0.0, 0.0, 1.0, 2.0, float("nan")]
    data = [(rng.choice(["a", "b", None]), rng.choice(times), i) for i in range(500)]
    data += [("no time", None, 3), ("no time", None, 2), ("low", -0.0, 9), ("low", 0.0, 8)]
    df = spark.createDataFrame(data, "k string, ts double, v int").repartition(5)
    plain = latest_per_key(df, ["k"], "ts", ["v"])
    with nullcontext() if broadcast else no_broadcast(spark):
        found = latest_per_key(df, ["k"], "ts", ["v"], few_keys=True)
        assert sorted(map(repr, values(found))) == sorted(map(repr, values(plain)))
        assert found.filter("k = 'no time'").first().v == 2
        assert found.filter("k = 'low'").first().v == 8
        found.explain()
    text = capsys.readouterr().out
    assert "LeftSemi" in text and ("BroadcastHashJoin" in text) == broadcast


def test_latest_text_of_few_keys(rows):
    df = rows("k int, ts string, v int", (1, "a", 1), (1, "b", 2), (2, None, 3))
    found = latest_per_key(df, ["k"], "ts", few_keys=True)
    assert sorted(values(found)) == [(1, "b", 2), (2, None, 3)]


def test_latest_prunes_before_the_shuffle(rows, capsys):
    latest_per_key(rows("k int, ts int", (1, 1)), ["k"], "ts").explain()
    text = capsys.readouterr().out
    assert "WindowGroupLimit" in text and "Partial" in text


def test_sort_puts_missing_last(rows):
    df = rows("m string, ts int", ("a", None), (None, 1), ("a", 1), ("a", 2), ("b", 3))
    found = values(sort_rows(df, ["m"], ["ts"]))
    assert found == [("a", 2), ("a", 1), ("a", None), ("b", 3), (None, 1)]


def test_ties_are_sorted_over_several_tasks(spark):
    tied = spark.range(0, 20_000, 1, 4).select(F.lit("same").alias("m"), "id")
    found = sort_rows(tied, ["m"])
    assert [r.id for r in found.collect()] == list(range(20_000))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    tasks = sort_rows(tied, ["m"]).select(F.spark_partition_id()).distinct().count()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 1


def test_counts(rows):
    df = rows("a int, b string", (1, "x"), (1, "x"), (1, None), (None, None))
    assert values(row_counts(df)) == [(4, 3, 1)]
    assert values(distinct_count(df, ["a"])) == [(2,)]
    assert values(null_profile(df)) == [(1, 2)]


def test_counts_of_an_empty_table(rows):
    df = rows("a int", (1,)).filter("a > 1")
    assert values(row_counts(df)) == [(0, 0, 0)]
    assert values(null_profile(df)) == [(0,)]
    assert values(profile(df)) == [(0, "a", "int", 0, 0, 0)]


def test_profile_exact_and_approximate_agree_on_little_data(rows):
    df = rows("a int, b string", (1, "x"), (1, "x"), (2, None), (None, None))
    wanted = [(0, "a", "int", 4, 1, 2), (1, "b", "string", 4, 2, 1)]
    assert sorted(values(profile(df))) == wanted
    assert sorted(values(profile(df, approximate=True))) == wanted
    counted = schema_report(df, count_nulls=True)
    assert values(counted) == [(0, "a", "int", 1), (1, "b", "string", 2)]
    assert values(schema_report(df)) == [(0, "a", "int"), (1, "b", "string")]


def test_profile_does_not_multiply_rows(spark, capsys):
    profile(spark.range(10).select("id", (F.col("id") % 3).alias("b"))).explain()
    assert "Expand" not in capsys.readouterr().out

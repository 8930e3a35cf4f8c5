"""Joins: the broadcast and the salted way give the same, whole result."""

import random
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ledgerstar import catalogue
from ledgerstar.operators.joins import (
    Dimension,
    attach_key,
    hot_keys,
    join_dimensions,
    orphan_keys,
    orphan_report,
    orphan_rows,
    star_join,
)


@contextmanager
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture
def skewed(rows):
    """A third of the rows on key 'hot', a third without key, the rest spread; some unmatched."""
    rng = random.Random(1)
    keys = ["hot"] * 300 + [None] * 300 + [f"k{rng.randrange(60)}" for _ in range(300)]
    return rows("id long, key string", *enumerate(keys))


@pytest.fixture
def dim(rows):
    """Keys k0 to k49; 'hot' and the null key twice."""
    entries = [(f"k{i}", i) for i in range(50)]
    return rows("dkey string, value long", *entries, ("hot", 100), ("hot", 101), (None, 7), (None, 8))


def expected(skewed, dim, how, null_safe):
    lookup = {}
    for r in dim.collect():
        if r.dkey is not None or null_safe:
            lookup.setdefault(r.dkey, []).append(r.value)
    found = []
    for r in skewed.collect():
        matches = lookup.get(r.key, [])
        if how == "left_semi" and matches or how == "left_anti" and not matches:
            found.append((r.id, r.key))
        elif how in ("inner", "left"):
            found += [(r.id, r.key, v) for v in matches or ([None] if how == "left" else [])]
    return sorted(found, key=repr)


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_gives_the_same_rows(spark, skewed, dim, how, null_safe):
    columns = ["value"] if how in ("inner", "left") else []
    dims = [Dimension(dim, {"key": "dkey"}, columns)]
    with no_broadcast(spark):
        joined = join_dimensions(skewed, dims, how, null_safe)
        assert "_salt" in plan(joined)
        salted = sorted(map(tuple, joined.collect()), key=repr)
    assert salted == expected(skewed, dim, how, null_safe)


def test_small_dimension_is_broadcast_without_salt(spark, skewed, dim, tmp_path):
    dim.write.parquet(str(tmp_path / "dim"))
    small = spark.read.parquet(str(tmp_path / "dim"))
    joined = join_dimensions(skewed, [Dimension(small, {"key": "dkey"}, ["value"])], "inner")
    text = plan(joined)
    assert "BroadcastHashJoin" in text and "_salt" not in text and "SortMergeJoin" not in text
    assert sorted(map(tuple, joined.collect()), key=repr) == expected(skewed, dim, "inner", False)


def test_hot_keys_finds_the_hot_ones_only(skewed):
    [found] = hot_keys(skewed, [["key"]])
    hashes = skewed.select("key", F.xxhash64("key").alias("h")).distinct().collect()
    assert {r.key for r in hashes if r.h in found.hashes} == {"hot", None}
    assert 2 <= found.pieces <= 8


def test_hot_keys_of_an_empty_table(skewed):
    [found] = hot_keys(skewed.filter("id < 0"), [["key"]])
    assert found.hashes == ()


def test_a_hot_key_is_spread_over_tasks(spark, skewed, dim):
    with no_broadcast(spark):
        dims = [Dimension(dim, {"key": "dkey"}, ["value"])]
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = join_dimensions(skewed, dims, "left", null_safe=True)
        hot = joined.filter("key = 'hot'").select(F.spark_partition_id().alias("task"))
        tasks = hot.distinct().count()
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 1


def test_negative_zero_is_the_same_hot_key(spark, rows):
    fact = rows("id int, k double", *[(i, -0.0) for i in range(60)], *[(60 + i, 0.0) for i in range(30)])
    dim = rows("p double, v int", (0.0, 1), (5.0, 2))
    with no_broadcast(spark):
        joined = star_join(fact, [Dimension(dim, {"k": "p"}, ["v"])])
        assert "_salt" in plan(joined) and joined.count() == 90


def test_composite_keys(spark, rows):
    fact = rows("id int, a int, b string", *[(i, 1, "x") for i in range(50)], (50, 2, "x"), (51, 1, "y"))
    dim = rows("p int, q string, v int", (1, "x", 10), (2, "x", 20))
    with no_broadcast(spark):
        joined = star_join(fact, [Dimension(dim, {"a": "p", "b": "q"}, ["v"])])
        assert sorted(r.v for r in joined.collect()) == [10] * 50 + [20]


def test_star_join_keeps_column_order_and_drops_unmatched(rows):
    fact = rows("id int, a int, b int", (1, 1, 1), (2, None, 1), (3, 9, 1))
    one = rows("a int, x string", (1, "x1"))
    two = rows("k int, y string", (1, "y1"))
    joined = star_join(fact, [Dimension(two, {"b": "k"}, ["y"]), Dimension(one, {"a": "a"}, ["x"])])
    assert joined.columns == ["id", "a", "b", "y", "x"]
    assert [tuple(r) for r in joined.collect()] == [(1, 1, 1, "y1", "x1")]


def test_key_types_must_agree(rows):
    fact, dim = rows("k long", (1,)), rows("k string, v int", ("1", 1))
    with pytest.raises(TypeError, match="cast one side"):
        star_join(fact, [Dimension(dim, {"k": "k"}, ["v"])])


def test_null_merge_key_matches_null(rows):
    fact = rows("t int, merchant string", (1, None), (2, "a"), (3, "b"))
    dim = rows("merchant string, key string", (None, "n"), ("a", "k"))
    found = attach_key(fact, dim, {"merchant": "merchant"}, "key")
    assert sorted(map(tuple, found.collect())) == [(1, None, "n"), (2, "a", "k"), (3, "b", None)]


def test_child_rows_are_counted_before_a_large_join(spark, skewed, dim):
    with no_broadcast(spark):
        text = plan(orphan_keys(skewed, "key", dim, "dkey"))
    assert text.index("SortMergeJoin") < text.index("HashAggregate")
    assert "BroadcastHashJoin" not in text


def test_orphans(rows):
    child = rows("id int, k int", (1, 1), (2, 2), (3, 2), (4, None))
    parent = rows("p int", (1,), (1,), (5,))
    assert sorted(r.id for r in orphan_rows(child, "k", parent, "p").collect()) == [2, 3]
    assert [tuple(r) for r in orphan_keys(child, "k", parent, "p").collect()] == [(2, 2)]
    report = orphan_report(child, {"d": Dimension(parent, {"k": "p"})})
    assert [tuple(r) for r in report.collect()] == [("d", 1, 2)]


def test_a_derived_dimension_is_sized_by_itself(spark, skewed, tmp_path):
    """A wide parent is too large by its estimate, its few rows are not."""
    wide = spark.range(20_000).select(
        F.concat(F.lit("k"), "id").alias("dkey"), F.repeat(F.lit("x"), 200).alias("value")
    )
    wide.write.parquet(str(tmp_path / "wide"))
    few = spark.read.parquet(str(tmp_path / "wide")).filter("dkey = 'k1'")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")
    try:
        for derived in (False, True):
            joined = attach_key(skewed, few, {"key": "dkey"}, "value", derived=derived)
            assert ("_salt" in plan(joined)) != derived
            assert joined.count() == 900
            assert joined.filter("value is not null").count() == skewed.filter("key = 'k1'").count()
    finally:
        spark.conf.set(name, before)


def test_a_large_dimension_shuffles_salted(skewed, dim):
    joined = star_join(skewed, [Dimension(dim, {"key": "dkey"}, ["value"], large=True)], ["id"])
    text = plan(joined)
    assert "SortMergeJoin" in text and "_salt" in text
    found = sorted(map(tuple, joined.collect()), key=repr)
    assert found == expected(skewed, dim, "inner", False)


def test_a_dimension_far_smaller_than_the_fact_is_copied(spark, tmp_path):
    """Beyond a low threshold the fact was shuffled for a dimension of a hundredth its bytes."""
    spark.range(400_000).select("id", (F.col("id") % 500).alias("key")).write.parquet(
        str(tmp_path / "fact")
    )
    spark.range(500).select(F.col("id").alias("dkey"), "id").write.parquet(str(tmp_path / "dim"))
    fact, small = (spark.read.parquet(str(tmp_path / n)) for n in ("fact", "dim"))
    dims = [Dimension(small.withColumnRenamed("id", "value"), {"key": "dkey"}, ["value"])]
    near = fact.filter("id < 5").select("id", "key").coalesce(1)
    near.write.parquet(str(tmp_path / "near"))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "100")
    try:
        joined = star_join(fact, dims)
        assert "SortMergeJoin" not in plan(joined) and joined.count() == 400_000
        few = star_join(spark.read.parquet(str(tmp_path / "near")), dims)
        assert "SortMergeJoin" in plan(few) and few.count() == 5
    finally:
        spark.conf.set(name, before)
    with no_broadcast(spark):
        assert "SortMergeJoin" in plan(star_join(fact, dims))


def test_star_join_moves_no_lines_for_customers(spark):
    with no_broadcast(spark):
        text = plan(catalogue.star_join(spark, SMALL))
    moves = re.findall(r"Exchange\nInput \[\d+\]: (.*)\nArguments: hashpartitioning\((\w+)", text)
    by_customer = [columns for columns, key in moves if key == "o_custkey"]
    assert by_customer and not any("l_quantity" in columns for columns in by_customer)


def test_transactions_move_no_orders_for_suppliers(spark):
    with no_broadcast(spark):
        text = plan(catalogue.transactions(spark, SMALL))
    moves = re.findall(r"Exchange\nInput \[\d+\]: (.*)\nArguments: hashpartitioning\((\w+)", text)
    by_supplier = [columns for columns, key in moves if key == "suppkey"]
    assert by_supplier and not any("o_totalprice" in columns for columns in by_supplier)

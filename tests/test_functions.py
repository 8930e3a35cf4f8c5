"""Column expressions on hand-made edge rows."""

import datetime

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from ledgerstar.functions.cards import CARD_TIERS, PROVIDERS, enrich_cards, tier
from ledgerstar.functions.dates import add_years, day_parts, year_diff
from ledgerstar.functions.flags import is_top_card, is_top_card_by_limit
from ledgerstar.functions.keys import in_range, surrogate_key
from ledgerstar.functions.text import clean_token
from ledgerstar.operators.columns import cast_columns, preview, rename, split_casts, spread, to_int

D = datetime.date


def values(df):
    return [tuple(r) for r in df.collect()]


def test_repeated_token(rows):
    df = rows("m string", ("fraud_a_fraud_b",), ("plain",), (None,))
    assert values(df.select(clean_token("m"))) == [(" a_ b",), ("plain",), (None,)]
    anchored = df.select(clean_token("m", anchored=True))
    assert values(anchored) == [("a_fraud_b",), ("plain",), (None,)]


def test_null_category_is_not_top(rows):
    df = rows("card_category string, credit_limit int", ("Infinite", 9999), ("Gold", 10000), (None, None))
    assert values(df.select(is_top_card())) == [(True,), (False,), (False,)]
    assert values(df.select(is_top_card_by_limit())) == [(False,), (True,), (False,)]


def test_year_difference_counts_boundaries(rows):
    df = rows("dob date", (D(2000, 12, 31),), (D(2000, 1, 1),), (None,))
    assert values(df.select(year_diff("dob", "2001-01-01"))) == [(1,), (1,), (None,)]


def test_add_years_ignores_leap_days(rows):
    df = rows("d date", (D(2020, 1, 1),))
    assert values(df.select(add_years("d", 3))) == [(D(2022, 12, 31),)]


def test_day_parts_of_text_date_and_timestamp(rows):
    df = rows("s string", ("2019-01-05 23:59:59",))
    for source in (F.col("s"), F.col("s").cast("date"), F.col("s").cast("timestamp_ntz")):
        assert values(df.select(*day_parts(source).values())) == [("2019", "01", "05")]


def test_leading_zero_and_spaces_cast(rows):
    df = rows("zip string", ("01257",), (" 12 ",))
    assert values(cast_columns(df, {"zip": "int"})) == [(1257,), (12,)]


@pytest.mark.parametrize("bad", ["12x", "12.0"])
def test_strict_cast_fails(rows, bad):
    with pytest.raises(NumberFormatException):
        cast_columns(rows("zip string", (bad,)), {"zip": "int"}).collect()


def test_quarantine_holds_only_malformed_values(rows):
    df = rows("id int, zip string", (1, "12x"), (2, "12.0"), (3, None), (4, "7"))
    good, bad = split_casts(df, {"zip": "int"})
    assert sorted(values(good)) == [(3, None), (4, 7)]
    assert sorted(values(bad)) == [(1, "12x"), (2, "12.0")]


def test_int_written_as_float(rows):
    df = rows("z string", ("1257.0",), ("12.5",), ("x",), (None,), ("9999999999",))
    assert values(df.select(to_int("z"))) == [(1257,), (None,), (None,), (None,), (None,)]


def test_surrogate_key_form_and_ambiguity(rows):
    df = rows("a string, b string", ("ab", "c"), ("a", "bc"), ("abc", None), ("abc", ""), (None, "abc"))
    keys = [r[0] for r in df.select(surrogate_key("a", "b")).collect()]
    assert len(set(keys)) == 5
    assert all([len(part) for part in key.split("-")] == [8, 4, 4, 4, 12] for key in keys)


def test_surrogate_key_does_not_depend_on_layout(spark):
    ids = spark.range(1000)
    one = ids.select("id", surrogate_key("id").alias("k")).collect()
    other = ids.repartition(7).select("id", surrogate_key("id").alias("k")).collect()
    assert sorted(one) == sorted(other)


def test_cards_stay_in_their_ranges(spark):
    cards = enrich_cards(spark.range(3000).select(F.col("id").alias("cc_num")), as_of="2026-01-01")
    found = cards.collect()
    for r in found:
        low, high, step = CARD_TIERS[r.card_category]
        assert low <= r.credit_limit <= high and (r.credit_limit - low) % step == 0
        assert (r.expiration_date - r.issue_date).days in (3 * 365, 4 * 365, 5 * 365)
        assert D(2026, 1, 1) - datetime.timedelta(5 * 365) <= r.issue_date <= D(2026, 1, 1)
    assert {r.card_category for r in found} == set(CARD_TIERS)
    assert {r.card_provider for r in found} == set(PROVIDERS)
    basic = {r.credit_limit for r in found if r.card_category == "Basic"}
    assert basic == set(range(1000, 5001, 500))


def test_cards_follow_the_seed(spark):
    cards = spark.range(50).select(F.col("id").alias("cc_num"))
    first, again, other = (
        enrich_cards(cards, as_of="2026-01-01", seed=seed).collect() for seed in ("a", "a", "b")
    )
    assert first == again != other


def test_no_python_in_card_plan(spark, capsys):
    enrich_cards(spark.range(5).select(F.col("id").alias("cc_num"))).explain()
    assert "Python" not in capsys.readouterr().out


def test_unknown_tier_is_null(rows):
    df = rows("c string", ("Basic",), ("Tin",), (None,))
    found = values(spread(df, tier("c")))
    assert found == [("Basic", 1000, 5000, 500), ("Tin", None, None, None), (None, None, None, None)]


def test_in_range_reaches_both_ends(spark):
    found = spark.range(200).select(in_range("id", "n", 3, 5).alias("n")).distinct().collect()
    assert sorted(r.n for r in found) == [3, 4, 5]


def test_rename_and_preview(rows):
    df = rows("a int, b int, c int", (2, 1, 0), (1, 1, 0), (3, 1, 0))
    assert rename(df, {"b": "x", "a": "y"}).columns == ["x", "y"]
    assert values(preview(df, "a", 2)) == [(1, 1, 0), (2, 1, 0)]

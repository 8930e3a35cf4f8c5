"""Operators against plain Python on random, skewed tables with nulls and repeats."""

import random
from collections import Counter

import pytest
from test_joins import no_broadcast

from ledgerstar.operators.checks import repeated_keys
from ledgerstar.operators.dedup import latest_per_key
from ledgerstar.operators.joins import Dimension, attach_key, orphan_keys, orphan_report, star_join
from ledgerstar.operators.profile import distinct_count, null_profile, profile, row_counts


def table(rng, size):
    """(id, key, ts): a third of the rows on one key, some without key or time, some repeated."""
    found = []
    for i in range(size):
        key = rng.choice(["hot", rng.choice("abcdefgh"), None if rng.random() < 0.2 else "z"])
        found.append((i // 2 if rng.random() < 0.3 else i, key, rng.choice([None, 1, 2, 3])))
    return found


@pytest.mark.parametrize("seed", range(3))
def test_counts_and_duplicates(rows, seed):
    data = table(random.Random(seed), 300)
    df = rows("id long, key string, ts int", *data)
    assert tuple(row_counts(df).first()) == (300, len(set(data)), 300 - len(set(data)))
    assert distinct_count(df, ["key", "ts"]).first()[0] == len({r[1:] for r in data})
    columns = list(zip(*data))
    nulls = [sum(v is None for v in c) for c in columns]
    assert list(null_profile(df).first()) == nulls
    assert sorted((r.position, r.rows, r.nulls, r.distinct) for r in profile(df).collect()) == [
        (i, 300, nulls[i], len(set(c) - {None})) for i, c in enumerate(columns)
    ]
    counts = Counter(r[:2] for r in data if r[1] is not None)
    assert Counter({r[:2]: r[2] for r in map(tuple, repeated_keys(df, ["id", "key"]).collect())}) == {
        k: n for k, n in counts.items() if n > 1
    }
    assert set(map(tuple, df.dropDuplicates().collect())) == set(data)


@pytest.mark.parametrize("seed", range(3))
def test_latest(rows, seed):
    data = table(random.Random(seed), 300)
    wanted = {}
    for row in data:
        order = (-(row[2] or 0) if row[2] is not None else 1, row[0])
        if row[1] not in wanted or order < wanted[row[1]][0]:
            wanted[row[1]] = (order, row)
    df = rows("id long, key string, ts int", *data)
    found = map(tuple, latest_per_key(df, ["key"], "ts", ["id"]).collect())
    assert sorted(found, key=repr) == sorted((row for _, row in wanted.values()), key=repr)


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("seed", range(2))
def test_joins(spark, rows, seed, broadcast):
    rng = random.Random(seed)
    data = table(rng, 300)
    parents = [(rng.choice(["hot", "a", "b", "c", "q", None]), i) for i in range(9)]
    fact, dim = rows("id long, key string, ts int", *data), rows("p string, v long", *parents)
    inner = Counter((*r, v) for r in data for p, v in parents if p is not None and p == r[1])
    left = Counter()
    for r in data:
        matches = [v for p, v in parents if p == r[1]] or [None]
        left.update((*r, v) for v in matches)
    known = {p for p, _ in parents}
    lost = Counter(r[1] for r in data if r[1] is not None and r[1] not in known)

    def check():
        star = star_join(fact, [Dimension(dim, {"key": "p"}, ["v"])])
        assert Counter(map(tuple, star.collect())) == inner
        assert Counter(map(tuple, attach_key(fact, dim, {"key": "p"}, "v").collect())) == left
        assert dict(map(tuple, orphan_keys(fact, "key", dim, "p").collect())) == dict(lost)
        report = orphan_report(fact, {"d": Dimension(dim, {"key": "p"})}).first()
        no_key = sum(r[1] is None for r in data)
        assert tuple(report) == ("d", no_key, sum(lost.values()))

    if broadcast:
        check()
    else:
        with no_broadcast(spark):
            check()

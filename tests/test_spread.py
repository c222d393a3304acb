"""Joins, top-k and numbering under skew, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from pagequarry.operators import spread as sp


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has one key; some keys have no partner."""
    rng = random.Random(7)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(40)}") for i in range(3000)]
    small = [(f"k{i}", i * 10 + j) for i in range(30) for j in range(1 + i % 2)] + [("hot", -1), ("hot", -2)]
    return (
        spark.createDataFrame(rows, "id long, k string"),
        spark.createDataFrame(small, "k string, v long"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(skewed, how):
    big, small = skewed
    expected = sorted(map(tuple, big.join(small, "k", how).collect()), key=repr)
    for size in (0, 10**12):  # broadcast, then salted
        got = sp.spread_join(big, small, ["k"], how, small_bytes=size)
        assert sorted(map(tuple, got.select(*big.join(small, "k", how).columns).collect()), key=repr) == expected


def test_hot_keys_are_bounded_and_split(skewed):
    big, small = skewed
    assert sp.hot_keys(big, ["k"], 0.2).collect() == [("hot", 2)]
    assert sp.hot_keys(big, ["k"], 0.05).where("k = 'hot'").first()["_salts"] == 7
    salted = sp.spread_join(big, small, ["k"], small_bytes=10**12)
    plan = salted._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_measured_size_decides(skewed):
    big, small = skewed
    assert 500 < sp.measure(small) < 10_000
    wide = sp.spread_join(big, small, ["k"], limit=100)
    assert "_salt" in wide._jdf.queryExecution().analyzed().toString()
    narrow = sp.spread_join(big, small, ["k"])
    assert "_salt" not in narrow._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("k", [1, 5, 2000])
def test_top_k(spark, k):
    rng = random.Random(3)
    rows = [("q1" if i % 3 else "q2", i, rng.randrange(50)) for i in range(4000)]
    df = spark.createDataFrame(rows, "q string, id long, score long")
    got = sp.top_k(df, ["q"], [F.desc("score"), F.asc("id")], k, ["id"], total="n").collect()
    for q in ("q1", "q2"):
        mine = sorted((r for r in rows if r[0] == q), key=lambda r: (-r[2], r[1]))
        expected = [(r[1], i + 1, len(mine)) for i, r in enumerate(mine[:k])]
        assert sorted(((r.id, r.rank_no, r.n) for r in got if r.q == q), key=lambda r: r[1]) == expected


def test_dense_ids(spark, ws):
    names = [f"u{i * 7919 % 1009:04d}" for i in range(1009)]
    df = spark.createDataFrame([(n,) for n in names], "url string").repartition(13)
    got = {r.url: r.idx for r in sp.dense_ids(df, ["url"], ws).collect()}
    assert got == {n: i for i, n in enumerate(sorted(names))}
    assert sp.dense_ids(df.where("false"), ["url"], ws, "none").count() == 0

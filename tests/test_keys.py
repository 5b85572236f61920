"""Surrogate keys and one row per key."""

import random

import pytest
from pyspark.sql import functions as F

from starflow.operators import any_per_key, dense_key, hash_key, latest_per_key, next_key


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_dense_key_does_not_depend_on_partitions(spark, parts, many_parts):
    values = [(i * 7919 % 1000, f"v{i}") for i in range(1000)]
    df = spark.createDataFrame(values, "n int, s string").repartition(parts)
    got = {r.n: r.key for r in dense_key(df, "key", ["n"]).collect()}
    assert got == {n: n + 1 for n in range(1000)}


def test_dense_key_spread_over_partitions(spark, many_parts):
    """A hot leading value is cut over several ranges."""
    df = spark.range(20_000).select(F.lit(1).alias("day"), F.col("id"))
    keyed = dense_key(df, "key", ["day", "id"], start=100)
    assert keyed.where("key <> id + 100").count() == 0
    assert keyed.agg(F.min("key"), F.max("key"), F.countDistinct("key")).first()[:] == \
        (100, 20_099, 20_000)


def test_dense_key_of_copies(spark, many_parts):
    df = spark.createDataFrame([(1, "a")] * 500 + [(1, "b")] * 3 + [(0, "c")], "n int, s string")
    keyed = dense_key(df, "key", ["n"], unique_order=False)
    assert sorted(r.key for r in keyed.collect()) == list(range(1, 505))
    assert keyed.where("n = 0").first().key == 1
    of_b = sorted(r.key for r in keyed.where("s = 'b'").collect())
    assert of_b[2] - of_b[0] == 2


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.range(0), "key", ["id"]).count() == 0


def test_hash_key_tells_keys_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("a", ""), ("", "a"),
            ("a", "\\N"), ("a\\", "|c"), ("a\\|", "c"), (None, None), ("", "")]
    df = spark.createDataFrame(rows, "x string, y string").select(hash_key("x", "y").alias("k"))
    assert df.distinct().count() == len(rows)
    assert all(len(r.k) == 64 for r in df.collect())


def test_next_key(spark):
    df = spark.createDataFrame([(4,), (9,)], "k long")
    assert next_key(df, "k") == 10
    assert next_key(df.where("k > 100"), "k") == 1


def test_latest_per_key(spark):
    random.seed(1)
    rows = [(random.randrange(20), random.choice([None, *range(50)]), i) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, ts int, id int")
    got = latest_per_key(df, ["k"], ["ts", "id"])
    best = {}
    for k, ts, i in rows:
        rank = (ts is not None, ts or 0, i)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, ts, i))
    assert sorted(map(tuple, got.collect())) == sorted(v for _, v in best.values())


def test_latest_per_key_breaks_ties_by_content(spark):
    rows = [(1, 5, "b", None), (1, 5, "c", 1), (1, 5, "c", None), (1, None, "z", 9)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k int, ts int, s string, n int").repartition(3)
        assert [tuple(r) for r in latest_per_key(df, ["k"], ["ts"]).collect()] == [(1, 5, "c", 1)]


@pytest.mark.parametrize("pick", [
    lambda df: latest_per_key(df, ["k"], ["id"]), lambda df: any_per_key(df, ["k"])])
def test_one_row_per_key_and_task_is_shuffled(spark, pick):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = pick(df)._jdf.queryExecution().toString()
    _, below = plan[plan.index("== Physical Plan =="):].split("Exchange hashpartitioning", 1)
    assert "Aggregate(key" in below


def test_any_per_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")],
                               "k int, v string")
    got = any_per_key(df, ["k"]).collect()
    assert sorted(str(r.k) for r in got) == ["1", "2", "None"]
    assert all((r.k, r.v) in {(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")} for r in got)

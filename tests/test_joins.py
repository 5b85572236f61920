"""Exact, hour-aligned and as-of enrichment."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starflow.operators import aligned_join, asof_join, left_enrich

DAY = dt.datetime(2025, 10, 21)


def test_left_join_keeps_nulls_and_multiplies(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "ts int, v string")
    dim = spark.createDataFrame([(1, 10), (1, 11), (None, 12)], "ts int, id int")
    out = left_enrich(fact, dim, "ts")
    assert out.columns == ["ts", "v", "id"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, "a", 10), (1, "a", 11), (2, "b", None), (None, "c", None)], key=str)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_hour_aligned(spark, kind):
    fact = spark.createDataFrame(
        [(1, DAY.replace(hour=5, minute=59)), (2, DAY.replace(hour=6)),
         (3, DAY.replace(hour=9)), (4, None)], f"id int, ts {kind}")
    dim = spark.createDataFrame([(50, DAY.replace(hour=5)), (60, DAY.replace(hour=6))],
                                f"weather_id int, timestamp {kind}")
    out = aligned_join(fact, dim, "ts")
    assert out.columns == ["id", "ts", "weather_id"]
    assert dict(out.dtypes)["ts"] == kind
    assert {r.id: r.weather_id for r in out.collect()} == {1: 50, 2: 60, 3: None, 4: None}


def brute_asof(left, right, tolerance=None):
    out = []
    for i, k, ts in left:
        seen = [(rts, rid) for rk, rts, rid in right
                if None not in (k, ts, rk, rts) and rk == k and rts <= ts]
        best = max(seen, default=(None, None))
        if best[0] is not None and tolerance and (ts - best[0]).total_seconds() > tolerance:
            best = (None, None)
        out.append((i, k, ts, *best))
    return out


def asof_data(seed, hot):
    rng = random.Random(seed)

    def when(span):
        return DAY + dt.timedelta(seconds=rng.randrange(span))

    key = (lambda: 1 if rng.random() < 0.5 else rng.choice([None, 2, 3])) if hot else \
        (lambda: rng.choice([None, *range(12)]))
    span = 3 * 86_400 if hot else 20 * 86_400
    left = [(i, key(), rng.choice([None, when(span), DAY + dt.timedelta(hours=30)]))
            for i in range(300)]
    right = {(key(), rng.choice([None, when(span), when(span)])): 1000 + i for i in range(200)}
    return left, [(k, ts, i) for (k, ts), i in right.items()]


@pytest.mark.parametrize("seed, hot, max_rows, tolerance", [
    (1, False, 1_000_000, None), (2, False, 1_000_000, 7200),
    (3, True, 1_000_000, None), (4, True, 10, None), (5, True, 3, 3600), (6, False, 2, None),
])
def test_asof_equals_brute_force(spark, seed, hot, max_rows, tolerance):
    left, right = asof_data(seed, hot)
    got = asof_join(
        spark.createDataFrame(left, "id int, k int, ts timestamp").repartition(5),
        spark.createDataFrame(right, "k int, seen timestamp, rid int"),
        "ts", "seen", by=["k"], tolerance_seconds=tolerance, max_rows=max_rows)
    assert got.columns == ["id", "k", "ts", "seen", "rid"]
    assert sorted(map(tuple, got.collect())) == sorted(brute_asof(left, right, tolerance))


@pytest.mark.parametrize("max_rows", [1_000_000, 5])
def test_asof_without_key(spark, max_rows):
    left, right = asof_data(7, hot=False)
    left = [(i, 0, ts) for i, _, ts in left]
    right = [(0, ts, i) for ts, i in {ts: i for _, ts, i in right}.items()]
    got = asof_join(
        spark.createDataFrame(left, "id int, k int, ts timestamp"),
        spark.createDataFrame([r[1:] for r in right], "seen timestamp, rid int"),
        "ts", "seen", max_rows=max_rows, bucket_seconds=3600)
    assert sorted(map(tuple, got.collect())) == sorted(brute_asof(left, right))


def test_asof_hot_copies_are_dealt_out(spark):
    """Copies of one left row spread over salts and still all match."""
    ts = F.lit("2025-10-21 12:00:00").cast("timestamp")
    left = spark.range(1000).select(F.lit(1).alias("k"), ts.alias("ts"))
    right = spark.range(5).select(
        F.lit(1).alias("k"), (ts - F.make_dt_interval(hours="id")).alias("seen"), "id")
    got = asof_join(left, right, "ts", "seen", by=["k"], max_rows=50)
    assert got.groupBy("id").count().collect() == [(0, 1000)]


def test_asof_nothing_on_the_right(spark):
    left = spark.createDataFrame([(1, DAY)], "id int, ts timestamp")
    right = spark.createDataFrame([], "seen timestamp, rid int")
    assert [tuple(r) for r in asof_join(left, right, "ts", "seen").collect()] == \
        [(1, DAY, None, None)]

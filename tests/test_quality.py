"""Constraint reports and conforming to declared columns."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starflow import schemas as S
from starflow.operators import (
    conform,
    fk_orphans,
    left_enrich,
    misfits,
    new_rows,
    pk_violations,
    quarantined_rows,
    upsert,
    valid_rows,
)


def test_pk_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, None), (3, None)],
                               "x int, y string")
    got = sorted(map(tuple, pk_violations(df, ["x", "y"]).collect()), key=str)
    assert got == sorted([(1, "a", 2), (None, "c", 1), (3, None, 2)], key=str)


def test_fk_orphans(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (9, "d"), (9, "e")],
                                 "sid int, v string")
    dim = spark.createDataFrame([(1,), (2,), (2,), (None,)], "station_id int")
    got = fk_orphans(fact, dim, {"sid": "station_id"})
    assert got.columns == ["sid", "v"]
    assert sorted(map(tuple, got.collect())) == [(9, "d"), (9, "e")]


def test_split_loses_no_row(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("abc", None), (None, None)],
                               "id string, n int")
    limits = {"not_null": ["id", "n"], "max_length": {"id": 2}}
    assert [tuple(r) for r in valid_rows(df, **limits).collect()] == [("a", 1)]
    reasons = {(r.id, r.n): r.violations for r in quarantined_rows(df, **limits).collect()}
    assert reasons == {(None, 2): ["id is null"], (None, None): ["id is null", "n is null"],
                       ("abc", None): ["n is null", "id longer than 2"]}


def test_length_alone_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), (None,), ("abc",)], "id string")
    assert valid_rows(df, max_length={"id": 2}).count() == 2
    assert quarantined_rows(df, max_length={"id": 2}).count() == 1
    assert valid_rows(df).count() == 3 and quarantined_rows(df).count() == 0


def test_checks_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "id string, n int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = valid_rows(df, not_null=["id", "n"])._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(id), IsNotNull(n)]" in plan
    plan = quarantined_rows(df, not_null=["id", "n"])._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(IsNull(id),IsNull(n))]" in plan


def test_conform(spark):
    df = spark.createDataFrame(
        [("s1", 41.25, 12, "2025-10-21 05:00:00", 7), ("s2", 1e30, 2**40, "x", 8)],
        "station_id string, latitude double, slots long, timestamp string, ignored int")
    out = conform(df, S.fields(timestamp=S.TIME, total_slots=S.INT, ebikes=S.INT,
                               station_id=S.TEXT, latitude=S.NUMERIC), S.FACT_RENAMES)
    assert out.columns == ["timestamp", "total_slots", "ebikes", "station_id", "latitude"]
    assert [t for _, t in out.dtypes] == ["timestamp", "int", "int", "string", "decimal(38,12)"]
    first, second = out.orderBy("station_id").collect()
    assert (first.total_slots, first.ebikes, first.latitude) == (12, None, Decimal("41.25"))
    assert (second.timestamp, second.total_slots, second.latitude) == (None, None, None)


def test_misfits(spark):
    df = spark.createDataFrame([("s1", 41.25, 12), ("s2", 1e30, 2**40), (None, None, None)],
                               "station_id string, latitude double, slots long")
    declared = S.fields(station_id=S.TEXT, latitude=S.NUMERIC, total_slots=S.INT, ebikes=S.INT)
    rows = misfits(df, declared, S.FACT_RENAMES).collect()
    assert [(r.station_id, r.violations) for r in rows] == \
        [("s2", ["latitude: 1.0E30", f"total_slots: {2**40}"])]
    wide = spark.createDataFrame([(1e7, 0.0001, 4000.25)], "a double, b double, c double")
    kept = conform(wide, S.fields(a=S.NUMERIC, b=S.NUMERIC, c=S.NUMERIC)).first()
    assert tuple(kept) == (Decimal("1E7"), Decimal("0.0001"), Decimal("4000.25"))


def hot(spark, n=60_000):
    half = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id"))
    return spark.range(n).select(half.alias("k"), F.lit("x" * 50).alias("v"), F.col("id").alias("r"))


@pytest.mark.parametrize("name", ["fk_orphans", "upsert", "new_rows", "left_enrich"])
def test_hot_key_is_split(spark, tmp_path, name):
    """Half of the rows have one key; the sort-merge join must cut them."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    hot(spark).write.parquet(str(tmp_path / "hot"))
    spark.range(0, 60_000, 3).select(F.col("id").alias("k"), F.lit("y").alias("v"), F.lit(1).cast("long").alias("r")) \
        .write.parquet(str(tmp_path / "other"))
    many, other = (spark.read.parquet(str(tmp_path / x)) for x in ("hot", "other"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = {"fk_orphans": lambda: fk_orphans(many, other, {"k": "k"}),
              "upsert": lambda: upsert(many, other, ["k"]),
              "new_rows": lambda: new_rows(other, many, ["k"]),
              "left_enrich": lambda: left_enrich(many, other.select("k", F.col("v").alias("w")), "k")}[name]()
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_declared_tables():
    assert S.required(S.WAREHOUSE_FACT) == ["fact_id", "timestamp"]
    assert S.required(S.WAREHOUSE_WEATHER) == ["weather_id", "timestamp"]
    for lengths, table in ((S.NETWORK_LENGTHS, S.NETWORK),
                           (S.NETWORK_STATION_LENGTHS, S.NETWORK_STATION),
                           (S.STATION_STATUS_LENGTHS, S.STATION_STATUS)):
        assert set(lengths) <= set(table.names)

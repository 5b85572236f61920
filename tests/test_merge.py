"""Upserts, idempotent appends, replaced partitions and versions."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starflow.operators import append_new, insert_keyed, new_rows, upsert
from starflow.sources import tables as W

tables = st.dictionaries(st.integers(0, 8), st.one_of(st.none(), st.integers(0, 9)), max_size=8)
SCHEMA = "k int, v int"


def as_dict(df):
    rows = df.collect()
    assert len({r.k for r in rows}) == len(rows)
    return {r.k: r.v for r in rows}


@settings(max_examples=10, deadline=None)
@given(target=tables, source=tables)
def test_upsert_laws(spark, target, source):
    t = spark.createDataFrame(list(target.items()), SCHEMA)
    s = spark.createDataFrame(list(source.items()), SCHEMA)
    once = upsert(t, s, ["k"])
    assert as_dict(once) == {**target, **source}
    assert as_dict(upsert(once, s, ["k"])) == {**target, **source}


def test_insert_keyed_keeps_known_keys(spark):
    target = spark.createDataFrame([(1, "h1", 10), (2, "h3", 30)], "id long, hour string, v int")
    source = spark.createDataFrame([("h2", 20), ("h3", None), ("h4", 40)], "hour string, v int")
    got = insert_keyed(target, source, ["hour"], "id")
    assert sorted(map(tuple, got.collect())) == \
        [(1, "h1", 10), (2, "h3", None), (3, "h2", 20), (4, "h4", 40)]
    again = insert_keyed(got, source, ["hour"], "id")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))


def test_new_rows(spark):
    target = spark.createDataFrame([(1, 1)], SCHEMA)
    batch = spark.createDataFrame([(1, 9), (2, 2), (None, 3)], SCHEMA)
    assert sorted(map(tuple, new_rows(target, batch, ["k"]).collect()), key=str) == \
        [(2, 2), (None, 3)]


def events(spark, days):
    df = spark.createDataFrame([(f"s{i}", f"2025-10-{d:02d} 0{i}:00:00", i) for d in days
                                for i in range(4)], "station_id string, ts string, n int")
    return W.with_date(df.withColumn("timestamp", F.to_timestamp("ts")).drop("ts"))


def test_append_twice_adds_nothing(spark, tmp_path):
    path, key = str(tmp_path / "fact"), ["station_id", "timestamp"]
    append_new(events(spark, [1, 2]), path, key)
    append_new(events(spark, [2, 3]), path, key)
    append_new(events(spark, [1, 2, 3]).union(events(spark, [3])), path, key)
    stored = spark.read.parquet(path)
    assert stored.count() == 12 and stored.dropDuplicates(key).count() == 12
    assert sorted(p.name for p in (tmp_path / "fact").glob("date=*")) == \
        [f"date=2025-10-0{d}" for d in (1, 2, 3)]


def test_replaced_partition_leaves_others(spark, tmp_path):
    path = str(tmp_path / "t")
    W.write_by_date(events(spark, [1, 2]), path, "date", ["station_id"])
    W.replace_partitions(events(spark, [2]).where("n = 0"), path, "date", ["station_id"])
    counts = {str(r.date): r["count"] for r in spark.read.parquet(path)
              .groupBy("date").count().collect()}
    assert counts == {"2025-10-01": 4, "2025-10-02": 1}


def test_replaced_partitions_are_one_file_each(spark, tmp_path, many_parts):
    path = str(tmp_path / "t")
    rows = spark.range(0, 3000, 1, 32).select(
        F.date_add(F.lit("2025-10-01").cast("date"), (F.col("id") % 5).cast("int")).alias("date"),
        F.col("id").alias("station_id"))
    W.replace_partitions(rows, path, "date", ["station_id"])
    files = [len(list(day.glob("*.parquet"))) for day in (tmp_path / "t").glob("date=*")]
    assert len(files) == 5 and sum(files) <= 13


def test_append_takes_the_correction(spark, tmp_path):
    path, key = str(tmp_path / "fact"), ["station_id", "timestamp"]
    first = events(spark, [1]).withColumn("file", F.lit("1"))
    later = events(spark, [1]).withColumns({"file": F.lit("2"), "n": F.col("n") + 50})
    append_new(first.unionByName(later).repartition(5), path, key, newest_by=["file"])
    stored = spark.read.parquet(path)
    assert sorted(r.n for r in stored.collect()) == [50, 51, 52, 53]
    assert "file" not in stored.columns


def test_layout_splits_a_hot_day(spark, tmp_path, many_parts):
    rows = spark.range(50_000).select(
        F.lit("2025-10-01").cast("date").alias("date"), F.col("id").alias("station_id"))
    W.write_by_date(rows, str(tmp_path / "t"), "date", ["station_id"])
    files = list((tmp_path / "t" / "date=2025-10-01").glob("*.parquet"))
    spans = sorted(tuple(spark.read.parquet(str(f)).agg(F.min("station_id"), F.max("station_id"))
                         .first()) for f in files)
    assert len(spans) >= 2
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    W.write_by_date(events(spark, [1, 2, 3]), path, "date", ["station_id", "timestamp"])
    day = spark.read.parquet(path).where("date = date'2025-10-02'")
    assert len(day.inputFiles()) >= 1
    plan = day._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_versions(spark, tmp_path):
    path = str(tmp_path / "dim")
    schema = spark.range(0).schema
    assert W.latest_version(spark, path) is None
    assert W.read_version(spark, path, schema).count() == 0
    W.write_version(spark.range(2), path, 1)
    W.write_version(spark.range(5), path, 2)
    with pytest.raises(FileExistsError):
        W.write_version(spark.range(6), path, 2)
    half = tmp_path / "dim" / "version=3"
    half.mkdir()
    assert W.latest_version(spark, path) == 2
    assert W.read_version(spark, path, schema).count() == 5
    assert W.read_version(spark, path, schema, 1).count() == 2
    W.write_version(spark.range(7), path, 3)
    W.drop_versions(spark, path)
    assert W.finished_versions(spark, path) == [2, 3]

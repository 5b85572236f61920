"""Ledger of files, clustering, changes between versions, variants, checks in one pass."""

import os
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starflow.operators import checked, lookup, observed, version_changes, write_clustered
from starflow.operators.clustering import cut_points, interleaved, place
from starflow.plans import model
from starflow.sources import documents as D
from starflow.sources import ledger, variants


def test_each_file_is_taken_once_whatever_its_time(spark, tmp_path):
    from test_model import capture_hours, capture_stations, station

    stations, hours, root = tmp_path / "stations", tmp_path / "hours", str(tmp_path / "warehouse")
    capture_hours(hours, "h.json", "2025-10-21", range(5, 8), 10.0)

    def load():
        model.load_tables(spark, str(stations), str(hours), root, ledger=True)
        return {r.station_id: r.free_bikes for r in model.read_fact(spark, root).collect()}

    capture_stations(stations, "b.json", station("a", "2025-10-21T05:10:00.000000+00:00Z", 1))
    assert load() == {"a": 1}
    (stations / "landed=2025-10-22").mkdir()
    capture_stations(stations / "landed=2025-10-22", "late.json", station("b", "2025-10-21T06:10:00.000000+00:00Z", 2))
    os.utime(stations / "landed=2025-10-22" / "late.json", (1_000_000_000,) * 2)
    assert load() == {"a": 1, "b": 2}
    # Nothing new: nothing is read, nothing changes.
    assert load() == {"a": 1, "b": 2}
    # Written anew under its name, so taken again.
    capture_stations(stations, "b.json", station("a", "2025-10-21T05:10:00.000000+00:00Z", 100))
    assert load() == {"a": 100, "b": 2}
    from starflow.sources import snapshots as N
    taken = N.read_snapshot(spark, root).rows(spark, model.TAKEN, ledger.FILES).collect()
    assert len(taken) == len({(r.source, r.path, r.length, r.modified) for r in taken}) == 4


def test_landing_by_day_is_read_whole(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = spark.createDataFrame([(1, "a")], "k long, v string")
    for day in (date(2025, 1, 1), date(2025, 1, 2)):
        D.land_documents(rows, path, day)
    docs = D.read_documents(spark, path, rows.schema, multi_line=False)
    assert docs.count() == 2 and "landed" not in docs.columns
    assert ledger.listing(spark, "x", path).count() == 2
    plan = ledger.listing(spark, "x", path)._jdf.queryExecution().toString()
    assert "content" not in plan.split("== Physical Plan ==")[1].split("ReadSchema")[-1]


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int")
    got = {(r.a, r.b): r.z for r in df.withColumn("z", interleaved([F.col("a"), F.col("b")], 3)).collect()}
    for (a, b), z in got.items():
        assert z == int("".join(x + y for x, y in zip(f"{a:03b}", f"{b:03b}")), 2)
    with pytest.raises(ValueError):
        interleaved([F.col("a")] * 7, 9)


def test_places_follow_the_order(spark):
    df = spark.createDataFrame([(f"s{i % 97:02d}",) for i in range(1000)] + [(None,)], "s string")
    cuts = cut_points(df, "s", 8)
    assert 4 <= len(cuts) <= 7 and cuts == sorted(cuts)
    got = df.distinct().withColumn("p", place("s", cuts)).collect()
    assert all(r.p == (sum(c <= r.s for c in cuts) if r.s is not None else 0) for r in got)


def scanned(df):
    """Rows that the scan of a plan gave out: those of the row groups that were read."""
    df.collect()
    nodes, rows = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("Scan"):
            rows.append(node.metrics().apply("numOutputRows").value())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return sum(rows)


def test_lookups_read_few_row_groups(spark, tmp_path, many_parts):
    rows = 60_000
    path = str(tmp_path / "fact")
    spark.range(rows).select(
        (F.col("id") % 300).alias("weather_id"), F.concat(F.lit("s"), F.pmod(F.xxhash64("id"), F.lit(500))).alias("station_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload")).write.parquet(path)
    table = spark.read.parquet(path)
    clustered = str(tmp_path / "clustered")
    write_clustered(table, clustered, ["weather_id", "station_id"], bits=5, bloom={"weather_id": 500, "station_id": 500},
                    row_group_bytes=32 << 10)
    stored = spark.read.parquet(clustered)
    assert stored.count() == rows and sorted(stored.columns) == sorted(table.columns)
    for values in ({"weather_id": 17}, {"station_id": "s77"}, {"weather_id": 17, "station_id": "s77"}):
        found = lookup(stored, **values)
        assert sorted(map(tuple, found.select(*table.columns).collect())) == sorted(map(tuple, lookup(table, **values).collect()))
        assert scanned(found) < rows / 3
    assert scanned(lookup(stored, station_id="no such station")) < rows / 20
    assert lookup(stored, weather_id=None).count() == 0


keys = st.one_of(st.none(), st.integers(0, 4))
versions = st.dictionaries(keys, st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.sampled_from(["", "x"]))), max_size=5)


@settings(max_examples=10, deadline=None)
@given(before=versions, after=versions)
def test_changes_between_versions(spark, before, after):
    old, new = (spark.createDataFrame([(k, *v) for k, v in x.items()], "k int, n int, s string") for x in (before, after))
    got = {(r.change, r.k, r.n, r.s) for r in version_changes(old, new, ["k"]).collect()}
    want = ({("added", k, *v) for k, v in after.items() if k not in before}
            | {("removed", k, *v) for k, v in before.items() if k not in after}
            | {("changed", k, *v) for k, v in after.items() if k in before and before[k] != v})
    assert got == want


def test_changes_of_a_table_of_keys(spark):
    old, new = spark.range(3).toDF("k"), spark.range(1, 5).toDF("k")
    assert sorted(map(tuple, version_changes(old, new, ["k"]).collect())) == [("added", 3), ("added", 4), ("removed", 0)]


def test_variants(spark, tmp_path):
    texts = ['{"a": {"x": 1}, "rows": [{"id": "p", "n": null}, {"id": "q"}, {"n": 3, "id": null}]}', '{"a": nul', "[1]", None, "{}"]
    docs = variants.parse_documents(spark.createDataFrame(list(enumerate(texts)), "k int, value string"))
    path = str(tmp_path / "v")
    docs.write.parquet(path)
    stored = spark.read.schema(docs.schema).parquet(path)
    assert {r.k: r.text for r in stored.collect()} == {0: None, 1: '{"a": nul', 2: None, 3: None, 4: None}
    fields = stored.select("k", variants.field("document", "a.x", "int").alias("x"), variants.state("document", "a").alias("a"))
    assert {r.k: (r.x, r.a) for r in fields.collect()} == {
        0: (1, "present"), 1: (None, "absent"), 2: (None, "absent"), 3: (None, "absent"), 4: (None, "absent")}
    rows = variants.elements(stored, "rows", keep=["k"])
    got = rows.select(variants.field("element", "id", "string").alias("id"), variants.state("element", "n").alias("n")).collect()
    assert sorted(map(tuple, got), key=str) == [("p", "null"), ("q", "absent"), (None, "present")]
    assert variants.strict_elements(stored, "rows", ["id"]).count() == 3
    with pytest.raises(Exception, match="missing fields: n"):
        variants.strict_elements(stored, "rows", ["id", "n"]).collect()


def test_rules_in_one_pass(spark):
    rows = [(1, "a", None), (1, "b", "x"), (2, "toolong", "x"), (None, "c", None)]
    df = spark.createDataFrame(rows, "k int, s string, t string")
    got = {r.rule: r.violations for r in checked(df, ["k"], ["t"], {"s": 3}).collect()}
    assert got == {"primary key": 2, "t is null": 2, "s longer than 3": 1}
    assert {r.rule: r.violations for r in checked(df, not_null=["k"]).collect()} == {"k is null": 1}
    assert {r.rule: r.violations for r in checked(df.limit(0), ["k"], ["t"]).collect()} == {"primary key": 0, "t is null": 0}
    plan = checked(df, ["k"], ["t"], {"s": 3})._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Scan") == 1


def test_rules_are_counted_while_a_table_is_written(spark, tmp_path):
    rows = [(1, "a", None), (1, "b", "x"), (2, "toolong", "x"), (None, "c", None)]
    df, counts = observed(spark.createDataFrame(rows, "k int, s string, t string"), ["k", "t"], {"s": 3})
    df.write.parquet(str(tmp_path / "t"))
    assert counts.get == {"rows": 4, "k is null": 1, "t is null": 2, "s longer than 3": 1}

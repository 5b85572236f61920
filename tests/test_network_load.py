"""A load of the network tables parses and unnests each document once, and loses nothing by it."""

import datetime
import json

from pyspark.sql import functions as F

from starflow import schemas as S
from starflow.operators import dedupe
from starflow.plans import landing, model
from starflow.sources import documents as D


def told(df):
    return sorted(map(repr, df.collect()))


def land(folder):
    folder.mkdir()
    stamp = "2025-10-21T05:10:00.000000+00:00Z"
    docs = [
        {"network": {"id": "two", "name": "Two", "latitude": -0.0, "stations": [
            {"id": "a", "name": "A", "timestamp": stamp, "free_bikes": 1, "extra": {"uid": "x"}},
            {"id": "b", "timestamp": "never", "free_bikes": 2}]}},
        {"network": {"id": "none", "stations": []}}, {"network": {"id": "absent"}}, {"network": None}, {},
        {"network": {"stations": [None, {"id": "c", "timestamp": stamp}]}},
        {"network": {"id": "bad", "stations": [{"id": "d", "free_bikes": "many"}, {"id": "e", "free_bikes": 3}]}}]
    lines = [*map(json.dumps, docs), '{"network": {"id": "cut", "stations": [{"id": "f"}, {"id']
    (folder / "docs.json").write_text("\n".join(lines) + "\n")


def test_flat_documents_hold_every_network_station_and_damaged_text(spark, tmp_path):
    land(tmp_path / "in")
    docs = D.read_documents(spark, str(tmp_path / "in"), S.STATION_DOCUMENT, multi_line=False)
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.schema(docs.schema).parquet(str(tmp_path / "docs"))
    rows = model._flat_documents(docs)
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.schema(rows.schema).parquet(str(tmp_path / "rows"))
    damaged = F.col(S.CORRUPT).isNotNull()
    networks = rows.where(F.col("_head") & ~damaged).select("network.*", *model.ORIGIN)
    assert told(networks) == told(model.network_rows(docs.where(F.col(S.CORRUPT).isNull())))
    assert told(rows.where(damaged).select(S.CORRUPT, D.FILE, D.MODIFIED)) == told(D.damaged(docs))
    before = model.station_rows(D.readable(docs))
    stations = rows.where("_station")
    columns = [c for c in before.columns if c in stations.columns]
    assert told(stations.select(columns)) == told(before.select(columns)) and stations.count() >= 4
    assert {*model.STATION_STATUS.columns.names, "uid", "slots", "payment_terminal", "virtual_station"} <= {*columns}


def test_a_load_unnests_documents_once(spark, tmp_path, monkeypatch):
    land(tmp_path / "in")
    stored = {}
    stage = model.stage
    monkeypatch.setattr(model, "stage", lambda df, name: stored.setdefault(name, stage(df, name)))
    model.load_network_tables(spark, str(tmp_path / "in"), str(tmp_path / "out"), multi_line=False)
    # Rows of stations with their time parsed, where arrays of stations with times as text used to be.
    assert stored["documents"].schema["timestamp"].dataType == S.TIME
    assert "array" not in stored["documents"].schema.simpleString()


def test_only_latest_keeps_all_that_may_be_newest_and_sorts_nothing(spark, tmp_path):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", None, "m"), (None, 3, "o"), (None, None, "p")]
    df = spark.createDataFrame(rows, "k string, t long, v string")
    left = dedupe.only_latest(df, ["k"], "t")
    assert sorted(map(tuple, left.collect()), key=str) == sorted(
        [("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", None, "m"), (None, 3, "o")], key=str)
    assert told(dedupe.latest_per_key(left, ["k"], ["t"])) == told(dedupe.latest_per_key(df, ["k"], ["t"]))


def test_an_event_is_taken_apart_once(spark):
    rows = [(1, datetime.datetime(2024, 1, 1), 2, "view", 1.5, '{"k": 7}')]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    plan = landing.station_documents(events)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") == 1 and plan.count("date_format") == 1

"""The join of statuses and weather reads each document once and keeps what waits on disk."""

import json

import pytest

from starflow.session import STATE
from starflow.streaming import status as live

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
HDFS = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def stations_file(folder, name, *stations):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"network": {"stations": [
        {"id": i, "free_bikes": bikes, "timestamp": time, "extra": {"slots": 9}}]}}) for i, time, bikes in stations]
    (folder / name).write_text("\n".join(lines) + "\n")


def hours_file(folder, name, *hours):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"hourly": {
        "time": [f"2025-10-21T{h:02d}:00" for h in hours], "temperature_2m": [10.0 + h for h in hours],
        "precipitation": [0.0] * len(hours), "wind_speed_10m": [1.0] * len(hours), "cloudcover": [1] * len(hours),
        "relativehumidity_2m": [2] * len(hours)}}) + "\n")


def stamp(hour, minute=0):
    return f"2025-10-21T{hour:02d}:{minute:02d}:00.000000+00:00Z"


def joined(spark, top):
    return live.with_weather(live.status_stream(spark, str(top / "stations"), multi_line=False),
                             live.weather_stream(spark, str(top / "hours"), multi_line=False))


def run(spark, top):
    query = live.start(joined(spark, top), live.joined_writer(str(top / "tables")), str(top / "checkpoint"))
    query.awaitTermination()
    return query


def land(top):
    stations_file(top / "stations", "0.json", *((f"s{i}", stamp(5 + i % 4, i), i) for i in range(12)),
                  (None, stamp(6), 50), ("x", "soon", 51), ("y", None, 52))
    with (top / "stations" / "0.json").open("a") as f:
        f.write('{"network": {"stations": [{"id": "cut"\n')
    hours_file(top / "hours", "0.json", 1)


def hours_of(spark, top):
    out = str(top / "tables")
    known = {r.weather_id: r.timestamp.hour for r in live.read_weather(spark, out).collect()}
    return {r.station_id: known.get(r.weather_id) for r in live.read_fact(spark, out, live.ENRICHED).collect()}


def test_statuses_are_read_once(spark, tmp_path):
    land(tmp_path)
    scans = run(spark, tmp_path).lastProgress["sources"]
    assert sum("/stations]" in s["description"] for s in scans) == 1


def test_what_is_not_whole_waits_for_nothing(spark, tmp_path):
    """It is rejected at once and takes no place in the state, while whole statuses wait and are filled."""
    land(tmp_path)
    first = run(spark, tmp_path).recentProgress
    assert sum(p["stateOperators"][0]["numRowsUpdated"] for p in first) == 12 + 8  # statuses, copies of an hour
    reasons = sorted(r.reason for r in live.read_rejected(spark, str(tmp_path / "tables")).collect())
    assert reasons == ["document does not parse in full", "station_id is null", "timestamp is null", "timestamp is null"]
    hours_file(tmp_path / "hours", "1.json", 5, 6, 7, 8)
    run(spark, tmp_path)
    hours_file(tmp_path / "hours", "2.json", 12)
    run(spark, tmp_path)
    assert hours_of(spark, tmp_path) == {f"s{i}": 5 + i % 4 for i in range(12)}
    assert live.read_rejected(spark, str(tmp_path / "tables")).count() == 4


@pytest.fixture
def plain(spark):
    """A session that says nothing of streaming state."""
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k in STATE:
        spark.conf.unset(k)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def kept(top):
    return {p.suffix for p in (top / "checkpoint" / "state").rglob("*") if p.suffix in (".zip", ".delta")}


def test_state_lies_on_disk_whatever_the_session(plain, tmp_path):
    land(tmp_path)
    run(plain, tmp_path)
    assert kept(tmp_path) == {".zip"}
    assert all(plain.conf.get(k, None) is None for k in STATE)


def test_a_provider_of_the_caller_counts(plain, tmp_path):
    plain.conf.set(PROVIDER, HDFS)
    land(tmp_path)
    run(plain, tmp_path)
    assert kept(tmp_path) == {".delta"}
    assert plain.conf.get(PROVIDER) == HDFS


def test_a_checkpoint_goes_on_with_the_state_it_was_begun_with(plain, tmp_path):
    plain.conf.set(PROVIDER, HDFS)
    land(tmp_path)
    run(plain, tmp_path)
    plain.conf.unset(PROVIDER)
    hours_file(tmp_path / "hours", "1.json", 5, 6, 7, 8)
    run(plain, tmp_path)
    assert kept(tmp_path) == {".delta"}
    assert hours_of(plain, tmp_path) == {f"s{i}": 5 + i % 4 for i in range(12)}


def test_a_batch_is_merged_with_adaptive_plans(spark, tmp_path, monkeypatch):
    """The stream's session has them turned off; the next batch of the stream has them off again."""
    name, seen, merge = "spark.sql.adaptive.enabled", [], live._merge_status
    staged, stage = [], live.stage

    def watched(load, *rest):
        seen.append(load.spark.conf.get(name))
        merge(load, *rest)

    def watched_stage(df, what):
        if what == "batch":
            staged.append(df.sparkSession.conf.get(name))
        return stage(df, what)

    monkeypatch.setattr(live, "_merge_status", watched)
    monkeypatch.setattr(live, "stage", watched_stage)
    land(tmp_path)
    run(spark, tmp_path)
    hours_file(tmp_path / "hours", "1.json", 5, 6, 7, 8)
    run(spark, tmp_path)
    assert len(seen) >= 2 and {*seen} == {"true"} and {*staged} == {"false"}
    assert spark.conf.get(name) == "true"
    assert hours_of(spark, tmp_path) == {f"s{i}": 5 + i % 4 for i in range(12)}

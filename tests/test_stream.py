"""The stream gives what the batch gives, however the files are dealt to batches."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from starflow import schemas as S
from starflow.operators import latest_per_key
from starflow.plans import model
from starflow.sources import documents as D
from starflow.streaming import status as live


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for snapshot in range(6):
        stations = [{"id": f"s{i}", "name": f"S{i}", "free_bikes": snapshot * 10 + i,
                     "timestamp": f"2025-10-21T{5 + snapshot:02d}:0{i}:00.000000+00:00Z",
                     "extra": {"slots": 20}} for i in range(5)]
        text = json.dumps({"network": {"id": "n", "stations": stations}}, indent=4)
        (folder / f"{snapshot}.json").write_text(text)
        if snapshot % 3 == 0:
            (folder / f"{snapshot}-again.json").write_text(text)
    return folder


def batch_status(spark, folder):
    docs = D.readable(D.read_documents(spark, str(folder), S.STATION_DOCUMENT))
    return model.status_rows(model.station_rows(docs)).dropDuplicates(model.FACT_KEY)


def run(spark, landing, out, max_files=2, weather=None, checkpoint="checkpoint"):
    stream = live.status_stream(spark, str(landing), max_files=max_files)
    if weather is not None:
        stream = live.enrich_stream(stream, weather)
    tables = str(out / "tables")
    live.start(stream, live.keyed_writer(tables), str(out / checkpoint)).awaitTermination()
    return tables


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def document(folder, name, *stations):
    (folder / name).write_text(json.dumps({"network": {"stations": list(stations)}}))


@pytest.mark.parametrize("max_files", [1, 3, None])
def test_stream_equals_batch(spark, landing, tmp_path, max_files):
    out = run(spark, landing, tmp_path, max_files)
    status = batch_status(spark, landing)
    assert content(live.read_fact(spark, out).drop("date")) == content(status)
    assert status.count() == 30
    newest = latest_per_key(status, ["station_id"], ["timestamp"])
    assert content(live.read_latest(spark, out)) == content(newest)
    assert live.read_rejected(spark, out).count() == 0
    kept = sorted(p.name for p in (tmp_path / "tables" / "latest").iterdir())
    assert len(kept) <= live.LATEST_PARTS + 10


def test_newest_file_first_loses_nothing(spark, landing, tmp_path):
    for place, name in enumerate(sorted(os.listdir(landing), reverse=True)):
        os.utime(landing / name, (1_700_000_000 + 100 * place,) * 2)
    document(landing, "old.json", {"id": "s0", "free_bikes": 1, "timestamp": "2020-01-01T04:00:00.000000+00:00Z"},
             {"id": "s0", "free_bikes": 98, "timestamp": "soon"})
    (landing / "cut.json").write_text('{"network": {"stations": [{"id": "s')
    out = run(spark, landing, tmp_path, max_files=1)
    assert live.read_fact(spark, out).count() == 31
    left = sorted((r.reason, r.file.rsplit("/", 1)[1]) for r in live.read_rejected(spark, out).collect())
    assert left == [("document does not parse in full", "cut.json"), ("timestamp is null", "old.json")]
    newest = {r.station_id: r.free_bikes for r in live.read_latest(spark, out).collect()}
    assert newest == {f"s{i}": 50 + i for i in range(5)}


def test_new_files_continue_where_it_stopped(spark, landing, tmp_path):
    run(spark, landing, tmp_path)
    time = "2025-10-21T04:00:00.000000+00:00Z"
    document(landing, "late.json", {"id": "s0", "free_bikes": 99, "timestamp": time},
             {"id": "s9", "free_bikes": 98, "timestamp": time})
    out = run(spark, landing, tmp_path)
    assert live.read_fact(spark, out).count() == 32
    newest = {r.station_id: r.free_bikes for r in live.read_latest(spark, out).collect()}
    assert newest == {"s0": 50, "s1": 51, "s2": 52, "s3": 53, "s4": 54, "s9": 98}


def test_a_fresh_checkpoint_harms_nothing(spark, landing, tmp_path):
    """Another query on the same tables, over other files and then over all of them."""
    run(spark, landing, tmp_path)
    other = tmp_path / "other"
    other.mkdir()
    document(other, "x.json", {"id": "n1", "free_bikes": 7, "timestamp": "2025-10-21T04:00:00.000000+00:00Z"},
             {"id": "n2", "timestamp": "never"})
    out = run(spark, other, tmp_path, checkpoint="second")
    for name in os.listdir(other):
        shutil.copy(other / name, landing / name)
    assert live.read_fact(spark, out).count() == 31
    assert {r.station_id for r in live.read_latest(spark, out).collect()} == {"n1", *(f"s{i}" for i in range(5))}
    out = run(spark, landing, tmp_path, checkpoint="third")
    assert live.read_fact(spark, out).count() == 31
    assert live.read_rejected(spark, out).select("query").distinct().count() == 2


def test_replayed_batch_changes_nothing(spark, landing, tmp_path):
    out = str(tmp_path / "tables")
    write = live.keyed_writer(out)
    docs = D.read_documents(spark, str(landing), S.STATION_DOCUMENT)
    status = model.status_rows(model.station_rows_and_damage(docs), *model.ORIGIN, S.CORRUPT)
    write(status.where(F.hour("timestamp") < 8), 0)
    write(status, 1)
    before = content(live.read_fact(spark, out)), content(live.read_latest(spark, out))
    write(status, 1)
    assert (content(live.read_fact(spark, out)), content(live.read_latest(spark, out))) == before
    assert content(live.read_fact(spark, out).drop("date")) == content(batch_status(spark, landing))


def weather_of(spark, *hours):
    return spark.createDataFrame([(h, f"2025-10-21 {h:02d}:00:00") for h in hours],
                                 "weather_id long, t string").select(
        "weather_id", F.to_timestamp("t").alias("timestamp"))


def test_enriched_stream_and_late_weather(spark, landing, tmp_path):
    out = run(spark, landing, tmp_path, weather=weather_of(spark, 5, 6, 7))

    def hours():
        return {(r.timestamp.hour, r.weather_id) for r in live.read_fact(spark, out, live.ENRICHED).collect()}

    assert hours() == {(5, 5), (6, 6), (7, 7), (8, None), (9, None), (10, None)}
    day, = live.read_fact(spark, out).select("date").distinct().collect()
    live.refill_weather(spark, out, weather_of(spark, 5, 6, 7, 8, 9), [day[0]])
    assert hours() == {(5, 5), (6, 6), (7, 7), (8, 8), (9, 9), (10, None)}
    assert live.read_fact(spark, out).count() == 30


def test_few_files(spark, landing, tmp_path, many_parts):
    run(spark, landing, tmp_path, max_files=None)
    assert len(list((tmp_path / "tables" / "fact").glob("load=*/date=*/*.parquet"))) <= 8


@pytest.mark.parametrize("max_files", [1, None])
def test_corrections_do_not_depend_on_the_batches(spark, tmp_path, max_files):
    """One station and time in several files, the latest not in the last batch; ties go by content."""
    folder = tmp_path / "landing"
    folder.mkdir()
    when = "2025-10-21T04:00:00.000000+00:00Z"
    for place, (name, bikes, stamp) in enumerate([("a", 9, 100), ("b", 3, 300), ("c", 5, 200), ("d", 4, 300)]):
        document(folder, f"{name}.json", {"id": "s", "free_bikes": bikes, "timestamp": when},
                 {"id": f"s{place}", "free_bikes": bikes, "timestamp": when})
        os.utime(folder / f"{name}.json", (1_700_000_000 + stamp,) * 2)
    out = run(spark, folder, tmp_path, max_files)
    assert {r.station_id: r.free_bikes for r in live.read_fact(spark, out).collect()} == {"s": 4, "s0": 9, "s1": 3, "s2": 5, "s3": 4}
    assert {r.station_id: r.free_bikes for r in live.read_latest(spark, out).collect()}["s"] == 4
    # What comes later, but from an older file, changes nothing.
    document(folder, "old.json", {"id": "s", "free_bikes": 99, "timestamp": when})
    os.utime(folder / "old.json", (1_700_000_000,) * 2)
    out = run(spark, folder, tmp_path, max_files)
    assert {r.free_bikes for r in live.read_fact(spark, out).where("station_id = 's'").collect()} == {4}


def hours_document(folder, name, *hours):
    (folder / name).write_text(json.dumps({"hourly": {
        "time": [f"2025-10-21T{h:02d}:00" for h in hours], "temperature_2m": [10.0 + h for h in hours],
        "precipitation": [0.0] * len(hours), "wind_speed_10m": [1.0] * len(hours), "cloudcover": [1] * len(hours),
        "relativehumidity_2m": [2] * len(hours)}}))


def test_weather_as_a_stream(spark, landing, tmp_path):
    """Statuses wait for their weather; what comes too late for the state still reaches them."""
    hours = tmp_path / "hours"
    hours.mkdir()
    hours_document(hours, "0.json", 1)

    def step(name=None, *of):
        if name:
            hours_document(hours, name, *of)
        stream = live.with_weather(live.status_stream(spark, str(landing)), live.weather_stream(spark, str(hours)))
        live.start(stream, live.joined_writer(str(tmp_path / "tables")), str(tmp_path / "checkpoint")).awaitTermination()
        out = str(tmp_path / "tables")
        of = {r.weather_id: r.timestamp.hour for r in live.read_weather(spark, out).collect()}
        return {(r.timestamp.hour, of.get(r.weather_id)) for r in live.read_fact(spark, out, live.ENRICHED).collect()}

    assert step() == set()
    # Hours 9 and 10 are known; the watermark passes 5 to 7, which go on without, and 8 waits.
    got = step("1.json", 9, 10)
    assert {(9, 9), (10, 10)} <= got <= {(9, 9), (10, 10), *((h, None) for h in range(5, 9))}
    document(landing, "late.json", {"id": "late", "free_bikes": 1, "timestamp": "2025-10-21T05:30:00.000000+00:00Z"},
             {"id": "cut", "free_bikes": 1, "timestamp": "soon"})
    (hours / "cut.json").write_text('{"hourly": {"time": ["2025')
    step("2.json", 5, 6, 7, 8)
    assert step("3.json", 12) == {(h, h) for h in range(5, 11)}
    out = str(tmp_path / "tables")
    assert live.read_fact(spark, out).count() == 31
    assert sorted((r.source, r.reason) for r in live.read_rejected(spark, out).collect()) == [
        ("hours", "document does not parse in full"), ("stations", "timestamp is null")]
    newest = {r.station_id: r.weather_id is not None for r in live.read_latest(spark, out, live.ENRICHED).collect()}
    assert newest == {**{f"s{i}": True for i in range(5)}, "late": True}


def test_weather_of_the_moment(spark, landing, tmp_path):
    """A running stream sees the weather that loads have stored since it began."""
    out, calls = str(tmp_path / "tables"), []

    def now():
        calls.append(1)
        return weather_of(spark, *range(5, 5 + 2 * len(calls)))

    stream = live.status_stream(spark, str(landing), max_files=3)
    live.start(stream, live.keyed_writer(out, weather=now, compact_every=2), str(tmp_path / "c")).awaitTermination()
    assert len(calls) >= 3
    assert all(r.weather_id in (None, r.timestamp.hour) for r in live.read_fact(spark, out, live.ENRICHED).collect())
    assert live.read_fact(spark, out).count() == 30

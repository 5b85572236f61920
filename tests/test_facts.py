"""Facts that are corrected, numbered once and compacted: the same for any split into loads."""

import datetime
import itertools
import threading

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starflow import schemas as S
from starflow.plans import model
from starflow.session import scratch
from starflow.sources import snapshots as N
from starflow.sources.facts import FactTable

ORIGIN = S.fields(modified=S.LONG, file=S.TEXT)
FACT = FactTable("fact", S.fields(station_id=S.TEXT, timestamp=S.TIME, bikes=S.LONG, weather_id=S.LONG),
                 ["station_id", "timestamp"], ORIGIN, ["weather_id"], "fact_id")
GIVEN = "station_id string, timestamp timestamp, bikes long, weather_id long, modified long, file string"


def at(hour, day=1):
    return datetime.datetime(2025, 10, day, hour)


def merge(spark, root, *batches):
    for rows in batches:
        with N.load(spark, root) as load, scratch(spark):
            FACT.merge(load, spark.createDataFrame(list(rows), GIVEN))


def stored(spark, root, *columns):
    return sorted(map(tuple, FACT.read(spark, N.read_snapshot(spark, root)).select(
        *(columns or ("station_id", "timestamp", "bikes", "weather_id", "modified", "file"))).collect()), key=str)


def best(rows):
    """The newest row of each key, by origin and then by content, nothing being least."""
    def rank(r):
        return tuple((v is not None, v if v is not None else 0) for v in (r[4], r[5], r[2], r[3]))

    found = {}
    for r in rows:
        if r[:2] not in found or rank(r) > rank(found[r[:2]]):
            found[r[:2]] = r
    return sorted(found.values(), key=str)


rows_of = st.tuples(st.sampled_from("ab"), st.sampled_from([at(1), at(2), at(1, 2)]), st.one_of(st.none(), st.integers(0, 2)),
                    st.one_of(st.none(), st.integers(1, 2)), st.integers(1, 2), st.sampled_from("xy"))


@settings(max_examples=6, deadline=None)
@given(batches=st.lists(st.lists(rows_of, min_size=1, max_size=5), min_size=1, max_size=3), order=st.randoms())
def test_any_split_and_order_gives_the_same(spark, tmp_path_factory, batches, order):
    root = str(tmp_path_factory.mktemp("facts"))
    merge(spark, root, *batches)
    assert stored(spark, root) == best(itertools.chain(*batches))
    order.shuffle(batches)
    merge(spark, root, *batches)
    assert stored(spark, root) == best(itertools.chain(*batches))


def test_numbers_stay_and_go_on(spark, tmp_path):
    root = str(tmp_path)
    merge(spark, root, [("a", at(5), 1, None, 1, "x"), ("b", at(4), 1, None, 1, "x")])
    before = dict((r[0], r[1]) for r in stored(spark, root, "station_id", "fact_id"))
    assert before == {"b": 1, "a": 2}
    merge(spark, root, [("c", at(1), 1, None, 2, "y"), ("a", at(5), 7, None, 2, "y"), ("d", at(0), 1, None, 2, "y")])
    assert stored(spark, root, "station_id", "fact_id", "bikes") == [("a", 2, 7), ("b", 1, 1), ("c", 4, 1), ("d", 3, 1)]
    assert N.read_snapshot(spark, root).marks == {"fact_id": 4}


def test_rows_without_a_time_are_kept_once(spark, tmp_path):
    root = str(tmp_path)
    rows = [("a", None, 1, None, 1, "x"), ("a", at(1), 2, None, 1, "x"), (None, None, 3, None, 1, "x")]
    merge(spark, root, rows, rows, [("a", None, 9, None, 2, "y")])
    assert stored(spark, root, "station_id", "timestamp", "bikes") == sorted(
        [("a", None, 9), ("a", at(1), 2), (None, None, 3)], key=str)


def test_corrections_are_small_files_until_they_are_folded_in(spark, tmp_path):
    root = str(tmp_path)
    first = [(f"s{i}", at(1, d), i, None, 1, "x") for i in range(50) for d in (1, 2)]
    merge(spark, root, first, [("s3", at(1, 1), 99, None, 2, "y")])
    state = N.read_snapshot(spark, root)
    assert set(state.parts["fact"]) == {"2025-10-01", "2025-10-02"} and set(state.parts["fact_corrections"]) == {"2025-10-01"}
    wanted = stored(spark, root, "fact_id", "station_id", "bikes")
    assert [r for r in wanted if r[1] == "s3"][0][2] in (3, 99) and sum(r[2] == 99 for r in wanted) == 1
    # A day without corrections is read without a join.
    plan = FACT.read(spark, state, [datetime.date(2025, 10, 2)])._jdf.queryExecution().toString()
    assert "Join" not in plan
    with N.load(spark, root) as load, scratch(spark):
        assert FACT.compact(load) == ["2025-10-01"]
    assert "2025-10-01" not in N.read_snapshot(spark, root).parts["fact_corrections"]
    assert stored(spark, root, "fact_id", "station_id", "bikes") == wanted


def test_fifty_batches_become_about_one_file_a_day(spark, tmp_path):
    root, days = str(tmp_path), 4
    for k in range(50):
        with N.load(spark, root) as load, scratch(spark):
            rows = spark.range(days * 5).select(
                F.concat(F.lit("s"), F.lit(k), F.lit("-"), F.col("id")).alias("station_id"),
                F.make_timestamp(F.lit(2025), F.lit(10), F.col("id") % days + 1, F.lit(k % 24), F.lit(0), F.lit(0)).alias("timestamp"),
                F.col("id").alias("bikes"), F.lit(None).cast("long").alias("weather_id"), F.lit(k).cast("long").alias("modified"),
                F.lit("f").alias("file"), F.date_add(F.lit("2025-10-01").cast("date"), (F.col("id") % days).cast("int")).alias("date"),
                (F.lit(k * days * 5) + F.col("id")).alias("fact_id"))
            load.add_dated("fact", lambda path: rows.select(*FACT.stored.names).coalesce(1).write.partitionBy("date").parquet(path))
    before = stored(spark, root)
    assert sum(p.files for ps in N.read_snapshot(spark, root).parts["fact"].values() for p in ps) == 50 * days
    with N.load(spark, root) as load, scratch(spark):
        assert len(FACT.compact(load)) == days
    state = N.read_snapshot(spark, root)
    assert sum(p.files for ps in state.parts["fact"].values() for p in ps) <= 2 * days
    assert stored(spark, root) == before and len(before) == 1000
    part = state.parts["fact"]["2025-10-01"][0]
    order = [tuple(r) for f in sorted((tmp_path / part.path).glob("*.parquet"))
             for r in spark.read.parquet(str(f)).select("station_id", "timestamp").collect()]
    assert order == sorted(order)
    with N.load(spark, root) as load, scratch(spark):
        assert FACT.compact(load) == []


def test_large_days_are_cut(spark, tmp_path):
    root = str(tmp_path)
    merge(spark, root, [(f"s{i}", at(i % 24), i, None, 1, "x") for i in range(2000)], [("s1", at(1), 5, None, 2, "y")])
    size = sum(p.bytes for p in N.read_snapshot(spark, root).parts["fact"]["2025-10-01"])
    with N.load(spark, root) as load, scratch(spark):
        FACT.compact(load, target_bytes=size // 4)
    assert 3 <= sum(p.files for p in N.read_snapshot(spark, root).parts["fact"]["2025-10-01"]) <= 7
    assert len(stored(spark, root)) == 2000


def test_filling_writes_only_what_changed(spark, tmp_path):
    root = str(tmp_path)
    merge(spark, root, [("a", at(1), 1, None, 1, "x"), ("b", at(2), 1, 7, 1, "x"), ("c", at(1, 2), 1, None, 1, "x")])

    def filled(rows):
        return rows.withColumn("weather_id", F.when(F.hour("timestamp") == 1, F.lit(3)).otherwise(F.lit(7)).cast("long"))

    with N.load(spark, root) as load, scratch(spark):
        assert FACT.fill(load, [datetime.date(2025, 10, 1), datetime.date(2030, 1, 1)], filled).count() == 1
        assert FACT.fill(load, [datetime.date(2025, 10, 1)], filled) is None
    assert [(r[0], r[3]) for r in stored(spark, root)] == [("a", 3), ("b", 7), ("c", None)]
    # The same row again does not undo it, a newer one does not lose it.
    merge(spark, root, [("a", at(1), 1, None, 1, "x")], [("b", at(2), 4, 7, 2, "x")])
    assert [(r[0], r[2], r[3]) for r in stored(spark, root)] == [("a", 1, 3), ("b", 4, 7), ("c", 1, None)]


def test_two_loads_at_once(spark, tmp_path):
    """Both run to their end; one is stored, the other stops and can be run again."""
    from test_model import capture_hours, capture_stations, station

    for k in (1, 2):
        capture_stations(tmp_path / f"stations{k}", "s.json", station(f"k{k}", "2025-10-21T05:10:00.000000+00:00Z", k))
    capture_hours(tmp_path / "hours", "h.json", "2025-10-21", range(5, 8), 10.0)
    root, outcome = str(tmp_path / "warehouse"), {}

    def run(k):
        try:
            model.load_tables(spark, str(tmp_path / f"stations{k}"), str(tmp_path / "hours"), root)
            outcome[k] = "stored"
        except N.CommitConflict:
            outcome[k] = "stopped"

    threads = [threading.Thread(target=run, args=(k,)) for k in (1, 2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    ids = {r.station_id for r in model.read_fact(spark, root).collect()}
    if sorted(outcome.values()) == ["stopped", "stored"]:
        assert ids == {f"k{k}" for k in outcome if outcome[k] == "stored"}
        run([k for k in outcome if outcome[k] == "stopped"][0])
    assert {r.station_id for r in model.read_fact(spark, root).collect()} == {"k1", "k2"}
    assert model.read_weather(spark, root).count() == 3
    assert sorted(r.fact_id for r in model.read_fact(spark, root).collect()) == [1, 2]


def test_a_reader_during_a_fill_sees_one_state(spark, tmp_path):
    root = str(tmp_path)
    merge(spark, root, [("a", at(1), 1, None, 1, "x")])
    seen = FACT.read(spark, N.read_snapshot(spark, root))
    with N.load(spark, root) as load, scratch(spark):
        FACT.fill(load, [datetime.date(2025, 10, 1)], lambda rows: rows.withColumn("weather_id", F.lit(1).cast("long")))
        assert [r.weather_id for r in seen.collect()] == [None]
        assert [r[3] for r in stored(spark, root)] == [None]
    assert [r.weather_id for r in seen.collect()] == [None] and [r[3] for r in stored(spark, root)] == [1]


def test_network_job(spark, tmp_path):
    from test_model import capture_stations, station

    folder, root = tmp_path / "stations", str(tmp_path / "network")
    capture_stations(folder, "1.json", station("a", "2025-10-21T05:10:00.000000+00:00Z", 1, slots=9),
                     station(None, "2025-10-21T05:10:00.000000+00:00Z", 1), station("n", "never", 5), country="QXX")
    capture_stations(folder, "2.json", station("a", "2025-10-21T06:10:00.000000+00:00Z", 99_999_999_999, slots=9), id=None)
    (folder / "cut.json").write_text('{"network": {"id": "')
    model.load_network_tables(spark, str(folder), root)
    networks, stations, status = model.read_network_tables(spark, root)
    assert [(r.id, r.country) for r in networks.collect()] == [("net", "QXX")]
    # Rules are counted as the tables are written.
    checks = N.read_snapshot(spark, root).checks
    assert checks["dim_network"]["rows"] == 1 and checks["dim_network"]["country longer than 2"] == 1
    assert checks["dim_network"]["id is null"] == 0 and checks["dim_network_station"]["rows"] == 2
    assert sorted(r.station_id for r in stations.collect()) == ["a", "n"]
    before = sorted(map(tuple, status.collect()), key=str)
    assert sorted((r[0], r[1], r[3]) for r in before) == [(1, "n", 5), (2, "a", 1), (3, "a", None)]
    left = model.read_rejected(spark, root).collect()
    assert sorted((r.source, r.reason) for r in left) == [
        ("networks", "id is null"), ("stations", "document does not parse in full"),
        ("stations", "free_bikes: 99999999999"), ("stations", "station_id is null")]
    model.load_network_tables(spark, str(folder), root)
    assert sorted(map(tuple, model.read_network_tables(spark, root)[2].collect()), key=str) == before


@pytest.mark.parametrize("align", ["exact", "hour", "asof"])
def test_one_load_and_many_give_the_same_fact(spark, tmp_path, align):
    import os

    from test_model import capture_hours, capture_stations, station

    def payload(k):
        return [station("a", "2025-10-21T05:00:00.000000+00:00Z", k, slots=k), station(f"s{k}", f"2025-10-21T0{5 + k}:10:00.000000+00:00Z", k)]

    one, many = tmp_path / "one", tmp_path / "many"
    for k in range(3):
        for folder in (one, many):
            capture_stations(folder, f"{k}.json", *payload(k)) if folder == one else None
        os.utime(one / f"{k}.json", (1_700_000_000 + 10 * (2 - k),) * 2)
    capture_hours(tmp_path / "hours", "h.json", "2025-10-21", range(4, 7), 10.0)
    model.load_tables(spark, str(one), str(tmp_path / "hours"), str(tmp_path / "w1"), align)
    for k in (1, 0, 2):
        capture_stations(many, f"{k}.json", *payload(k))
        os.utime(many / f"{k}.json", (1_700_000_000 + 10 * (2 - k),) * 2)
        model.load_tables(spark, str(many), str(tmp_path / "hours"), str(tmp_path / "w2"), align)
    a, b = (sorted(map(tuple, model.read_fact(spark, str(tmp_path / w)).drop("fact_id").collect()), key=str) for w in ("w1", "w2"))
    assert a == b and [r[2] for r in a if r[0] == "a"] == [0]

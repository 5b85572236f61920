"""JDBC settings and statements.  No database is started, so none is reached."""

import datetime

import pytest

from starflow import schemas as S
from starflow.plans import model
from starflow.session import scratch
from starflow.sources import jdbc, snapshots

URL, LOGIN = "jdbc:postgresql://host/db", {"user": "u", "driver": "org.postgresql.Driver"}


class Writer:
    def __init__(self, log):
        self.log, self.options = log, {}

    def option(self, name, value):
        self.options[name] = value
        return self

    def jdbc(self, url, table, mode, properties):
        self.log.append((table, mode, self.options, properties))


class Frame:
    columns = ["station_id", "name", "slots"]
    sparkSession = None

    def __init__(self):
        self.log = []

    @property
    def write(self):
        return Writer(self.log)


def test_append_options():
    df = Frame()
    jdbc.append_jdbc(df, URL, "fact", LOGIN, connections=4, batch_rows=500)
    (table, mode, options, properties), = df.log
    assert (table, mode, properties) == ("fact", "append", LOGIN)
    assert options["numPartitions"] == 4 and options["batchsize"] == 500
    assert "truncate" not in options


def test_replace_keeps_the_table():
    df = Frame()
    jdbc.replace_jdbc(df, URL, "dim", LOGIN)
    (_, mode, options, _), = df.log
    assert mode == "overwrite" and options["truncate"] is True


def test_upsert_stages_merges_and_drops(monkeypatch):
    ran = []
    monkeypatch.setattr(jdbc, "execute", lambda spark, url, login, sql: ran.append(sql))
    df = Frame()
    for _ in range(2):
        jdbc.upsert_jdbc(df, URL, "dim_station", ["station_id"], LOGIN)
    (first, mode, _, _), (second, _, _, _) = df.log
    assert mode == "append" and first != second and first.startswith("dim_station_staging_")
    assert ran[:2] == ["INSERT INTO dim_station (station_id, name, slots) "
                       f"SELECT DISTINCT station_id, name, slots FROM {first} "
                       "ON CONFLICT (station_id) DO UPDATE SET "
                       "name = EXCLUDED.name, slots = EXCLUDED.slots",
                       f"DROP TABLE IF EXISTS {first}"]


def test_staging_is_dropped_after_a_failure(monkeypatch):
    ran = []

    def execute(spark, url, login, sql):
        ran.append(sql)
        if sql.startswith("INSERT"):
            raise RuntimeError("no")

    monkeypatch.setattr(jdbc, "execute", execute)
    with pytest.raises(RuntimeError):
        jdbc.append_new_jdbc(Frame(), URL, "fact", ["station_id"], LOGIN)
    assert ran[-1].startswith("DROP TABLE IF EXISTS fact_staging_")


def test_key_only_table():
    assert jdbc.upsert_statement("t", "s", ["a", "b"], ["a", "b"]).endswith(
        "ON CONFLICT (a, b) DO NOTHING")


def test_append_new_statement():
    assert jdbc.append_new_statement("fact", "st", ["a", "ts", "n"], ["a", "ts"]) == (
        "INSERT INTO fact (a, ts, n) SELECT DISTINCT a, ts, n FROM st s "
        "WHERE NOT EXISTS (SELECT 1 FROM fact t WHERE t.a = s.a AND t.ts = s.ts)")


@pytest.fixture
def warehouse(spark, tmp_path):
    fact = spark.createDataFrame([("a", datetime.datetime(2025, 10, 1 + n), n, 2, True, 1, 3, n) for n in (1, 2)], S.LOADED_FACT)
    with snapshots.load(spark, str(tmp_path)) as load, scratch(spark):
        load.replace("dim_station", spark.createDataFrame([("a", "A", 1.0, 2.0, "x", True, 3)], S.DIM_STATION))
        load.replace("dim_weather", spark.createDataFrame([(1, None, 1e30, None, None, None, None)], S.DIM_WEATHER))
        model.FACT.merge(load, fact.selectExpr("*", "timestamp as _modified", "'f' as _file"))
    return tmp_path


def loaded(spark, warehouse, monkeypatch, **settings):
    done = []
    for name in ("append_jdbc", "upsert_jdbc", "append_new_jdbc", "delete_jdbc"):
        monkeypatch.setattr(jdbc, name, lambda df, url, table, *rest, n=name: done.append((n, table, df)))
    monkeypatch.setattr(jdbc, "execute", lambda spark, url, login, sql: done.append(("execute", sql, None)))
    model.load_jdbc(spark, str(warehouse), URL, LOGIN, **settings)
    return done


def test_warehouse_load(spark, warehouse, monkeypatch):
    done = loaded(spark, warehouse, monkeypatch, days=[datetime.date(2025, 10, 2)])
    assert [d[:2] for d in done] == [("upsert_jdbc", "dim_station"), ("upsert_jdbc", "dim_weather"),
                                     ("append_new_jdbc", "fact_bike_weather")]
    fact = done[2][2]
    assert fact.columns == [c for c in S.WAREHOUSE_FACT.names if c != "fact_id"]
    assert [(r.empty_slots, r.ebikes) for r in fact.collect()] == [(3, 1)]
    lost = spark.read.parquet(f"{warehouse}/misfits").collect()
    assert [(r.source, r.reason) for r in lost] == [("dim_weather", "temperature: 1.0E30")]


def test_warehouse_replacement(spark, warehouse, monkeypatch):
    done = loaded(spark, warehouse, monkeypatch, replace=True)
    assert [d[:2] for d in done] == [
        ("execute", "TRUNCATE fact_bike_weather, dim_station, dim_weather"), ("upsert_jdbc", "dim_station"),
        ("upsert_jdbc", "dim_weather"), ("append_new_jdbc", "fact_bike_weather")]
    assert done[3][2].count() == 2


def test_only_changes_since_a_commit_are_sent(spark, warehouse, monkeypatch):
    root = str(warehouse)
    with snapshots.load(spark, root) as load:
        load.replace("dim_station", spark.createDataFrame(
            [("a", "A", 1.0, 2.0, "x", False, 3), ("b", "B", None, None, None, None, None)], S.DIM_STATION))
        load.replace("dim_weather", spark.createDataFrame([], S.DIM_WEATHER))
    done = loaded(spark, warehouse, monkeypatch, since=1)
    sent = {(kind, table): df for kind, table, df in done}
    assert sorted(tuple(r)[:2] for r in sent["upsert_jdbc", "dim_station"].collect()) == [("a", "A"), ("b", "B")]
    assert sent["upsert_jdbc", "dim_weather"].count() == 0 == sent["delete_jdbc", "dim_station"].count()
    assert [tuple(r) for r in sent["delete_jdbc", "dim_weather"].collect()] == [(1,)]
    # Nothing has changed since the newest commit.
    assert loaded(spark, warehouse, monkeypatch, since=2)[0][2].count() == 0


def test_delete_statement():
    assert jdbc.delete_statement("dim", "st", ["a", "b"]) == (
        "DELETE FROM dim t WHERE EXISTS (SELECT 1 FROM st s WHERE t.a = s.a AND t.b = s.b)")

"""Raw documents: reading, broken input, optional and strict fields, landing."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starflow import schemas as S
from starflow.plans import model
from starflow.sources import documents as D

STAMP = "2025-10-21T12:34:56.123456+00:00Z"


def station(**changes):
    base = {"id": "s1", "name": "Main St", "latitude": 1.5, "longitude": -2.5,
            "timestamp": STAMP, "free_bikes": 3,
            "extra": {"has_ebikes": True, "slots": 10}}
    base.update(changes)
    return {k: v for k, v in base.items() if v != "absent"}


def capture(folder, name, *stations, network=None):
    doc = {"network": {"id": "net", **(network or {}), "stations": list(stations)}}
    (folder / name).write_text(json.dumps(doc, indent=4))
    return doc


def rows(spark, folder):
    docs = D.read_documents(spark, str(folder), S.STATION_DOCUMENT)
    return model.station_rows(D.readable(docs))


def test_pretty_printed_document(spark, tmp_path):
    capture(tmp_path, "a.json", station(), station(id="s2", free_bikes=0))
    got = {r.station_id: r for r in rows(spark, tmp_path).collect()}
    assert set(got) == {"s1", "s2"}
    first = got["s1"]
    assert first.station_name == first.address == "Main St"
    assert (first.free_bikes, first.slots, first.has_ebikes) == (3, 10, True)
    assert first.timestamp.isoformat() == "2025-10-21T12:34:56.123456"


@pytest.mark.parametrize("extra", ["absent", {}, None])
def test_missing_extra_gives_null(spark, tmp_path, extra):
    capture(tmp_path, "a.json", station(extra=extra))
    row = rows(spark, tmp_path).first()
    assert row.station_id == "s1" and row.has_ebikes is None and row.slots is None


def test_no_stations_no_rows(spark, tmp_path):
    capture(tmp_path, "a.json")
    assert rows(spark, tmp_path).count() == 0


def test_all_null_column_keeps_its_type(spark, tmp_path):
    capture(tmp_path, "a.json", station(latitude=None), station(id="s2", latitude=None))
    assert dict(rows(spark, tmp_path).dtypes)["latitude"] == "double"


def test_int_where_float_expected(spark, tmp_path):
    capture(tmp_path, "a.json", station(latitude=1), station(id="s2", latitude=1.25))
    assert sorted(r.latitude for r in rows(spark, tmp_path).collect()) == [1.0, 1.25]


def test_truncated_document_is_set_aside(spark, tmp_path):
    capture(tmp_path, "a.json", station())
    (tmp_path / "b.json").write_text('{"network": {"stations": [{"id": ')
    docs = D.read_documents(spark, str(tmp_path), S.STATION_DOCUMENT)
    assert [r.station_id for r in model.station_rows(D.readable(docs)).collect()] == ["s1"]
    bad, = D.damaged(docs).collect()
    assert bad._corrupt_record.startswith('{"network"') and bad._file.endswith("b.json")


def test_text_in_number_field(spark, tmp_path):
    capture(tmp_path, "a.json", station(free_bikes="x"), station(id="s2", free_bikes=4))
    docs = D.read_documents(spark, str(tmp_path), S.STATION_DOCUMENT)
    assert len(D.damaged(docs).collect()) == 1
    got = {r.station_id: (r.free_bikes, r.slots) for r in rows(spark, tmp_path).collect()}
    assert got == {"s1": (None, 10), "s2": (4, 10)}


def strict(spark, folder):
    docs = D.read_documents(spark, str(folder), S.STATION_DOCUMENT_TEXT)
    return model.strict_station_rows(D.readable(docs))


def test_strict_reads_the_same_rows(spark, tmp_path):
    capture(tmp_path, "a.json", station(), station(id="s2", name=None))
    columns = S.DIM_STATION.names
    loose = rows(spark, tmp_path).select(*columns)
    assert sorted(map(str, strict(spark, tmp_path).select(*columns).collect())) == \
        sorted(map(str, loose.collect()))


@pytest.mark.parametrize("changes, path", [
    ({"name": "absent"}, "name"),
    ({"extra": "absent"}, "extra.slots"),
    ({"extra": None}, "extra.has_ebikes"),
    ({"extra": {"has_ebikes": False}}, "extra.slots"),
])
def test_strict_fails_on_absent_field(spark, tmp_path, changes, path):
    capture(tmp_path, "a.json", station(**changes))
    with pytest.raises(PySparkException, match=path):
        strict(spark, tmp_path).collect()


def test_landing_keeps_earlier_files(spark, tmp_path):
    path = str(tmp_path / "landing")
    docs = spark.range(3).select(F.struct(F.col("id").cast("string")).alias("network"))
    D.land_documents(docs, path)
    D.land_documents(docs, path)
    stored = D.read_documents(spark, path, S.STATION_DOCUMENT, multi_line=False)
    assert len(stored.collect()) == 6


def test_landed_lines_read_like_captures(spark, tmp_path):
    (tmp_path / "in").mkdir()
    doc = capture(tmp_path / "in", "a.json", station(), station(id="s2", extra=None))
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text(json.dumps(doc) + "\n")
    lines = D.readable(D.read_documents(spark, str(tmp_path / "lines"), S.STATION_DOCUMENT,
                                        multi_line=False))
    columns = S.DIM_STATION.names
    assert sorted(map(str, model.station_rows(lines).select(*columns).collect())) == \
        sorted(map(str, rows(spark, tmp_path / "in").select(*columns).collect()))

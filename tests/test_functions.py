"""Timestamp spellings and missing fields."""

import pytest
from pyspark.sql import functions as F

from starflow.functions import (
    HOURLY_PATTERN,
    STATION_PATTERN,
    missing_fields,
    optional,
    parse_default,
    parse_hour,
    parse_pattern,
    parse_station_time,
)

BOTH_FAIL = [None, "", "soon", "2025-13-41T00:00"]


def value(spark, text, expr):
    row = spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("v")).first()
    return None if row.v is None else row.v.isoformat()


@pytest.mark.parametrize("text, by_pattern, by_default", [
    ("2025-10-21T12:34:56.123456+00:00Z", "2025-10-21T12:34:56.123456", None),
    ("2025-10-21T12:00:00.000000+02:00Z", "2025-10-21T10:00:00", None),
    ("2025-10-21T12:34:56.123456Z", None, "2025-10-21T12:34:56.123456"),
    ("2025-10-21T12:34:56+00:00", None, "2025-10-21T12:34:56"),
    ("2025-10-21T12:34:56.123456ZZ", "2025-10-21T12:34:56.123456", None),
    ("2025-10-21T12:34:56+00:00Z", None, None),
    ("2025-10-21 12:34:56", None, "2025-10-21T12:34:56"),
    *[(t, None, None) for t in BOTH_FAIL],
])
def test_station_spellings(spark, text, by_pattern, by_default):
    assert value(spark, text, lambda c: parse_pattern(c, STATION_PATTERN)) == by_pattern
    assert value(spark, text, parse_default) == by_default
    assert value(spark, text, parse_station_time) == (by_pattern or by_default)


@pytest.mark.parametrize("text, expected", [
    ("2025-10-21T05:00", "2025-10-21T05:00:00"),
    ("2025-10-21T05:00:00", None),
    ("2025-10-21", None),
])
def test_hourly_pattern(spark, text, expected):
    assert value(spark, text, lambda c: parse_pattern(c, HOURLY_PATTERN)) == expected
    if expected:
        assert value(spark, text, parse_hour) == expected


@pytest.mark.parametrize("text, expected", [
    ('{"a": 1, "b": {"c": 2}}', []),
    ('{"a": null, "b": {"c": null}}', []),
    ('{"b": {"c": 2}}', ["a"]),
    ('{"a": 1, "b": {}}', ["b.c"]),
    ('{"a": 1, "b": null}', ["b.c"]),
    ('{"a": 1}', ["b.c"]),
    (None, ["a", "b.c"]),
])
def test_missing_fields(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(missing_fields(F.col("t"), ["a", "b.c"]).alias("m")).first().m == expected


def test_optional_default(spark):
    df = spark.createDataFrame([((None,),), ((4,),)], "doc struct<k: int>")
    assert [r.k for r in df.select(optional("doc.k", 0).alias("k")).collect()] == [0, 4]

"""Declared schemas: raw documents, processed tables, warehouse tables.

Everything is declared, nothing inferred: no extra pass over the raw files, and
a column that is all NULL or mixes int and float in one batch stays typed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

TEXT, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
DOUBLE, BOOL, TIME = T.DoubleType(), T.BooleanType(), T.TimestampType()
NUMERIC = T.DecimalType(38, 12)  # wide, for columns declared without a precision


def fields(required: Sequence[str] = (), /, **types: T.DataType) -> T.StructType:
    """A struct type from ``name=type``; ``required`` columns are NOT NULL."""
    return T.StructType([T.StructField(n, t, n not in required) for n, t in types.items()])


def required(table: T.StructType) -> list[str]:
    """Names of the NOT NULL columns of a declared table."""
    return [f.name for f in table.fields if not f.nullable]


CORRUPT = "_corrupt_record"

# Only id, name, latitude, longitude, timestamp, free_bikes, extra.has_ebikes
# and extra.slots are always there; the rest is NULL when a feed lacks it.
STATION = fields(
    id=TEXT, name=TEXT, latitude=DOUBLE, longitude=DOUBLE, timestamp=TEXT,
    free_bikes=LONG, empty_slots=LONG,
    extra=fields(has_ebikes=BOOL, slots=LONG, ebikes=LONG, uid=TEXT, payment_terminal=BOOL,
                 virtual_station=BOOL, last_updated_epoch=LONG))

STATION_DOCUMENT = fields(network=fields(
    id=TEXT, name=TEXT, city=TEXT, country=TEXT, latitude=DOUBLE, longitude=DOUBLE,
    href=TEXT, gbfs_href=TEXT, stations=T.ArrayType(STATION)))

# Each station kept as its JSON text, so that an absent key can be told from an
# explicit null (see functions.fields.missing_fields).
STATION_DOCUMENT_TEXT = fields(network=fields(id=TEXT, stations=T.ArrayType(TEXT)))

HOURLY_DOCUMENT = fields(
    latitude=DOUBLE, longitude=DOUBLE, elevation=DOUBLE, utc_offset_seconds=LONG,
    timezone=TEXT,
    hourly=fields(
        time=T.ArrayType(TEXT), temperature_2m=T.ArrayType(DOUBLE),
        precipitation=T.ArrayType(DOUBLE), wind_speed_10m=T.ArrayType(DOUBLE),
        cloudcover=T.ArrayType(LONG), relativehumidity_2m=T.ArrayType(LONG)))

# Columns and types of the processed tables.
DIM_STATION = fields(
    station_id=TEXT, station_name=TEXT, latitude=DOUBLE, longitude=DOUBLE,
    address=TEXT, has_ebikes=BOOL, slots=LONG)
DIM_WEATHER = fields(
    weather_id=LONG, timestamp=TIME, temperature=DOUBLE, precipitation=DOUBLE,
    wind_speed=DOUBLE, cloud_cover=LONG, humidity=LONG)
FACT_BIKE_WEATHER = fields(
    station_id=TEXT, timestamp=TIME, free_bikes=LONG, slots=LONG, has_ebikes=BOOL,
    weather_id=LONG)

# What the loaded fact holds besides, where the documents have it.
FACT_EXTRAS = fields(empty_slots=LONG, ebikes=LONG)
LOADED_FACT = T.StructType([*FACT_BIKE_WEATHER.fields, *FACT_EXTRAS.fields])

# One line for everything a job could not use: the text of a damaged document, or a row.
REJECTED = fields(source=TEXT, reason=TEXT, content=TEXT, file=TEXT, modified=TIME)

# Columns and types of warehouse A (row store).
WAREHOUSE_STATION = fields(
    ["station_id"], station_id=TEXT, station_name=TEXT, latitude=NUMERIC,
    longitude=NUMERIC, address=TEXT, has_ebikes=BOOL, slots=INT)
WAREHOUSE_WEATHER = fields(
    ["weather_id", "timestamp"], weather_id=LONG, timestamp=TIME, temperature=NUMERIC,
    precipitation=NUMERIC, wind_speed=NUMERIC, cloud_cover=NUMERIC, humidity=NUMERIC)
WAREHOUSE_FACT = fields(
    ["fact_id", "timestamp"], fact_id=LONG, station_id=TEXT, weather_id=LONG,
    timestamp=TIME, free_bikes=INT, empty_slots=INT, total_slots=INT, ebikes=INT)
FACT_RENAMES = {"slots": "total_slots"}

# Columns and types of warehouse B (column store).
NETWORK = fields(
    ["id"], id=TEXT, name=TEXT, city=TEXT, country=TEXT, latitude=DOUBLE,
    longitude=DOUBLE, href=TEXT, gbfs_href=TEXT)
NETWORK_STATION = fields(
    ["station_id"], station_id=TEXT, network_id=TEXT, name=TEXT, latitude=DOUBLE,
    longitude=DOUBLE, uid=TEXT, total_slots=INT, payment_terminal=BOOL,
    virtual_station=BOOL)
STATION_STATUS = fields(
    ["status_id", "station_id"], status_id=LONG, station_id=TEXT, timestamp=TIME,
    free_bikes=INT, empty_slots=INT, last_updated_epoch=LONG)

# Declared text lengths of warehouse B.
NETWORK_LENGTHS = {"id": 255, "name": 500, "city": 255, "country": 2,
                   "href": 1000, "gbfs_href": 1000}
NETWORK_STATION_LENGTHS = {"station_id": 255, "network_id": 255, "name": 500, "uid": 100}
STATION_STATUS_LENGTHS = {"station_id": 255}

from starflow.functions.fields import missing_fields, optional
from starflow.functions.timestamps import (
    HOURLY_PATTERN,
    STATION_PATTERN,
    parse_default,
    parse_hour,
    parse_pattern,
    parse_station_time,
)

__all__ = ["HOURLY_PATTERN", "STATION_PATTERN", "missing_fields", "optional",
           "parse_default", "parse_hour", "parse_pattern", "parse_station_time"]

"""Timestamp parsing that yields NULL, never an aborted job, on a bad string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings used by the source documents.
STATION_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX'Z'"
HOURLY_PATTERN = "yyyy-MM-dd'T'HH:mm"

# Ending of every text that fits the station pattern, and of none that fits
# Spark's default rules: an offset and then one more Z.
_DATE_AND_TIME = r"^\s*\d{4}-\d{1,2}-\d{1,2}[T ]\d"
_OFFSET_AND_Z = r"(Z|[+-]\d\d:\d\d)Z$"


def parse_pattern(col: Column, pattern: str) -> Column:
    return F.try_to_timestamp(col, F.lit(pattern))


def parse_default(col: Column) -> Column:
    return F.try_to_timestamp(col)


def parse_station_time(col: Column) -> Column:
    """Station pattern or default rules, whichever can fit.

    Same values as trying both in turn.  But an attempt that fails throws
    inside Spark and costs about ten times one that fits, so the text's ending
    decides which single attempt is made.
    """
    return (F.when(col.rlike(_OFFSET_AND_Z), parse_pattern(col, STATION_PATTERN))
            .otherwise(parse_default(col)))


def parse_hour(col: Column) -> Column:
    """Hourly pattern or default rules, the latter only for text with a date and a time.

    By themselves the default rules also take a year or a month for a time.
    """
    return F.when(col.rlike(_DATE_AND_TIME), parse_default(col))

"""Raw documents made from the ``events`` table, in the shapes the job reads.

Each event becomes a document with two stations: its user's and its event
type's.  That is row by row, so nothing is collected; the few event types give
stations that each hold a large share of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


_K, _STAMP = "_k", "_stamp"  # taken from each event once, for both of its stations


def _station(key, name, lat, lon, has_ebikes) -> F.Column:
    k = F.col(_K)
    # Events of type "error" carry no extra block at all.
    extra = F.when(F.col("event_type") != "error", F.struct(
        has_ebikes.alias("has_ebikes"), k.alias("slots"), (k % 7).alias("ebikes"),
        F.concat(F.lit("uid-"), key).alias("uid"),
        F.col("event_id").alias("last_updated_epoch")))
    return F.struct(
        key.alias("id"), name.alias("name"), lat.alias("latitude"), lon.alias("longitude"),
        F.col(_STAMP).alias("timestamp"),
        F.floor("value").alias("free_bikes"),
        F.when(F.col("event_type") != "error", F.lit(100) - k).alias("empty_slots"),
        extra.alias("extra"))


def station_documents(events: DataFrame, *keep: str) -> DataFrame:
    user, kind = F.col("user_id"), F.col("event_type")
    none = F.lit(None).cast("double")
    by_user = _station(F.concat(F.lit("u"), user), F.concat(F.lit("user "), user),
                       user / F.lit(8.0), -user / F.lit(4.0), user > 50)
    by_kind = _station(F.concat(F.lit("t-"), kind), kind, none, none,
                       F.lit(None).cast("boolean"))
    network = F.struct(
        kind.alias("id"), F.upper(kind).alias("name"), F.lit("QX").alias("country"),
        F.concat(F.lit("/networks/"), kind).alias("href"),
        F.array(by_user, by_kind).alias("stations"))
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    taken = events.withColumns({_K: F.get_json_object("props", "$.k").cast("bigint"),
                                _STAMP: F.concat(stamp, F.lit("+00:00Z"))})
    return taken.select(network.alias("network"), *keep)


def damaged_documents(events: DataFrame) -> DataFrame:
    """Each event's station document as text: of type "error" cut off, of type "click" ill-typed."""
    whole = F.to_json(F.struct("network"))
    text = (F.when(F.col("event_type") == "error", F.substring(whole, 1, 60))
            .when(F.col("event_type") == "click", F.replace(whole, F.lit('"free_bikes":'), F.lit('"free_bikes":"x","was":')))
            .otherwise(whole))
    return station_documents(events, "event_type").select(text.alias("value"))


def _offset(day) -> F.Column:
    """Seconds that a day's times are ahead of UTC: none, two hours or minus four."""
    number = F.dayofmonth(day)
    return F.when(number % 3 == 0, 7200).when(number % 3 == 1, -14400).otherwise(0).cast("bigint")


def early_documents(events: DataFrame) -> DataFrame:
    """One document per day with the hours of the day after it, in values that turn out wrong.

    Land these first: each hour is then in two documents, and the later one counts.
    """
    return hourly_documents(events, error=1000)


def hourly_documents(events: DataFrame, error: int = 0) -> DataFrame:
    """One document per day, with parallel arrays of at most 24 hours in local time."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    hours = (events.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"))
             .agg((F.max("value") + error).alias("temperature"), F.min("value").alias("precipitation"),
                  (F.max(k) / 4.0).alias("wind"), F.count("*").alias("cloud"),
                  F.max(k).alias("humidity")))
    # Grouped by hour above, so a day has 24 rows at most.
    days = hours.groupBy(F.to_date("hour").alias("day")).agg(
        F.sort_array(F.collect_list(F.struct(*hours.columns))).alias("h"))
    offset = _offset(F.col("day"))
    stamps = F.transform("h", lambda r: F.date_format(
        F.timestamp_seconds(F.unix_seconds(r["hour"]) + offset), "yyyy-MM-dd'T'HH:mm"))
    return days.select(
        F.lit("GMT").alias("timezone"), offset.alias("utc_offset_seconds"),
        F.struct(stamps.alias("time"),
                 F.col("h.temperature").alias("temperature_2m"),
                 F.col("h.precipitation").alias("precipitation"),
                 F.col("h.wind").alias("wind_speed_10m"),
                 F.col("h.cloud").alias("cloudcover"),
                 F.col("h.humidity").alias("relativehumidity_2m")).alias("hourly"))

"""Station status and weather as streams over their landing directories.

Each batch is merged into the stored fact: a (station, timestamp) that is new is added, one that
comes again from a later file is corrected, and anything else changes nothing, however late it comes and
however the files are dealt to batches.  Weather may come before or after the statuses of its
hour.  Nothing is dropped: what has no key or does not parse goes to ``rejected``.  A batch becomes
visible as a whole, by one commit.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starflow import schemas as S
from starflow.operators.dedupe import latest_per_key
from starflow.operators.joins import aligned_join
from starflow.operators.quality import valid_rows
from starflow.operators.reshape import union_all
from starflow.plans.model import (
    FACT_KEY,
    ORIGIN,
    ORIGIN_FIELDS,
    REJECTED,
    merge_hours,
    rejected_documents,
    rejected_rows,
    station_rows_and_damage,
    status_rows,
    weather_hours,
    weather_rows,
)
from starflow.session import adaptive, prepare, scratch, stage, stateful
from starflow.sources import snapshots as N
from starflow.sources.documents import damaged, readable, stream_documents
from starflow.sources.facts import FactTable

BatchWriter = Callable[[DataFrame, int], None]

STATUS = T.StructType([f for f in S.FACT_BIKE_WEATHER.fields if f.name != "weather_id"])
ENRICHED = T.StructType([*STATUS.fields, S.FACT_BIKE_WEATHER["weather_id"]])
FACT = FactTable("fact", ENRICHED, FACT_KEY, ORIGIN_FIELDS, ["weather_id"])
_LATEST = T.StructType([*ENRICHED.fields, *ORIGIN_FIELDS.fields])
_REJECTED = T.StructType([*S.REJECTED.fields, T.StructField("query", T.StringType()),
                          T.StructField("batch_id", T.LongType())])
#: An hour's columns in a row of ``with_weather`` that is not a status.
HOUR, DAMAGE = "_hour", "_hours_damage"
_HOUR_FIELDS = T.StructType([f for f in S.DIM_WEATHER.fields if f.name != "weather_id"])
#: Parts of ``latest`` that a reader merges at most.
LATEST_PARTS = 8


def status_stream(spark: SparkSession, landing: str, multi_line: bool = True,
                  max_files: int | None = None) -> DataFrame:
    """Status rows of the documents that land, with their origin, and damaged documents."""
    prepare(spark)
    docs = stream_documents(spark, landing, S.STATION_DOCUMENT, multi_line, max_files)
    return status_rows(station_rows_and_damage(docs), *ORIGIN, S.CORRUPT)


def weather_stream(spark: SparkSession, landing: str, multi_line: bool = True,
                   max_files: int | None = None) -> DataFrame:
    """The hours of the documents that land, with their origin, and damaged documents."""
    prepare(spark)
    docs = stream_documents(spark, landing, S.HOURLY_DOCUMENT, multi_line, max_files)
    hours = weather_rows(readable(docs)).select(*_HOUR_FIELDS.names, "time", *ORIGIN, F.lit(None).cast("string").alias(S.CORRUPT))
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in _HOUR_FIELDS.fields]
    return hours.unionByName(damaged(docs).select(*none, F.lit(None).cast("string").alias("time"), *ORIGIN, S.CORRUPT))


def enrich_stream(status: DataFrame, weather: DataFrame) -> DataFrame:
    """Stream-static left join to a weather table that does not change, by hour.

    The table is read anew in each batch from the folder it was opened from.  For one that loads keep
    changing give ``keyed_writer`` a function that opens the newest.
    """
    keys = weather.select("weather_id", "timestamp")
    return aligned_join(status, keys, "timestamp")


def with_weather(status: DataFrame, weather: DataFrame, delay: str = "1 hour", salts: int = 8) -> DataFrame:
    """Left join of two streams, by hour; give the result to ``joined_writer``.

    A status waits in the state until its hour's weather comes, or until the weather's watermark, which is
    ``delay`` behind its newest hour, has passed the hour: then it goes on without.  The hours go on too, so
    that weather beyond the watermark still reaches the table and the stored rows that lack it.  Statuses
    have no watermark, as that would drop late ones; a late one goes on at once.  The statuses of an hour are
    dealt over ``salts`` parts by station, with a copy of the hour for each.
    """
    whole = F.col(S.CORRUPT).isNull() & F.col("station_id").isNotNull() & F.col("timestamp").isNotNull()
    # What is not whole is no side stream, which would read and parse the documents again: the join lets it
    # pass at once, without a place in the state.  It is dealt by all it has, as its station is often missing.
    by = F.when(whole, F.xxhash64("station_id")).otherwise(F.xxhash64(*status.columns))
    part = F.pmod(by, F.lit(salts)).cast("int")
    hours = weather.where(F.col("timestamp").isNotNull() & F.col(S.CORRUPT).isNull()).select(
        F.date_trunc("hour", F.col("timestamp")).alias("_known"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_copy")).withWatermark("_known", delay)
    same = (part == F.col("_copy")) & (F.date_trunc("hour", F.col("timestamp")) == F.col("_known"))
    found = status.join(hours, whole & same, "left")
    hour = F.struct(*_HOUR_FIELDS.names)
    none = F.lit(None).cast(weather.select(hour.alias("h")).schema["h"].dataType)
    text = F.lit(None).cast("string")
    no_status = [F.lit(None).cast(f.dataType).alias(f.name) for f in STATUS.fields]
    return found.select(*status.columns, none.alias(HOUR), text.alias("time"), text.alias(DAMAGE)).unionByName(
        weather.select(*no_status, *ORIGIN, text.alias(S.CORRUPT), F.when(F.col(S.CORRUPT).isNull(), hour).alias(HOUR),
                       "time", F.col(S.CORRUPT).alias(DAMAGE)))


def keyed_writer(out: str, weather: Callable[[], DataFrame] | None = None, compact_every: int = 50,
                 keep: int = 10) -> BatchWriter:
    """Writer for ``foreachBatch``: merge into ``fact`` and ``latest``, keep the rest in ``rejected``.

    A batch that is replayed, or split otherwise, changes nothing, and an older row never replaces a
    newer one.  ``weather`` opens the weather table of the moment for each batch.  Every
    ``compact_every`` batches the small files of the days are rewritten.
    """
    def merge(load: N.Load, rows: DataFrame, query: str, number: int) -> None:
        _merge_status(load, rows, query, number, weather() if weather is not None else None)

    return _writer(out, merge, compact_every, keep)


def joined_writer(out: str, compact_every: int = 50, keep: int = 10) -> BatchWriter:
    """Writer for the rows of ``with_weather``: also keeps ``dim_weather``, and fills what weather came too late for."""
    def merge(load: N.Load, rows: DataFrame, query: str, number: int) -> None:
        hours = rows.where(F.col(HOUR).isNotNull()).select(f"{HOUR}.*", "time", *ORIGIN)
        broken = rows.where(F.col(DAMAGE).isNotNull()).withColumn(S.CORRUPT, F.col(DAMAGE))
        lines = [rejected_documents("hours", broken), rejected_rows("hours", hours, ["timestamp"])]
        newest = stage(weather_hours(hours), "hours")
        if not newest.isEmpty():
            weather, days = merge_hours(load, newest)
            changed = FACT.fill(load, days, lambda facts: _with_ids(facts, weather))
            if changed is not None:
                _add_latest(load, changed.select(*_LATEST.names))
        else:
            weather = load.state.table(load.spark, "dim_weather", S.DIM_WEATHER)
        status = rows.where(F.col(HOUR).isNull() & F.col(DAMAGE).isNull()).drop(HOUR, DAMAGE, "time")
        _merge_status(load, status, query, number, weather, lines)

    return _writer(out, merge, compact_every, keep)


def _writer(out: str, merge, compact_every: int, keep: int) -> BatchWriter:
    def commit(spark: SparkSession, rows: DataFrame, query: str, number: int) -> None:
        for attempt in range(20):
            try:
                with N.load(spark, out, keep) as load:
                    merge(load, rows, query, number)
                    if compact_every and number % compact_every == compact_every - 1:
                        FACT.compact(load)
                return
            except N.CommitConflict:
                # Another query on the same tables was first: merge into what it left.
                time.sleep(0.1 * attempt)
        raise N.CommitConflict(out)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        with scratch(spark):
            rows = stage(batch, "batch")  # read several times below
            with adaptive(spark):
                commit(spark, rows, query, number)

    return write


def _with_ids(status: DataFrame, weather: DataFrame) -> DataFrame:
    return aligned_join(status, weather.select("weather_id", "timestamp"), "timestamp")


def _merge_status(load: N.Load, rows: DataFrame, query: str, number: int, weather: DataFrame | None,
                  lines: list[DataFrame] | None = None) -> None:
    whole = rows.where(F.col(S.CORRUPT).isNull()).drop(S.CORRUPT)
    left = union_all([rejected_documents("stations", rows.where(F.col(S.CORRUPT).isNotNull())),
                      rejected_rows("stations", whole, FACT_KEY), *(lines or [])])
    left = stage(left.withColumns({"query": F.lit(query), "batch_id": F.lit(number).cast("bigint")}), "left")
    if not left.isEmpty():
        # The same batch again replaces its lines.
        load.add(REJECTED, f"{query}-{number}", left.select(*_REJECTED.names))
    good = valid_rows(whole, not_null=FACT_KEY)
    if weather is not None:
        good = _with_ids(good.drop("weather_id"), weather)
    elif "weather_id" not in good.columns:
        good = good.withColumn("weather_id", F.lit(None).cast("bigint"))
    FACT.merge(load, good)
    _add_latest(load, good.select(*_LATEST.names))


def _newest(rows: DataFrame) -> DataFrame:
    plain = [c for c in STATUS.names if c not in FACT_KEY]
    columns = ["station_id", "timestamp", *ORIGIN, *plain, "weather_id"]
    return latest_per_key(rows.select(*columns), ["station_id"], columns[1:]).select(*_LATEST.names)


def _add_latest(load: N.Load, rows: DataFrame) -> None:
    """The newest row of each station of a batch, beside those before; merged when there are many."""
    before = load.state.parts.get("latest", {})
    if len(before) + 1 > LATEST_PARTS:
        rows = rows.unionByName(load.state.rows(load.spark, "latest", _LATEST))
        for key in list(before):
            load.drop_parts("latest", key)
    load.add("latest", f"{load.number:012d}-{len(load.state.parts.get('latest', {}))}", _newest(rows))


def start(stream: DataFrame, writer: BatchWriter, checkpoint: str,
          once: bool = True) -> StreamingQuery:
    """Run the stream; ``once`` takes what has landed and ends."""
    sink = stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    with stateful(stream.sparkSession):
        return (sink.trigger(availableNow=True) if once else sink).start()


def _dated(schema: T.StructType) -> list[str | Column]:
    return [*schema.names, "date"]


def read_fact(spark: SparkSession, out: str, schema: T.StructType = STATUS) -> DataFrame:
    """All status rows as corrected, of ``schema`` (``ENRICHED`` after an enriched stream), by ``date``."""
    return FACT.read(spark, N.read_snapshot(spark, out)).select(*_dated(schema))


def read_latest(spark: SparkSession, out: str, schema: T.StructType = STATUS) -> DataFrame:
    """Newest row per station as of the last finished batch."""
    rows = N.read_snapshot(spark, out).rows(spark, "latest", _LATEST)
    return _newest(rows).select(*schema.names)


def read_weather(spark: SparkSession, out: str) -> DataFrame:
    """The weather that ``joined_writer`` has stored."""
    return N.read_snapshot(spark, out).table(spark, "dim_weather", S.DIM_WEATHER)


def read_rejected(spark: SparkSession, out: str) -> DataFrame:
    """What could not be used, by query and batch."""
    return N.read_snapshot(spark, out).rows(spark, REJECTED, _REJECTED)


def refill_weather(spark: SparkSession, out: str, weather: DataFrame, days: list) -> None:
    """Give rows of ``days`` that were stored before their weather the key it has now."""
    with N.load(spark, out) as load, scratch(spark):
        changed = FACT.fill(load, days, lambda facts: _with_ids(facts, weather))
        if changed is not None:
            _add_latest(load, changed.select(*_LATEST.names))

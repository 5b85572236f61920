"""Table builders: raw documents to dimensions and facts, and the whole job."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow import schemas as S
from starflow.functions import optional, parse_hour, parse_station_time
from starflow.operators.asof import asof_join
from starflow.operators.changes import CHANGE, version_changes
from starflow.operators.dedupe import latest_per_key, only_latest
from starflow.operators.joins import aligned_join, left_enrich
from starflow.operators.keys import dense_key
from starflow.operators.merge import insert_keyed, upsert
from starflow.operators.quality import (
    checked,
    conform,
    fk_orphans,
    misfits,
    observed,
    quarantined_rows,
    valid_rows,
)
from starflow.operators.reshape import (
    copy_column,
    rename,
    strict_rows,
    union_all,
    unnest,
    zip_arrays,
)
from starflow.session import prepare, scratch, stage, together
from starflow.sources import documents as D
from starflow.sources import jdbc as J
from starflow.sources import ledger as G
from starflow.sources import snapshots as N
from starflow.sources import tables as W
from starflow.sources.facts import FactTable

# Output column of each hourly array of the source document.
HOURLY_ARRAYS = {
    "time": "hourly.time",
    "temperature": "hourly.temperature_2m",
    "precipitation": "hourly.precipitation",
    "wind_speed": "hourly.wind_speed_10m",
    "cloud_cover": "hourly.cloudcover",
    "humidity": "hourly.relativehumidity_2m",
}
# Fields every station must have in strict mode.
STRICT_FIELDS = ["id", "name", "latitude", "longitude", "timestamp", "free_bikes",
                 "extra.has_ebikes", "extra.slots"]
NETWORK_ID = "network_id"
FACT_KEY = ["station_id", "timestamp"]
ORIGIN = [D.MODIFIED, D.FILE]  # a later file replaces an earlier one
_OFFSET, _ZONED = "_utc_offset", r"(Z|[+-]\d\d:?\d\d)\s*$"
REJECTED, TAKEN = "rejected", "taken_files"
ORIGIN_FIELDS = S.fields(**{D.MODIFIED: S.TIME, D.FILE: S.TEXT})
#: The facts that loads keep; their numbers are handed out once and stay.
FACT = FactTable("fact_bike_weather", S.LOADED_FACT, FACT_KEY, ORIGIN_FIELDS, ["weather_id"], "fact_id")
STATION_STATUS = FactTable(
    "fact_station_status", T.StructType([f for f in S.STATION_STATUS.fields if f.name != "status_id"]),
    FACT_KEY, ORIGIN_FIELDS, number="status_id")
_HEAD, _STATION = "_head", "_station"
ROW = "row_number"  # tells copies of a stored status row apart


def station_rows(docs: DataFrame) -> DataFrame:
    """One typed row per station and document, with its origin; missing fields are NULL."""
    rows = unnest(docs, "network.stations", keep=_kept(docs))
    return _flat_stations(rows)


def _kept(docs: DataFrame) -> list:
    return [F.col("network.id").alias(NETWORK_ID), *[c for c in ORIGIN if c in docs.columns]]


def station_rows_and_damage(docs: DataFrame) -> DataFrame:
    """``station_rows``, and a row with the text in ``_corrupt_record`` for each damaged document."""
    return _flat_stations(D.objects_and_damage(docs, "network.stations", keep=_kept(docs)))


def strict_station_rows(docs: DataFrame) -> DataFrame:
    """``station_rows`` over ``STATION_DOCUMENT_TEXT`` that fails on an absent field."""
    rows = strict_rows(docs, "network.stations", S.STATION, STRICT_FIELDS, keep=_kept(docs))
    return _flat_stations(rows)


def _flat_stations(rows: DataFrame) -> DataFrame:
    flat = rows.withColumns({
        "timestamp": parse_station_time(F.col("timestamp")),
        "has_ebikes": optional("extra.has_ebikes"),
        "slots": optional("extra.slots"),
        "ebikes": optional("extra.ebikes"),
        "uid": optional("extra.uid"),
        "payment_terminal": optional("extra.payment_terminal"),
        "virtual_station": optional("extra.virtual_station"),
        "last_updated_epoch": optional("extra.last_updated_epoch"),
    }).drop("extra")
    named = rename(flat, {"id": "station_id", "name": "station_name"})
    return copy_column(named, "station_name", "address")


def dim_station(stations: DataFrame) -> DataFrame:
    columns = S.DIM_STATION.names
    rows = stations.select(*columns, "timestamp").where(F.col("station_id").isNotNull())
    return latest_per_key(rows, ["station_id"], ["timestamp"]).select(*columns)


def weather_rows(docs: DataFrame) -> DataFrame:
    """One row per hour of each hourly document, with the time as text and in UTC.

    Times are local by ``utc_offset_seconds`` unless they name their own offset.
    """
    rows = zip_arrays(docs, HOURLY_ARRAYS, keep=[*ORIGIN, F.col("utc_offset_seconds").alias(_OFFSET)])
    ahead = F.when(F.col("time").rlike(_ZONED), F.lit(0)).otherwise(F.coalesce(_OFFSET, F.lit(0)))
    utc = F.timestamp_micros(F.unix_micros(parse_hour(F.col("time"))) - ahead * 1_000_000)
    return rows.withColumn("timestamp", utc).drop(_OFFSET)


def weather_hours(rows: DataFrame, *extra: str) -> DataFrame:
    """One row per hour: where forecasts overlap, the newest file wins."""
    columns = [*[c for c in S.DIM_WEATHER.names if c != "weather_id"], *extra]
    dated = rows.select(*columns, *ORIGIN).where(F.col("timestamp").isNotNull())
    return latest_per_key(dated, ["timestamp"], ORIGIN).select(*columns)


def dim_weather(rows: DataFrame, start: int = 1, keep_time: bool = False) -> DataFrame:
    """Numbered hours; ``keep_time`` adds the source's own spelling of the time."""
    extra = ["time"] if keep_time else []
    keyed = dense_key(weather_hours(rows, *extra), "weather_id", ["timestamp"], start=start)
    return keyed.select(*S.DIM_WEATHER.names, *extra)


def status_rows(stations: DataFrame, *extra: str) -> DataFrame:
    return stations.select("station_id", "timestamp", "free_bikes", "slots", "has_ebikes", *extra)


def fact_bike_weather(status: DataFrame, weather: DataFrame, align: str = "exact") -> DataFrame:
    """Status rows with the key of their weather row.

    ``exact`` matches equal timestamps, ``hour`` the hour a status falls in and
    ``asof`` the newest observation at or before it.
    """
    keys = weather.select("weather_id", "timestamp")
    if align == "exact":
        joined = left_enrich(status, keys, "timestamp")
    elif align == "hour":
        joined = aligned_join(status, keys, "timestamp")
    elif align == "asof":
        joined = asof_join(status, rename(keys, {"timestamp": "observed_at"}),
                           "timestamp", "observed_at")
    else:
        raise ValueError(f"align must be exact, hour or asof, not {align!r}")
    names = S.FACT_BIKE_WEATHER.names
    return joined.select(*names, *[c for c in status.columns if c not in names])


def network_rows(docs: DataFrame) -> DataFrame:
    """A row for each document's network, with its origin."""
    return docs.select(*[F.col(f"network.{c}").alias(c) for c in S.NETWORK.names], *ORIGIN)


def dim_network(docs: DataFrame) -> DataFrame:
    """The networks that have an id, by the newest file; ``network_rows`` has the others too."""
    return newest_networks(network_rows(docs))


def newest_networks(rows: DataFrame) -> DataFrame:
    rows = rows.where(F.col("id").isNotNull())
    return conform(latest_per_key(rows, ["id"], ORIGIN), S.NETWORK)


def _flat_documents(docs: DataFrame) -> DataFrame:
    """A row for each station, typed, and one for a document without any.

    The first row of a document has its network and, if it did not parse in full, its text; whether
    a row has a station or is such a first one is in ``_station`` and ``_head``.
    """
    head = F.coalesce(F.col("pos"), F.lit(0)) == 0
    network = F.struct(*(F.col(f"network.{c}").alias(c) for c in S.NETWORK.names))
    parts = docs.select(*ORIGIN, S.CORRUPT, network.alias("network"), F.col("network.stations").alias("stations"))
    rows = parts.select(*ORIGIN, S.CORRUPT, "network", F.posexplode_outer("stations"))
    rows = rows.select(
        F.col("network.id").alias(NETWORK_ID), *ORIGIN, "col.*", F.col("pos").isNotNull().alias(_STATION), head.alias(_HEAD),
        F.when(head, F.col("network")).alias("network"), F.when(head, F.col(S.CORRUPT)).alias(S.CORRUPT))
    return _flat_stations(rows).drop("address", "has_ebikes", "ebikes")


def dim_network_station(stations: DataFrame) -> DataFrame:
    renames = {"station_name": "name", "slots": "total_slots"}
    columns = ["station_id", NETWORK_ID, "station_name", "latitude", "longitude", "uid",
               "slots", "payment_terminal", "virtual_station", "timestamp"]
    rows = stations.select(*columns).where(F.col("station_id").isNotNull())
    newest = latest_per_key(rows, ["station_id"], ["timestamp"])
    return conform(newest, S.NETWORK_STATION, renames)


def fact_station_status(stations: DataFrame, start: int = 1) -> DataFrame:
    """Status rows numbered in time order; the same range shuffle clusters them by time.

    ``stations`` may hold a column ``row_number`` that tells copies of a row apart, such as the
    place in the scanned files; without it copies are numbered and stored here.
    """
    columns = ["station_id", "timestamp", "free_bikes", "empty_slots", "last_updated_epoch"]
    numbered = [ROW] if ROW in stations.columns else []
    rows = valid_rows(stations.select(*columns, *numbered), not_null=["station_id"])
    keyed = dense_key(rows, "status_id", ["timestamp", "station_id", *numbered], start=start,
                      unique_order=bool(numbered))
    return conform(keyed, S.STATION_STATUS)


def rejected_rows(source: str, rows: DataFrame, not_null: list[str]) -> DataFrame:
    """Rows without a needed value, as lines of the table of what could not be used."""
    content = [c for c in rows.columns if c not in (*ORIGIN, ROW)]
    return quarantined_rows(rows, not_null=not_null).select(
        F.lit(source).alias("source"), F.array_join("violations", ", ").alias("reason"),
        F.to_json(F.struct(*content)).alias("content"), F.col(D.FILE).alias("file"),
        F.col(D.MODIFIED).alias("modified"))


def rejected_documents(source: str, damaged: DataFrame) -> DataFrame:
    """Documents that did not parse in full, as lines of the same table."""
    return damaged.select(
        F.lit(source).alias("source"), F.lit("document does not parse in full").alias("reason"),
        F.col(S.CORRUPT).alias("content"), F.col(D.FILE).alias("file"),
        F.col(D.MODIFIED).alias("modified"))


def unusable(stations: DataFrame, weather: DataFrame, damaged_hours: DataFrame) -> DataFrame:
    """All that a load leaves aside: damaged documents, statuses and hours without a key."""
    whole = stations.where(F.col(S.CORRUPT).isNull()).drop(S.CORRUPT)
    return union_all([
        rejected_documents("stations", stations.where(F.col(S.CORRUPT).isNotNull())),
        rejected_documents("hours", damaged_hours),
        rejected_rows("stations", whole, FACT_KEY),
        rejected_rows("hours", weather, ["timestamp"])])


def warehouse_fact(fact: DataFrame, start: int = 1) -> DataFrame:
    """The fact in the warehouse's declared columns (``slots`` becomes ``total_slots``).

    ``fact`` holds each station and timestamp once, as ``load_tables`` leaves it.  Rows that have their
    number already keep it; others are numbered here, in the order of time.
    """
    keyed = fact if "fact_id" in fact.columns else dense_key(
        fact, "fact_id", ["timestamp", "station_id"], start=start)
    return conform(keyed, S.WAREHOUSE_FACT, S.FACT_RENAMES)


def build_tables(spark: SparkSession, stations_path: str, hourly_path: str, out: str,
                 align: str = "hour", multi_line: bool = True, strict: bool = False) -> str:
    """Raw documents to Parquet tables in a new version below ``out``; returns its path.

    The keyed dimension is stored first and read back, so the fact uses the very keys that
    are stored.  The version counts as finished only when all its tables are there, so a
    reader of ``processed_path`` never sees tables of two runs, and runs at the same time build a
    version each.  What could not be used is in its table ``rejected``; ``strict`` fails instead, on
    damaged documents and on absent fields.
    """
    prepare(spark)
    version = W.claim_version(spark, out)
    path = W.version_path(out, version)
    with scratch(spark):
        def store_weather() -> tuple[DataFrame, DataFrame, DataFrame]:
            parsed, damaged = _parsed_weather(spark, hourly_path, multi_line, strict)
            W.replace_table(dim_weather(parsed), f"{path}/dim_weather")
            return W.read_table(spark, f"{path}/dim_weather", S.DIM_WEATHER), parsed, damaged

        stations, (weather, parsed, damaged) = together(
            spark, lambda: _parsed_stations(spark, stations_path, multi_line, strict), store_weather)
        whole = stations.where(F.col(S.CORRUPT).isNull())
        fact = fact_bike_weather(status_rows(whole, ROW), weather, align)
        together(
            spark,
            lambda: W.replace_table(dim_station(whole), f"{path}/dim_station"),
            lambda: W.replace_table(unusable(stations, parsed, damaged), f"{path}/{REJECTED}"),
            lambda: W.write_by_date(_placed(fact, align), f"{path}/fact_bike_weather", "date",
                                    FACT_KEY, mode="overwrite", spread=ROW))
    W.finish_version(spark, out, version)
    W.drop_versions(spark, out)
    return path


def processed_path(spark: SparkSession, out: str) -> str:
    """Folder of the tables of the newest finished ``build_tables``."""
    return W.version_path(out, W.latest_version(spark, out))


def _parsed_stations(spark: SparkSession, path: str | list[str], multi_line: bool, strict: bool,
                     modified_after: str | None = None) -> DataFrame:
    """Stored station rows, and a row for each damaged document."""
    schema = S.STATION_DOCUMENT_TEXT if strict else S.STATION_DOCUMENT
    docs = D.read_documents(spark, path, schema, multi_line, modified_after)
    if strict:
        _fail_on_damage(docs)
        rows = strict_station_rows(D.readable(docs)).withColumn(S.CORRUPT, F.lit(None).cast("string"))
    else:
        rows = station_rows_and_damage(docs)
    columns = [*S.DIM_STATION.names, "timestamp", "free_bikes", *S.FACT_EXTRAS.names, *ORIGIN, S.CORRUPT]
    # Several tables come from these rows: parse the JSON once.
    return stage(rows.select(*columns, F.monotonically_increasing_id().alias(ROW)), "stations")


def _fail_on_damage(docs: DataFrame) -> None:
    broken = D.damaged(docs).limit(1).collect()
    if broken:
        raise ValueError(f"a document does not parse in full: {broken[0][D.FILE]}")


def _parsed_weather(spark: SparkSession, path: str | list[str], multi_line: bool, strict: bool = False,
                    modified_after: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Stored rows of the hours, and the damaged documents."""
    docs = D.read_documents(spark, path, S.HOURLY_DOCUMENT, multi_line, modified_after)
    if strict:
        _fail_on_damage(docs)
    return stage(weather_rows(D.readable(docs)), "hour_rows"), D.damaged(docs)


def _placed(fact: DataFrame, align: str) -> DataFrame:
    """The fact with its date.  Writers read it twice, so a costly join is stored first."""
    dated = W.with_date(fact)
    return stage(dated, "fact") if align == "asof" else dated


def load_tables(spark: SparkSession, stations_path: str, hourly_path: str, warehouse: str,
                align: str = "hour", multi_line: bool = True, strict: bool = False,
                modified_after: str | None = None, ledger: bool = False) -> N.Snapshot:
    """Merge the documents of a landing directory into the warehouse tables.

    Dimensions are upserted, weather hours keep the key they once got, and the fact takes what it
    lacks: a rerun changes nothing.  Of the payloads for one station and time the latest file's
    counts, whether they come in one load or in several.  Rows stored before their hour was known get its
    key when it comes.  A fact row's number is handed out when it is stored and never changes.
    What a run could not use is added to ``rejected``; ``strict`` fails instead.

    All tables change at once, by the commit at the end.  Of two loads at the same time the second one to
    finish stops with ``CommitConflict`` and leaves nothing behind; run it again.

    With ``ledger`` each file is taken once, whatever its time: the files taken are kept with the tables, by
    path, length and time.  With ``modified_after`` only files written since are read; overlap
    does no harm.  Either way a run costs what is new rather than all that ever landed.
    """
    prepare(spark)
    with N.load(spark, warehouse) as load, scratch(spark):
        if ledger:
            seen = load.base.rows(spark, TAKEN, G.FILES)
            new = stage(G.untaken(spark, {"stations": stations_path, "hours": hourly_path}, seen, modified_after), "new-files")
            load.add(TAKEN, f"{load.number:012d}", new)
            taken = G.paths(new)
            stations_path, hourly_path, modified_after = taken.get("stations", []), taken.get("hours", []), None

        def merge_weather() -> tuple[DataFrame, list, DataFrame, DataFrame]:
            parsed, damaged = _parsed_weather(spark, hourly_path, multi_line, strict, modified_after)
            hours = stage(weather_hours(parsed), "hours")
            weather, days = merge_hours(load, hours)
            return weather, days, parsed, damaged

        stations, (weather, days, parsed, damaged) = together(
            spark,
            lambda: _parsed_stations(spark, stations_path, multi_line, strict, modified_after),
            merge_weather)
        whole = stations.where(F.col(S.CORRUPT).isNull())
        newest = stage(dim_station(whole), "newest_stations")
        together(
            spark,
            lambda: load.replace("dim_station", upsert(
                load.base.table(spark, "dim_station", S.DIM_STATION), newest, ["station_id"]), _watch(["station_id"])),
            lambda: load.add(REJECTED, f"{load.number:012d}", unusable(stations, parsed, damaged)))
        # Both dimensions are stored by now, so no fact row ever lacks its parents.
        if days and align == "asof":
            # A new hour counts for all later rows up to the next one.
            days = [d for d in FACT.days(load.state) if d >= min(days)]
        FACT.fill(load, days, lambda rows: fact_bike_weather(rows, weather, align))
        status = valid_rows(status_rows(whole, *S.FACT_EXTRAS.names, *ORIGIN), not_null=FACT_KEY)
        FACT.merge(load, fact_bike_weather(status, weather, align))
    return load.state


def merge_hours(load: N.Load, hours: DataFrame) -> tuple[DataFrame, list]:
    """Merge hours, one row each, into ``dim_weather``; the table and the days that got new hours."""
    target = load.state.table(load.spark, "dim_weather", S.DIM_WEATHER)
    fresh = hours.join(target.select("timestamp"), "timestamp", "left_anti")
    # One value for each calendar day with an hour that was not known.
    days = [r[0] for r in fresh.select(F.to_date("timestamp")).distinct().collect()]
    merged = insert_keyed(target, hours, ["timestamp"], "weather_id")
    return load.replace("dim_weather", merged, _watch(S.required(S.WAREHOUSE_WEATHER))), days


def _watch(not_null: list[str], max_length: dict[str, int] | None = None):
    return lambda df: observed(df, not_null, max_length)


def read_station(spark: SparkSession, warehouse: str) -> DataFrame:
    return N.read_snapshot(spark, warehouse).table(spark, "dim_station", S.DIM_STATION)


def read_weather(spark: SparkSession, warehouse: str) -> DataFrame:
    return N.read_snapshot(spark, warehouse).table(spark, "dim_weather", S.DIM_WEATHER)


def read_fact(spark: SparkSession, warehouse: str, days: list | None = None) -> DataFrame:
    """The fact as corrected, with its numbers; of some days only their files are read."""
    rows = FACT.read(spark, N.read_snapshot(spark, warehouse), days)
    return rows.select("fact_id", *S.LOADED_FACT.names, "date")


def read_rejected(spark: SparkSession, warehouse: str) -> DataFrame:
    """What loads could not use."""
    return N.read_snapshot(spark, warehouse).rows(spark, REJECTED, S.REJECTED)


def compact_tables(spark: SparkSession, warehouse: str, **settings) -> list[str]:
    """Fold corrections and small files of the facts into files of a good size; returns the days."""
    prepare(spark)
    with N.load(spark, warehouse) as load, scratch(spark):
        return sorted({d for table in (FACT, STATION_STATUS) for d in table.compact(load, **settings)})


def load_network_tables(spark: SparkSession, stations_path: str, warehouse: str, multi_line: bool = True,
                        modified_after: str | None = None) -> N.Snapshot:
    """Merge the documents of a landing directory into the network tables.

    Networks and stations are upserted, and status rows added, or corrected by later files; their numbers stay.
    Networks and statuses without an id, damaged documents and values that a declared type cannot
    hold are lines in ``rejected``.  A status without a time is kept, once for each station.
    """
    prepare(spark)
    with N.load(spark, warehouse) as load, scratch(spark):
        docs = D.read_documents(spark, stations_path, S.STATION_DOCUMENT, multi_line, modified_after)
        # All tables come from these rows: the JSON and its times are parsed and unnested once.
        rows = stage(_flat_documents(docs), "documents")
        damaged = F.col(S.CORRUPT).isNotNull()
        networks = rows.where(F.col(_HEAD) & ~damaged).select("network.*", *ORIGIN)
        stations = rows.where(_STATION)
        declared = STATION_STATUS.columns
        status = stations.select(*declared.names, *ORIGIN)
        wide = misfits(status, declared).select(
            F.lit("stations").alias("source"), F.array_join("violations", ", ").alias("reason"),
            F.to_json(F.struct(*declared.names)).alias("content"),
            F.col(D.FILE).alias("file"), F.col(D.MODIFIED).alias("modified"))
        left = union_all([
            rejected_documents("stations", rows.where(damaged)), rejected_rows("networks", networks, ["id"]),
            rejected_rows("stations", status, ["station_id"]), wide])
        together(
            spark,
            lambda: load.replace("dim_network", upsert(
                load.base.table(spark, "dim_network", S.NETWORK),
                stage(newest_networks(only_latest(networks, ["id"], D.MODIFIED)), "networks"), ["id"]),
                _watch(S.required(S.NETWORK), S.NETWORK_LENGTHS)),
            lambda: load.replace("dim_network_station", upsert(
                load.base.table(spark, "dim_network_station", S.NETWORK_STATION),
                stage(dim_network_station(only_latest(stations, ["station_id"], "timestamp")), "network-stations"), ["station_id"]),
                _watch(S.required(S.NETWORK_STATION), S.NETWORK_STATION_LENGTHS)),
            lambda: load.add(REJECTED, f"{load.number:012d}", left))
        fits = status.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in declared.fields], *ORIGIN)
        STATION_STATUS.merge(load, valid_rows(fits, not_null=["station_id"]))
    return load.state


def read_network_tables(spark: SparkSession, warehouse: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Networks, stations and statuses, of one state of the warehouse."""
    state = N.read_snapshot(spark, warehouse)
    status = STATION_STATUS.read(spark, state).select(*S.STATION_STATUS.names)
    return (state.table(spark, "dim_network", S.NETWORK),
            state.table(spark, "dim_network_station", S.NETWORK_STATION), status)


def undeclared(df: DataFrame, table: T.StructType,
               lengths: dict[str, int] | None = None) -> DataFrame:
    """Rows that break the declared NOT NULLs or text lengths of a table."""
    return quarantined_rows(df, not_null=S.required(table), max_length=lengths)


def warehouse_station(dim: DataFrame) -> DataFrame:
    return conform(dim, S.WAREHOUSE_STATION)


def warehouse_weather(dim: DataFrame) -> DataFrame:
    return conform(dim, S.WAREHOUSE_WEATHER)


def load_jdbc(spark: SparkSession, warehouse: str, url: str, properties: dict[str, str],
              replace: bool = False, days: list | None = None, since: int | None = None) -> None:
    """The tables ``load_tables`` keeps into a JDBC warehouse, dimensions first, all of one state.

    Weather keys are the stored ones, which no later run changes, so they can be
    upserted on.  Dimensions are upserted and the fact takes only rows it lacks, from the
    dates in ``days`` if given, so that a run sends what is new and not the whole fact.
    With ``since``, the number of a commit that is still kept, dimensions too send only the
    rows that were added or changed after it, and those removed are deleted.
    With ``replace`` all three tables are emptied in one statement, as they refer to each other, and
    get exactly the stored rows, through staging tables, so that a task that runs twice leaves no copies.
    The database numbers the fact rows itself.  Rows with a value
    that a declared type cannot hold are stored in ``misfits`` below ``warehouse``.
    """
    prepare(spark)
    state = N.read_snapshot(spark, warehouse)
    stations = state.table(spark, "dim_station", S.DIM_STATION)
    weather = state.table(spark, "dim_weather", S.DIM_WEATHER)
    fact = FACT.read(spark, state, days).select(*S.LOADED_FACT.names, "date")
    gone = {}
    if since is not None:
        before = N.read_snapshot(spark, warehouse, since)
        changed = {}
        for name, now, schema, key in (("dim_station", stations, S.DIM_STATION, "station_id"),
                                       ("dim_weather", weather, S.DIM_WEATHER, "weather_id")):
            found = stage(version_changes(before.table(spark, name, schema), now, [key]), f"{name}-changes")
            changed[name] = found.where(F.col(CHANGE) != "removed").select(*schema.names)
            gone[name] = found.where(F.col(CHANGE) == "removed").select(key)
        stations, weather = changed["dim_station"], changed["dim_weather"]
    declared = T.StructType([f for f in S.WAREHOUSE_FACT.fields if f.name != "fact_id"])
    path = f"{warehouse}/misfits"
    W.write_version(union_all([
        warehouse_misfits(stations, S.WAREHOUSE_STATION, "dim_station"),
        warehouse_misfits(weather, S.WAREHOUSE_WEATHER, "dim_weather"),
        warehouse_misfits(fact, declared, "fact_bike_weather", S.FACT_RENAMES)]),
        path, (W.latest_version(spark, path) or 0) + 1)
    stations, weather = warehouse_station(stations), warehouse_weather(weather)
    fact = conform(fact, declared, S.FACT_RENAMES)
    if replace:
        tables = ["fact_bike_weather", "dim_station", "dim_weather"]
        J.execute(spark, url, properties, J.truncate_statement(tables))
    J.upsert_jdbc(stations, url, "dim_station", ["station_id"], properties)
    J.upsert_jdbc(weather, url, "dim_weather", ["weather_id"], properties)
    J.append_new_jdbc(fact, url, "fact_bike_weather", FACT_KEY, properties)
    for name, keys in gone.items():
        J.delete_jdbc(keys, url, name, keys.columns, properties)


def warehouse_misfits(df: DataFrame, table: T.StructType, source: str,
                      renames: dict[str, str] | None = None) -> DataFrame:
    """Values that the declared types cannot hold: where, which, and the row they stand in."""
    rows = misfits(df, table, renames)
    return rows.select(F.lit(source).alias("source"), F.explode("violations").alias("reason"),
                       F.to_json(F.struct(*[c for c in rows.columns if c != "violations"])).alias("content"))


def constraint_report(stations: DataFrame, weather: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows that break each constraint declared for warehouse A, one line per constraint.

    Each table is read once for all its own rules, and once more for each foreign key it takes part in.
    """
    return union_all([
        _checked("dim_station", stations, ["station_id"]),
        _checked("dim_weather", weather, ["weather_id"], not_null=["timestamp"]),
        _checked("fact", fact, not_null=["timestamp"]),
        _orphans("fact", fact, stations, "station_id", "station_id"),
        _orphans("fact", fact, weather, "weather_id", "weather_id")])


def network_constraint_report(networks: DataFrame, stations: DataFrame, status: DataFrame) -> DataFrame:
    """The same for warehouse B, its declared text lengths included."""
    return union_all([
        _checked("dim_network", networks, ["id"], lengths=S.NETWORK_LENGTHS),
        _checked("dim_station", stations, ["station_id"], lengths=S.NETWORK_STATION_LENGTHS),
        _orphans("dim_station", stations, networks, NETWORK_ID, "id"),
        _checked("status", status, ["status_id"], ["station_id"], S.STATION_STATUS_LENGTHS),
        _orphans("status", status, stations, "station_id", "station_id")])


_LENGTHS = "text lengths"


def _checked(table: str, df: DataFrame, key: list[str] | None = None, not_null: list[str] | None = None,
             lengths: dict[str, int] | None = None) -> DataFrame:
    """A table's own rules; a row with several texts that are too long is one violation."""
    columns = [*(key or []), *(not_null or [])]
    df = df.select(*dict.fromkeys([*columns, *(lengths or {})]))
    if lengths:
        long = reduce(or_, [F.coalesce(F.char_length(c) > n, F.lit(False)) for c, n in lengths.items()])
        df = df.select(*dict.fromkeys(columns), F.when(~long, F.lit(True)).alias(_LENGTHS))
    rules = checked(df, key or [], [*(not_null or []), *([_LENGTHS] if lengths else [])])
    name = F.regexp_replace(F.regexp_replace("rule", "is null$", "not null"), f"^{_LENGTHS} not null$", _LENGTHS)
    return rules.select(F.concat(F.lit(f"{table} "), name).alias("constraint"), "violations")


def _orphans(table: str, df: DataFrame, parent: DataFrame, column: str, key: str) -> DataFrame:
    return fk_orphans(df.select(column), parent, {column: key}).agg(
        F.lit(f"{table} {column} foreign key").alias("constraint"), F.count("*").alias("violations"))

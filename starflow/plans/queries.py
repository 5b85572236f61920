"""Every operator run on the test tables.  Each query takes ``(spark, sf_dir)``.

The text beside each query in ``oracle.py`` says the same in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow import schemas as S
from starflow.functions import (
    HOURLY_PATTERN,
    STATION_PATTERN,
    optional,
    parse_default,
    parse_pattern,
    parse_station_time,
)
from starflow.operators import (
    aligned_join,
    any_per_key,
    append_new,
    asof_join,
    conform,
    copy_column,
    dense_key,
    fk_orphans,
    hash_key,
    insert_keyed,
    latest_per_key,
    left_enrich,
    lookup,
    pk_violations,
    project,
    quarantined_rows,
    rename,
    strict_rows,
    unnest,
    upsert,
    valid_rows,
    write_clustered,
    zip_arrays,
)
from starflow.operators import version_changes as changes_between
from starflow.plans import landing, model
from starflow.session import prepare, scratch_path, stage, together
from starflow.sources import documents as D
from starflow.sources import ledger, snapshots
from starflow.sources import tables as W
from starflow.sources import variants as V
from starflow.streaming import status as live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return W.read_table(spark, f"{sf_dir}/{name}.parquet")


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as the test tables keep them."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def hour_of(ts: str = "ts"):
    return F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")


def cents(amount: str):
    """Money as whole cents, so that sums do not depend on their order."""
    return F.round(F.col(amount) * 100).cast("bigint")


# --- keys and enrichment ---------------------------------------------------

@query
def fact_hour_enriched(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    hours = events.groupBy(hour_of().alias("timestamp")).agg(F.count("*").alias("n"))
    weather = stage(dense_key(hours, "weather_id", ["timestamp"]), "hour_dim")
    return aligned_join(events, weather, "ts").select(
        "event_id", "user_id", "ts", "event_type", "value", "weather_id", "n")


@query
def fact_exact_join(spark, sf_dir):
    days = (table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("timestamp"))
            .distinct())
    dim = stage(dense_key(days, "weather_id", ["timestamp"]), "day_dim")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").alias("timestamp"))
    return left_enrich(lines, dim, "timestamp")


@query
def surrogate_key_dense(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return dense_key(events, "row_key", ["ts", "event_id"])


@query
def surrogate_key_hash(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        hash_key("o_orderkey", "o_orderpriority", "o_orderstatus").alias("row_key"))


@query
def insert_with_target_keys(spark, sf_dir):
    """Hours with purchases are stored first; all hours are merged in afterwards."""
    events = table(spark, sf_dir, "events")
    count = F.count("*").alias("n")
    first = events.where("event_type = 'purchase'").groupBy(hour_of().alias("hour")).agg(count)
    stored = stage(dense_key(first, "weather_id", ["hour"]), "stored_hours")
    every = stage(events.groupBy(hour_of().alias("hour")).agg(count), "every_hour")
    return insert_keyed(stored, every, ["hour"], "weather_id").select("weather_id", "hour", "n")


# --- one row per key -------------------------------------------------------

@query
def dedupe_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(events, ["user_id"], ["ts", "event_id"])


@query
def dedupe_keys(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    return any_per_key(table(spark, sf_dir, "lineitem"), keys).select(*keys)


# --- reshape ---------------------------------------------------------------

@query
def unnest_documents(spark, sf_dir):
    """Each text as a JSON document with one object per line, read and unnested."""
    lines = F.transform(F.split("text", "\n"),
                        lambda line, i: F.struct(i.alias("id"), line.alias("name")))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.to_json(F.struct(lines.alias("stations"))).alias("json"))
    parsed = docs.select("doc_id", F.from_json(
        "json", "stations array<struct<id: int, name: string>>").alias("network"))
    return rename(unnest(parsed, "network.stations", keep=["doc_id"]),
                  {"id": "line_no", "name": "line"})


@query
def optional_fields(spark, sf_dir):
    parsed = F.from_json("props", "k int, missing int, extra struct<slots: int>")
    return (table(spark, sf_dir, "events").select("event_id", parsed.alias("doc"))
            .select("event_id", optional("doc.k").alias("k"),
                    optional("doc.missing").alias("missing"),
                    optional("doc.extra.slots", -1).alias("slots")))


@query
def strict_fields(spark, sf_dir):
    docs = table(spark, sf_dir, "events").select("event_id", F.array("props").alias("rows"))
    return strict_rows(docs, "rows", S.fields(k=S.LONG), ["k"], keep=["event_id"])


@query
def zip_arrays_shortest(spark, sf_dir):
    """A whole vector beside its positive components, which are fewer."""
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("value"))
    vectors = vectors.withColumns({
        "positive": F.filter("value", lambda x: x > 0),
        "position": F.transform("value", lambda x, i: i.cast("bigint"))})
    return zip_arrays(vectors, {"position": "position", "value": "value",
                                "positive": "positive"}, keep=["vec_id"])


@query
def rename_project(spark, sf_dir):
    suppliers = rename(table(spark, sf_dir, "supplier"),
                       {"s_suppkey": "station_id", "s_name": "station_name"})
    return project(copy_column(suppliers, "station_name", "address"), "station_id",
                   "station_name", "address", (F.col("s_acctbal") < 0).alias("in_debt"))


@query
def parse_timestamps(spark, sf_dir):
    """Times spelled in one of four ways by event type, one of them unreadable."""
    ts = F.col("ts").cast("timestamp")
    micros = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (F.when(F.col("event_type") == "view", F.concat(micros, F.lit("+00:00Z")))
            .when(F.col("event_type") == "click", F.concat(micros, F.lit("Z")))
            .when(F.col("event_type") == "error", F.concat(F.lit("at "), micros))
            .otherwise(F.concat(micros, F.lit("+00:00"))))
    hour = F.date_format(ts, "yyyy-MM-dd'T'HH:mm")
    return without_zone(
        table(spark, sf_dir, "events").select("event_id", text.alias("text"),
                                              hour.alias("minute_text"))
        .select("event_id",
                parse_pattern(F.col("text"), STATION_PATTERN).alias("by_pattern"),
                parse_default(F.col("text")).alias("by_default"),
                parse_station_time(F.col("text")).alias("by_any"),
                parse_pattern(F.col("minute_text"), HOURLY_PATTERN).alias("minute")))


# --- merge -----------------------------------------------------------------

@query
def upsert_dim(spark, sf_dir):
    """Labels as target; vectors bring new values, some of them NULL, and new keys."""
    target = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    source = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("label").alias("quality"),
        F.lit(None).cast("int").alias("toxic"))
    return upsert(target, source, ["doc_id"])


@query
def append_idempotent(spark, sf_dir):
    """Part of the events is loaded, then all of them, then all of them again."""
    events = W.with_date(table(spark, sf_dir, "events"), "ts")
    path = scratch_path(spark, "appended")
    for batch in (events.where("event_type <> 'error'"), events, events):
        append_new(batch, path, ["event_id", "ts"], sort_by=["user_id", "ts"])
    return spark.read.schema(events.schema).parquet(path).drop("date")


@query
def append_newest(spark, sf_dir):
    """A batch that holds each event twice, as first sent and as corrected later."""
    events = W.with_date(table(spark, sf_dir, "events"), "ts")
    batch = (events.withColumn("sent", F.lit(1))
             .unionByName(events.withColumns({"sent": F.lit(2), "value": F.col("value") + 1})))
    path = scratch_path(spark, "appended")
    append_new(batch, path, ["event_id", "ts"], sort_by=["user_id", "ts"], newest_by=["sent"])
    return spark.read.schema(events.schema).parquet(path).drop("date")


@query
def replace_partition(spark, sf_dir):
    """The last day of a table by date is replaced by corrected values."""
    events = W.with_date(table(spark, sf_dir, "events"), "ts")
    path = scratch_path(spark, "by_day")
    W.write_by_date(events, path, "date", ["user_id", "ts", "event_id"], mode="overwrite")
    last = events.agg(F.max("date").alias("date")).first().date
    stored = spark.read.schema(events.schema).parquet(path)
    corrected = (stored.where(F.col("date") == F.lit(last))
                 .withColumn("value", F.col("value") * 2))
    W.replace_partitions(stage(corrected, "corrected"), path, "date", ["user_id", "ts", "event_id"])
    return spark.read.schema(events.schema).parquet(path).drop("date")


@query
def replace_table(spark, sf_dir):
    path = scratch_path(spark, "replaced")
    W.replace_table(table(spark, sf_dir, "nation"), path)
    customers = table(spark, sf_dir, "customer")
    W.replace_table(customers, path)
    return W.read_table(spark, path, customers.schema)


# --- constraints and conformance -------------------------------------------

@query
def pk_violation_report(spark, sf_dir):
    return pk_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def fk_orphan_report(spark, sf_dir):
    """Documents without a label."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return fk_orphans(documents, table(spark, sf_dir, "labels"), {"doc_id": "doc_id"})


def _labelled(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return left_enrich(documents, table(spark, sf_dir, "labels"), "doc_id")


LIMITS = {"not_null": ["doc_id", "quality"], "max_length": {"lang": 2}}


@query
def not_null_valid(spark, sf_dir):
    return valid_rows(_labelled(spark, sf_dir), **LIMITS)


@query
def not_null_quarantine(spark, sf_dir):
    return quarantined_rows(_labelled(spark, sf_dir), **LIMITS).select(
        "doc_id", F.array_join("violations", ", ").alias("reason"))


@query
def constraint_counts(spark, sf_dir):
    """The star's constraints on lines, orders and suppliers, by keys whose ranges differ."""
    stations = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("station_id"))
    weather = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("weather_id"), F.col("o_orderdate").alias("timestamp"))
    fact = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("station_id"), F.col("l_orderkey").alias("weather_id"),
        F.col("l_shipdate").alias("timestamp"))
    return model.constraint_report(stations, weather, fact)


@query
def network_constraint_counts(spark, sf_dir):
    """The network tables' constraints on pages, documents and events."""
    none = F.lit(None).cast("string")
    networks = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("id"), F.col("url").alias("name"), none.alias("city"),
        F.lit("abc").alias("country"), F.col("html").alias("href"), none.alias("gbfs_href"))
    stations = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("station_id"), F.col("doc_id").cast("string").alias("network_id"),
        F.col("text").alias("name"), F.col("lang").alias("uid"))
    status = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("status_id"), (F.col("user_id") * 10).cast("string").alias("station_id"))
    return model.network_constraint_report(networks, stations, status)


@query
def conform_schema(spark, sf_dir):
    declared = S.fields(["station_id"], station_id=S.TEXT, station_name=S.TEXT,
                        latitude=S.NUMERIC, slots=S.INT, address=S.TEXT)
    return conform(table(spark, sf_dir, "supplier"), declared, {
        "s_suppkey": "station_id", "s_name": "station_name",
        "s_acctbal": "latitude", "s_nationkey": "slots"})


# --- as-of -----------------------------------------------------------------

def _earlier_events(spark, sf_dir):
    """Each event ten minutes before it happened, and all events as they are."""
    events = table(spark, sf_dir, "events")
    before = events.select("event_id", "user_id",
                           (F.col("ts") - F.expr("interval 10 minutes")).alias("before_ts"))
    seen = events.select("user_id", F.col("ts").alias("seen_ts"), F.col("event_id").alias("seen_id"))
    return before, seen


@query
def asof_by_key(spark, sf_dir):
    before, seen = _earlier_events(spark, sf_dir)
    return asof_join(before, seen, "before_ts", "seen_ts", by=["user_id"])


@query
def asof_global(spark, sf_dir):
    before, seen = _earlier_events(spark, sf_dir)
    return asof_join(before, seen.drop("user_id"), "before_ts", "seen_ts")


@query
def asof_within_hour(spark, sf_dir):
    before, seen = _earlier_events(spark, sf_dir)
    return asof_join(before, seen, "before_ts", "seen_ts", by=["user_id"], tolerance_seconds=3600)


# --- sources and sinks -----------------------------------------------------

@query
def json_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "json")
    D.land_documents(events, path)
    docs = D.read_documents(spark, path, events.schema, multi_line=False)
    return D.readable(docs).select(*events.columns)


@query
def parquet_roundtrip(spark, sf_dir):
    """Orders laid out by order month and read back with the month as partition."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "month", F.trunc("o_orderdate", "month"))
    path = scratch_path(spark, "parquet")
    W.write_by_date(orders, path, "month", ["o_custkey", "o_orderdate", "o_orderkey"],
                    mode="overwrite")
    return W.read_table(spark, path, orders.schema)


# --- table builders --------------------------------------------------------

def _landed_stations(spark, sf_dir):
    path = scratch_path(spark, "station_documents")
    D.land_documents(landing.station_documents(table(spark, sf_dir, "events")), path)
    return path


def _landed_hours(spark, sf_dir):
    """Each hour in two documents: an early one with wrong values, then the one that counts."""
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "hourly_documents")
    D.land_documents(landing.early_documents(events), path)
    D.land_documents(landing.hourly_documents(events), path)
    return path


def _landed(spark, sf_dir):
    return together(spark, partial(_landed_stations, spark, sf_dir), partial(_landed_hours, spark, sf_dir))


def _stations(spark, sf_dir):
    docs = D.read_documents(spark, _landed_stations(spark, sf_dir), S.STATION_DOCUMENT, multi_line=False)
    return D.readable(docs)


def _weather(spark, sf_dir):
    docs = D.read_documents(spark, _landed_hours(spark, sf_dir), S.HOURLY_DOCUMENT, multi_line=False)
    return model.dim_weather(model.weather_rows(D.readable(docs)))


@query
def rejected_documents(spark, sf_dir):
    """Documents of which some are cut off and some hold text for a number: what was kept of each kind."""
    path = scratch_path(spark, "damaged")
    landing.damaged_documents(table(spark, sf_dir, "events")).write.text(path)
    docs = D.read_documents(spark, path, S.STATION_DOCUMENT, multi_line=False)
    rows = stage(model.station_rows_and_damage(docs), "rows_and_damage")
    left = model.rejected_documents("stations", rows.where(F.col(S.CORRUPT).isNotNull()))
    kinds = left.groupBy(F.regexp_extract("content", '"id":"([a-z]+)"', 1).alias("kind")).agg(
        F.count("*").alias("damaged"))
    kept = (rows.where(F.col(S.CORRUPT).isNull()).groupBy(F.col("network_id").alias("kind"))
            .agg(F.count("*").alias("stations"), F.count("free_bikes").alias("with_bikes")))
    return kept.join(kinds, "kind", "full").na.fill(0)


@query
def build_dim_station(spark, sf_dir):
    return model.dim_station(model.station_rows(_stations(spark, sf_dir)))


@query
def build_dim_weather(spark, sf_dir):
    return without_zone(_weather(spark, sf_dir))


def _built_fact(spark, sf_dir, align):
    """Raw documents to the processed tables; the stored fact."""
    stations, hours = _landed(spark, sf_dir)
    path = model.build_tables(spark, stations, hours, scratch_path(spark, "processed"), align, multi_line=False)
    fact = W.read_table(spark, f"{path}/fact_bike_weather", S.FACT_BIKE_WEATHER)
    return without_zone(fact.drop("date"))


@query
def build_fact_bike_weather(spark, sf_dir):
    return _built_fact(spark, sf_dir, "hour")


@query
def build_fact_exact(spark, sf_dir):
    return _built_fact(spark, sf_dir, "exact")


@query
def build_fact_asof(spark, sf_dir):
    return _built_fact(spark, sf_dir, "asof")


@query
def warehouse_station(spark, sf_dir):
    return model.warehouse_station(model.dim_station(model.station_rows(_stations(spark, sf_dir))))


@query
def warehouse_weather(spark, sf_dir):
    return without_zone(model.warehouse_weather(_weather(spark, sf_dir)))


@query
def build_dim_network(spark, sf_dir):
    return model.dim_network(_stations(spark, sf_dir))


@query
def build_dim_network_station(spark, sf_dir):
    return model.dim_network_station(model.station_rows(_stations(spark, sf_dir)))


@query
def build_fact_station_status(spark, sf_dir):
    # Copies of a row are told apart by their place in the scanned files, which a rerun task finds again.
    rows = model.station_rows(_stations(spark, sf_dir)).withColumn(model.ROW, F.monotonically_increasing_id())
    return without_zone(model.fact_station_status(rows))


def _loaded(spark, warehouse):
    return without_zone(model.warehouse_fact(model.read_fact(spark, warehouse)))


def _middle(events):
    """The time halfway between the first and the last event, in seconds."""
    ts = F.col("ts").cast("timestamp")
    return events.agg((F.unix_seconds(F.min(ts)) / 2 + F.unix_seconds(F.max(ts)) / 2).alias("m")).first()["m"]


def _seconds():
    return F.unix_seconds(F.col("ts").cast("timestamp"))


@query
def load_warehouse_fact(spark, sf_dir):
    """The whole job into a warehouse, in the columns the warehouse declares."""
    stations, hours = _landed(spark, sf_dir)
    warehouse = scratch_path(spark, "warehouse")
    model.load_tables(spark, stations, hours, warehouse, multi_line=False)
    return _loaded(spark, warehouse)


@query
def late_weather(spark, sf_dir):
    """Status is loaded when only the first half of the weather is known, then the rest comes."""
    events = table(spark, sf_dir, "events")
    stations, hours = _landed_stations(spark, sf_dir), scratch_path(spark, "hours")
    late = _seconds() > _middle(events)
    warehouse = scratch_path(spark, "warehouse")
    for part in (events.where(~late), events.where(late)):
        D.land_documents(landing.hourly_documents(part), hours)
        model.load_tables(spark, stations, hours, warehouse, multi_line=False)
    return _loaded(spark, warehouse)


@query
def durable_fact_numbers(spark, sf_dir):
    """The later half of the statuses is loaded first, then all: what is stored keeps its number."""
    events = table(spark, sf_dir, "events")
    stations, hours = scratch_path(spark, "stations"), _landed_hours(spark, sf_dir)
    late = _seconds() > _middle(events)
    warehouse = scratch_path(spark, "warehouse")
    for part in (events.where(late), events.where(~late)):
        D.land_documents(landing.station_documents(part), stations)
        model.load_tables(spark, stations, hours, warehouse, multi_line=False)
    return _loaded(spark, warehouse)


def _corrected(events):
    """The events that are sent again, each with a value that is greater by one."""
    return events.where("event_type <> 'view'").withColumn("value", F.col("value") + 1)


@query
def load_corrections(spark, sf_dir):
    """Statuses are loaded, then most come again in later files with other values; the fact is compacted."""
    events = table(spark, sf_dir, "events")
    stations, hours = _landed(spark, sf_dir)
    warehouse = scratch_path(spark, "warehouse")
    model.load_tables(spark, stations, hours, warehouse, multi_line=False)
    D.land_documents(landing.station_documents(_corrected(events)), stations)
    model.load_tables(spark, stations, hours, warehouse, multi_line=False)
    model.compact_tables(spark, warehouse)
    return _loaded(spark, warehouse)


@query
def ledger_loads(spark, sf_dir):
    """Files land in folders by day and are loaded three times by the ledger: how often each was taken, and the rows."""
    events = table(spark, sf_dir, "events")
    stations, hours, warehouse = (scratch_path(spark, n) for n in ("stations", "hours", "warehouse"))
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for k in range(3):
        day = date(2025, 1, 1 + k)
        D.land_documents(landing.station_documents(events.where(third == k)), stations, day)
        D.land_documents(landing.hourly_documents(events.where(third == k)), hours, day)
        model.load_tables(spark, stations, hours, warehouse, multi_line=False, ledger=True)
    files = snapshots.read_snapshot(spark, warehouse).rows(spark, model.TAKEN, ledger.FILES)
    times = files.groupBy("source", "path").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"]
    fact = model.read_fact(spark, warehouse).groupBy("station_id").agg(
        F.count("*").alias("rows"), F.count("weather_id").alias("with_weather"), F.sum("free_bikes").alias("bikes"))
    return fact.withColumn("times_taken", F.lit(times).cast("bigint"))


def _network_warehouse(spark, sf_dir):
    """Statuses are loaded in two halves, the later first, and then all of them again."""
    events = table(spark, sf_dir, "events")
    stations, warehouse = scratch_path(spark, "stations"), scratch_path(spark, "network")
    late = _seconds() > _middle(events)
    for part in (events.where(late), events.where(~late), events):
        D.land_documents(landing.station_documents(part), stations)
        model.load_network_tables(spark, stations, warehouse, multi_line=False)
    return warehouse


@query
def load_network_status(spark, sf_dir):
    return without_zone(model.read_network_tables(spark, _network_warehouse(spark, sf_dir))[2])


@query
def load_network_stations(spark, sf_dir):
    networks, stations, _ = model.read_network_tables(spark, _network_warehouse(spark, sf_dir))
    networks = networks.select(F.col("id").alias("network_id"), F.col("name").alias("network"), "country")
    return left_enrich(stations, stage(networks, "networks"), "network_id")


@query
def lookup_by_weather(spark, sf_dir):
    """All events clustered by hour and user; the events of the hour with the most of them, by its key."""
    events = table(spark, sf_dir, "events")
    hours = events.groupBy(hour_of().alias("timestamp")).agg(F.count("*").alias("n"))
    weather = stage(dense_key(hours, "weather_id", ["timestamp"]), "hour_dim")
    fact = stage(aligned_join(events, weather, "ts").select("event_id", "user_id", "ts", "value", "weather_id"), "fact")
    path = scratch_path(spark, "clustered")
    write_clustered(fact, path, ["weather_id", "user_id"], bloom={"weather_id": 100_000, "user_id": 100_000})
    busiest = weather.orderBy(F.desc("n"), "timestamp").first()["weather_id"]
    return lookup(spark.read.schema(fact.schema).parquet(path), weather_id=busiest)


@query
def version_changes(spark, sf_dir):
    """Customers before and after some leave, some change and some come in, by what happened to each."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    before = customers.where("c_nationkey <> 3")
    moved = F.when(F.col("c_nationkey") == 7, F.lit(None).cast("int")).otherwise(F.col("c_nationkey"))
    after = customers.where("c_nationkey <> 11").withColumn("c_nationkey", moved.cast(customers.schema["c_nationkey"].dataType))
    return changes_between(before, after, ["c_custkey"])


@query
def variant_fields(spark, sf_dir):
    """Station documents parsed once into a stored variant: which fields each station has, one unknown to the schema too."""
    texts = landing.station_documents(table(spark, sf_dir, "events"), "event_id")
    texts = texts.select("event_id", F.to_json(F.struct("network"), {"ignoreNullFields": "false"}).alias("value"))
    docs = stage(V.parse_documents(texts), "variants")
    rows = V.strict_elements(docs, "network.stations", ["id", "latitude", "extra"], keep=["event_id"])
    return rows.select(
        "event_id", V.field("element", "id", "string").alias("station_id"),
        V.field("element", "free_bikes", "bigint").alias("free_bikes"),
        V.field("element", "extra.last_updated_epoch", "bigint").alias("epoch"),
        V.state("element", "latitude").alias("latitude"), V.state("element", "extra").alias("extra"),
        V.state("element", "extra.uid").alias("uid"), V.state("element", "extra.none").alias("none"))


# --- streaming -------------------------------------------------------------

def _streamed(spark, sf_dir, enrich=False, times=1):
    """The documents land in four parts and come in at least as many batches."""
    events = table(spark, sf_dir, "events")
    landed = scratch_path(spark, "landed")
    part = F.pmod(F.xxhash64("event_id"), F.lit(4))
    for _ in range(times):
        for k in range(4):
            D.land_documents(landing.station_documents(events.where(part == k)), landed)
    files = max(1, len(spark.read.text(landed).inputFiles()) // (4 * times))
    stream = live.status_stream(spark, landed, multi_line=False, max_files=files)
    if enrich:
        hours = events.select(F.date_trunc("hour", F.col("ts").cast("timestamp"))
                              .alias("timestamp")).distinct()
        stream = live.enrich_stream(
            stream, stage(dense_key(hours, "weather_id", ["timestamp"]), "hour_dim"))
    out, checkpoint = scratch_path(spark, "live"), scratch_path(spark, "live_checkpoint")
    live.start(stream, live.keyed_writer(out), checkpoint).awaitTermination()
    return out


@query
def stream_status(spark, sf_dir):
    return without_zone(live.read_fact(spark, _streamed(spark, sf_dir)).drop("date"))


@query
def stream_enriched(spark, sf_dir):
    out = _streamed(spark, sf_dir, enrich=True)
    return without_zone(live.read_fact(spark, out, live.ENRICHED).drop("date"))


@query
def stream_latest(spark, sf_dir):
    return without_zone(live.read_latest(spark, _streamed(spark, sf_dir)))


@query
def stream_keyed(spark, sf_dir):
    """All documents land twice; each status is stored once, whatever its age."""
    return without_zone(live.read_fact(spark, _streamed(spark, sf_dir, times=2)).drop("date"))


@query
def stream_corrections(spark, sf_dir):
    """Statuses land and are streamed; then most land again with other values, in batches of their own."""
    events = table(spark, sf_dir, "events")
    landed, out, checkpoint = (scratch_path(spark, n) for n in ("landed", "live", "live_checkpoint"))
    for part in (events, _corrected(events)):
        D.land_documents(landing.station_documents(part), landed)
        files = max(1, len(spark.read.text(landed).inputFiles()) // 3)
        stream = live.status_stream(spark, landed, multi_line=False, max_files=files)
        live.start(stream, live.keyed_writer(out), checkpoint).awaitTermination()
    fact, latest = live.read_fact(spark, out).drop("date"), live.read_latest(spark, out)
    newest = latest.select("station_id", "timestamp", F.lit(True).alias("newest"))
    return without_zone(fact.join(newest, ["station_id", "timestamp"], "left").na.fill(False, ["newest"]))


@query
def stream_weather_join(spark, sf_dir):
    """Statuses are streamed before any weather; then the weather's later half lands, and the rest last."""
    events = table(spark, sf_dir, "events")
    landed, hours, out, checkpoint = (scratch_path(spark, n) for n in ("landed", "hours", "live", "live_checkpoint"))
    late = _seconds() > _middle(events)
    D.land_documents(landing.station_documents(events), landed)
    D.land_documents(landing.hourly_documents(events.where(F.lit(False))), hours)
    for part in (None, events.where(late), events):
        if part is not None:
            D.land_documents(landing.hourly_documents(part), hours)
        stream = live.with_weather(live.status_stream(spark, landed, multi_line=False),
                                   live.weather_stream(spark, hours, multi_line=False))
        live.start(stream, live.joined_writer(out), checkpoint).awaitTermination()
    weather = stage(live.read_weather(spark, out).select("weather_id", F.col("timestamp").alias("hour"), "temperature"), "weather")
    fact = live.read_fact(spark, out, live.ENRICHED).drop("date")
    return without_zone(left_enrich(fact, weather, "weather_id").drop("weather_id"))

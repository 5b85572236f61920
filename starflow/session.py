"""Session settings and the shared scratch space."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORE = "spark.sql.streaming.stateStore"
# Settings for the state of streams: it lies on the executors' disks, in one store for each part, within
# a memory of its own.  Spark's default holds every waiting row, and two versions of it, as an object in the heap.
STATE = {
    f"{_STORE}.providerClass": _ROCKSDB,
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "256",
    # Without it each row that is put is looked up first, just to be counted.
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    # Nor does each part take megabytes of disk before it has rows.
    f"{_STORE}.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}
# Settings for sessions this package creates itself.  A session handed in by the caller only gets
# its time zone set (see ``prepare``), and ``STATE`` while a stream starts (see ``stateful``).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    **STATE,
    "spark.ui.enabled": "false",
}

# A stream copies its session's settings as it starts; two that start at once must not undo each other's.
_STARTING = Lock()

# Paths staged within the innermost ``scratch`` block.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def create(app: str = "starflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``DEFAULTS``; ``conf`` keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in DEFAULTS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC.

    Hourly observations carry no offset while station timestamps do; the two
    only line up when strings without an offset are read as UTC.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def stateful(spark: SparkSession) -> Iterator[None]:
    """Streams started inside the block keep their state as ``STATE`` says; the session is left as it was.

    What the session sets itself counts, and a checkpoint goes on with what it was begun with.
    """
    with _STARTING:
        given = {k: spark.conf.get(k, None) for k in STATE}
        own = given[f"{_STORE}.providerClass"] in (None, _ROCKSDB)
        added = [k for k, v in given.items() if v is None and own]
        for k in added:
            spark.conf.set(k, STATE[k])
        try:
            yield
        finally:
            for k in added:
                spark.conf.unset(k)


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Jobs in the block are planned as in batch; Spark turns that off in the session of a stream with state.

    For what ``foreachBatch`` does with stored rows: without it each shuffle has as many tasks and files as the
    state has parts, and nothing that is skewed is split.  Of the stream itself nothing may be planned inside.
    """
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, spark.sparkContext.getConf().get(name, "true"))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    Without that setting it is the session's warehouse folder, if executors can reach that: on a cluster a
    folder of the driver's own machine is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir", "")
        shared = re.match(r"(?!file:)[A-Za-z][A-Za-z0-9+.-]*:", base)
        if not base or not (shared or re.match(r"local(\[|$)", spark.sparkContext.master)):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{base.rstrip('/')}/starflow/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared scratch and return the stored table.

    It cuts lineage in a way that outlives lost executors, fixes values that
    depend on the physical partitioning, and gives the planner a measured size,
    so it broadcasts a stored table only when that table really is small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    staged = _STAGED.get()
    if staged is not None:
        staged.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside the block at its end, when its outputs are committed."""
    paths: list[str] = []
    token = _STAGED.set(paths)
    try:
        yield
    finally:
        _STAGED.reset(token)
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Submit independent jobs at once, so that one fills the other's idle cores."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(copy_context().run, inheritable_thread_target(spark)(job))
                   for job in jobs]
        return [job.result() for job in running]

"""Parquet tables: plain, laid out by date, and versioned."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.sources.snapshots import create_once


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def laid_out(df: DataFrame, date_col: str, sort_by: Sequence[str],
             spread: str | None = None) -> DataFrame:
    """Cluster rows by date, then ``sort_by``.

    Ranges over all the columns: a day with a third of the rows is cut into
    several tasks and files, while a quiet day still ends up in one.  Inside a
    file the rows are sorted, so row groups can be skipped on ``sort_by``.
    Rows equal on all of these stay together unless ``spread``, a stored column
    that differs between them, says where to cut; it is dropped.
    """
    columns = [date_col, *sort_by]
    ranges = columns if spread is None else [*columns, spread]
    kept = [c for c in df.columns if c != spread]
    return df.repartitionByRange(*ranges).sortWithinPartitions(*columns).select(*kept)


def write_by_date(df: DataFrame, path: str, date_col: str, sort_by: Sequence[str],
                  mode: str = "append", spread: str | None = None) -> None:
    (laid_out(df, date_col, sort_by, spread)
     .write.mode(mode).partitionBy(date_col).parquet(path))


def replace_partitions(df: DataFrame, path: str, date_col: str, sort_by: Sequence[str]) -> None:
    """Replace just the dates that occur in ``df``; others stay as they are.

    ``df`` must not read from ``path`` itself: a failed commit would lose what it read.
    Pass what ``session.stage`` returns.
    """
    (laid_out(df, date_col, sort_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path))


def _children(spark: SparkSession, path: str) -> list:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return list(fs.listStatus(folder)) if fs.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def has_data(spark: SparkSession, path: str) -> bool:
    names = [s.getPath().getName() for s in _children(spark, path)]
    return any(not n.startswith(("_", ".")) for n in names)


def finished_versions(spark: SparkSession, path: str) -> list[int]:
    """Each complete ``version=N`` below ``path``; a half-written one is ignored."""
    done = []
    for status in _children(spark, path):
        name = status.getPath().getName()
        if name.startswith("version="):
            inside = [s.getPath().getName() for s in _children(spark, f"{path}/{name}")]
            if "_SUCCESS" in inside:
                done.append(int(name.removeprefix("version=")))
    return sorted(done)


def latest_version(spark: SparkSession, path: str) -> int | None:
    return max(finished_versions(spark, path), default=None)


def claim_version(spark: SparkSession, path: str) -> int:
    """The number of a new version that no other run builds; one never finished keeps its number."""
    taken = [int(s.getPath().getName().removeprefix("version=")) for s in _children(spark, path)
             if s.getPath().getName().startswith("version=")]
    version = max(taken, default=0) + 1
    while not create_once(spark, f"{version_path(path, version)}/_claimed"):
        version += 1
    return version


def finish_version(spark: SparkSession, path: str, version: int) -> None:
    """Mark a version of several tables as complete."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{version_path(path, version)}/_SUCCESS")
    fs = mark.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.create(mark, True).close()


def stored_dates(spark: SparkSession, path: str, name: str = "date") -> list[date]:
    """Dates that a table partitioned by date has, from its folders' names."""
    values = [s.getPath().getName().removeprefix(f"{name}=") for s in _children(spark, path)
              if s.getPath().getName().startswith(f"{name}=")]
    return sorted(date.fromisoformat(v) for v in values if v[:1].isdigit())


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` versions; a reader may still be in the one before."""
    for version in finished_versions(spark, path)[:-keep]:
        remove(spark, version_path(path, version))


def version_path(path: str, version: int) -> str:
    return f"{path}/version={version}"


def read_version(spark: SparkSession, path: str, schema: T.StructType,
                 version: int | None = None) -> DataFrame:
    """One version of a table (the newest by default); no rows if there is none yet."""
    if version is None:
        version = latest_version(spark, path)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_path(path, version))


def write_version(df: DataFrame, path: str, version: int) -> DataFrame:
    """Write a whole new version beside the old ones and return the stored table.

    Fails if another writer has stored that version.  What is left of one that never
    finished is replaced.
    """
    if version in finished_versions(df.sparkSession, path):
        raise FileExistsError(f"{version_path(path, version)} is stored already")
    df.write.mode("overwrite").parquet(version_path(path, version))
    return df.sparkSession.read.schema(df.schema).parquet(version_path(path, version))


def with_date(df: DataFrame, ts: str = "timestamp", name: str = "date") -> DataFrame:
    return df.withColumn(name, F.to_date(ts))

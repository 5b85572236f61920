"""JDBC warehouse targets, written in parallel by the executors."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 10_000
MAX_CONNECTIONS = 32


def _writer(df: DataFrame, connections: int, batch_rows: int):
    # numPartitions makes Spark coalesce to at most that many connections.
    return (df.write.option("batchsize", batch_rows)
            .option("numPartitions", connections)
            .option("isolationLevel", "READ_COMMITTED"))


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str],
                connections: int = MAX_CONNECTIONS, batch_rows: int = BATCH_ROWS) -> None:
    _writer(df, connections, batch_rows).jdbc(
        url, table, mode="append", properties=dict(properties))


def replace_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str],
                 connections: int = MAX_CONNECTIONS, batch_rows: int = BATCH_ROWS) -> None:
    """Replace the rows but keep the table itself: its keys, indexes and types."""
    _writer(df, connections, batch_rows).option("truncate", True).jdbc(
        url, table, mode="overwrite", properties=dict(properties))


def upsert_statement(table: str, staging: str, columns: Sequence[str],
                     key: Sequence[str]) -> str:
    """PostgreSQL statement that merges a staging table: new keys in, old ones overwritten."""
    names = ", ".join(columns)
    changes = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in key)
    action = f"DO UPDATE SET {changes}" if changes else "DO NOTHING"
    return (f"INSERT INTO {table} ({names}) SELECT DISTINCT {names} FROM {staging} "
            f"ON CONFLICT ({', '.join(key)}) {action}")


def append_new_statement(table: str, staging: str, columns: Sequence[str],
                         key: Sequence[str]) -> str:
    """Statement that adds the staged rows whose key the table lacks."""
    names = ", ".join(columns)
    same = " AND ".join(f"t.{c} = s.{c}" for c in key)
    return (f"INSERT INTO {table} ({names}) SELECT DISTINCT {names} FROM {staging} s "
            f"WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE {same})")


def delete_statement(table: str, staging: str, key: Sequence[str]) -> str:
    """Statement that removes the rows whose keys are staged."""
    same = " AND ".join(f"t.{c} = s.{c}" for c in key)
    return f"DELETE FROM {table} t WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {same})"


def truncate_statement(tables: Sequence[str]) -> str:
    """Empty tables that refer to each other, which a database refuses one by one."""
    return f"TRUNCATE {', '.join(tables)}"


def _merge(df: DataFrame, url: str, table: str, properties: Mapping[str, str], statement,
           **writer) -> None:
    """Load a staging table of this run's own, merge it with one statement, and drop it."""
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    try:
        append_jdbc(df, url, staging, properties, **writer)
        execute(df.sparkSession, url, properties, statement(staging))
    finally:
        execute(df.sparkSession, url, properties, f"DROP TABLE IF EXISTS {staging}")


def upsert_jdbc(df: DataFrame, url: str, table: str, key: Sequence[str],
                properties: Mapping[str, str], **writer) -> None:
    """Load a staging table from the executors, then merge it with one statement.

    The rows never pass the driver, and the merge is one transaction, so a
    retried load gives the same table.  ``df`` must be unique on ``key``; copies that a rerun
    task left in the staging table are merged once.
    """
    _merge(df, url, table, properties,
           lambda staging: upsert_statement(table, staging, df.columns, key), **writer)


def append_new_jdbc(df: DataFrame, url: str, table: str, key: Sequence[str],
                    properties: Mapping[str, str], **writer) -> None:
    """As ``upsert_jdbc``, but rows whose key is already there are left alone."""
    _merge(df, url, table, properties,
           lambda staging: append_new_statement(table, staging, df.columns, key), **writer)


def delete_jdbc(keys: DataFrame, url: str, table: str, key: Sequence[str],
                properties: Mapping[str, str], **writer) -> None:
    """Remove the rows of these keys, through a staging table and in one statement."""
    _merge(keys, url, table, properties, lambda staging: delete_statement(table, staging, key), **writer)


def execute(spark: SparkSession, url: str, properties: Mapping[str, str],
            statement: str) -> None:
    """Run one statement on the target."""
    jvm = spark._jvm
    if "driver" in properties:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    settings = jvm.java.util.Properties()
    for name, value in properties.items():
        settings.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.createStatement().executeUpdate(statement)
    finally:
        connection.close()

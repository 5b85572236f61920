"""Merging a batch into a target table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.operators.dedupe import latest_per_key
from starflow.operators.keys import dense_key, next_key
from starflow.session import stage
from starflow.sources.tables import has_data, write_by_date


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """New keys are added, existing ones overwritten in all columns (NULLs too).

    ``source`` must be unique on ``key`` (see ``latest_per_key``).  Write the
    result to a new version of the table, not over the one being read.
    """
    untouched = target.join(source.select(*key), list(key), "left_anti")
    return untouched.select(*target.columns).unionByName(source.select(*target.columns))


def insert_keyed(target: DataFrame, source: DataFrame, natural_key: Sequence[str],
                 key: str) -> DataFrame:
    """Upsert where the target hands out the surrogate ``key``.

    A known natural key keeps its number, so facts that refer to it stay right;
    new ones continue after the highest number in use.
    """
    names = list(natural_key)
    known = target.select(*names, key)
    fresh = dense_key(source.join(known, names, "left_anti"), key, names,
                      start=next_key(target, key))
    changed = source.join(known, names, "inner")
    rows = fresh.select(*target.columns).unionByName(changed.select(*target.columns))
    return upsert(target, rows, names)


def new_rows(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key the target lacks.

    A row with a NULL in its key counts as new, so check for NULLs first.
    """
    return batch.join(target.select(*key), list(key), "left_anti").select(*batch.columns)


def append_new(batch: DataFrame, path: str, key: Sequence[str], date_col: str = "date",
               sort_by: Sequence[str] = (), newest_by: Sequence[str] = ()) -> None:
    """Append to a table partitioned by date; rows already there are skipped.

    Only the target's partitions for the days in the batch are read, so the cost
    follows the batch, not the table.  Running a load again adds nothing.  Of a key
    repeated inside the batch the row with the greatest ``newest_by`` is added, and among those
    the greatest by content; the columns of ``newest_by`` are not stored.
    """
    spark = batch.sparkSession
    # Stored once: the days, the ranges of the layout and the write each read it.
    rows = stage(latest_per_key(batch, key, newest_by).drop(*newest_by), "append")
    if has_data(spark, path):
        # One value per calendar day of the batch.
        days = [r[0] for r in rows.select(date_col).distinct().collect()]
        target = spark.read.schema(rows.schema).parquet(path)
        rows = new_rows(target.where(F.col(date_col).isin(days)), rows, key)
    # With the key in it the order has no ties left.
    order = [*sort_by, *[k for k in key if k not in sort_by]]
    write_by_date(rows, path, date_col, order)

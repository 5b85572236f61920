"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.session import stage

_PLACE, _PART, _BASE, _TIE, _ROW = "_place", "_part", "_base", "_tie", "_row"
_POSITION_BITS = 33  # low bits of monotonically_increasing_id: position in the partition


def dense_key(df: DataFrame, key: str, order_by: Sequence[str], start: int = 1,
              unique_order: bool = True) -> DataFrame:
    """Number rows ``start, start+1, ...`` in the given order.

    Rows are range-partitioned and sorted, so each row's place in its partition
    is known without a second shuffle; the stored result fixes the ranges, and
    only one count per partition goes through the running sum.  No task ever
    holds more than one range.

    ``order_by`` should be unique.  With ``unique_order=False`` ties are ordered
    by row content, and copies of one row are told apart by a row number, so
    that many copies fall into several ranges.  That number is stored first: a
    task rerun after a lost executor must not hand out another one.
    """
    columns = df.columns
    order = list(order_by)
    if not unique_order:
        df = stage(df.withColumns({_TIE: F.xxhash64(*columns),
                                   _ROW: F.monotonically_increasing_id()}), "dense_key_rows")
        order += [_TIE, _ROW]
    placed = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
          .select(*columns, F.monotonically_increasing_id().alias(_PLACE)),
        "dense_key")
    placed = placed.withColumn(_PART, F.shiftright(_PLACE, _POSITION_BITS))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition: bounded by the shuffle partition count.
    bases = (placed.groupBy(_PART).agg(F.count("*").alias("_n"))
             .select(_PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_BASE)))
    position = F.col(_PLACE).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    number = F.col(_BASE) + position + F.lit(start)
    return (placed.join(F.broadcast(bases), _PART)
            .select(number.cast("bigint").alias(key), *columns))


def hash_key(*columns: Column | str) -> Column:
    """SHA-256 of a natural key: reproducible anywhere, no shuffle.

    Values are escaped and NULL has its own mark, so different keys never
    give the same text.
    """
    parts = []
    for c in columns:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        text = F.replace(text, F.lit("|"), F.lit("\\|"))
        parts.append(F.coalesce(text, F.lit("\\N")))
    return F.sha2(F.concat_ws("|", *parts), 256)


def next_key(table: DataFrame, key: str) -> int:
    """First free number after the keys of a stored table (one aggregated row)."""
    return (table.agg(F.max(key).alias("top")).first().top or 0) + 1

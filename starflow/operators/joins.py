"""Left joins of a fact to a dimension.

No broadcast is forced.  Give the dimension as a stored table: the planner then
knows its size, broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise uses a sort-merge join whose skewed fact partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SLOT = "_slot"


def left_enrich(fact: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left equi-join with one copy of the key columns; unmatched fact rows stay."""
    return fact.join(dim, on=[on] if isinstance(on, str) else list(on), how="left")


def aligned_join(fact: DataFrame, dim: DataFrame, ts: str, dim_ts: str = "timestamp",
                 unit: str = "hour") -> DataFrame:
    """Left join on the fact's time cut down to ``unit``.

    ``dim`` holds one row per whole unit; its time column is not repeated.
    """
    slot = F.date_trunc(unit, F.col(ts)).cast(fact.schema[ts].dataType)
    slots = dim.withColumnRenamed(dim_ts, _SLOT)
    return fact.withColumn(_SLOT, slot).join(slots, _SLOT, "left").drop(_SLOT)

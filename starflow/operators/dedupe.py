"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.session import stage

_BEST, _TOP = "_best", "_top"


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one arbitrary row per key.  Pre-aggregated before the shuffle."""
    return df.dropDuplicates(list(keys))


def latest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Keep the row with the greatest ``by`` per key, NULL counting as smallest.

    Rows equal on ``by`` are told apart by their other columns, so the survivor
    does not depend on the partitioning.  Each map task sorts its rows by key and sends
    one row per key, however many rows a hot key has.
    """
    rest = [c for c in df.columns if c not in keys and c not in by]
    if not rest and not by:
        return any_per_key(df, keys)
    best = df.groupBy(*keys).agg(F.max(F.struct(*by, *rest)).alias(_BEST))
    return best.select(*[c if c in keys else F.col(f"{_BEST}.{c}") for c in df.columns])


def only_latest(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """The rows with the greatest ``by`` of their key: all that ``latest_per_key`` has to compare.

    For stored rows with many to a key.  A number or a time is compared by hashing, without a
    sort; the greatest are stored, so they are broadcast only when they really are few.
    """
    top = stage(df.groupBy(*keys).agg(F.max(by).alias(_TOP)), "tops").withColumnsRenamed({k: f"_top_{k}" for k in keys})
    same = [df[k].eqNullSafe(top[f"_top_{k}"]) for k in keys]
    return df.join(top, [*same, df[by].eqNullSafe(top[_TOP])], "left_semi")

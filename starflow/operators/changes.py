"""What differs between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE = "change"
_OLD, _NEW = "_old", "_new"


def row_hash(columns: Sequence[str]) -> Column:
    """Two hashes of a row's content; NULL counts as a value, so it differs from any other."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return F.struct(F.xxhash64(F.lit(0), *parts), F.xxhash64(F.lit(1), *reversed(parts)))


def version_changes(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows that were ``added``, ``changed`` or ``removed``, with all columns of ``after``.

    ``key`` is unique in both and may hold NULLs.  A removed row has its old values, any other its new
    ones.  Both versions are reduced to hashes of their rows first; only rows whose hashes differ are
    joined with their content.
    """
    columns = after.columns
    rest = [c for c in columns if c not in key]
    names = [f"_key{i}" for i in range(len(key))]

    def hashed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"{name}{i}") for i, k in enumerate(key)], row_hash(rest).alias(name))

    old, new = hashed(before.select(*columns), _OLD), hashed(after, _NEW)
    same = [F.col(f"{_OLD}{i}").eqNullSafe(F.col(f"{_NEW}{i}")) for i in range(len(key))]
    kind = (F.when(F.col(_OLD).isNull(), "added").when(F.col(_NEW).isNull(), "removed")
            .when(F.col(_OLD) != F.col(_NEW), "changed"))
    differing = (old.join(new, same, "full").withColumn(CHANGE, kind).where(F.col(CHANGE).isNotNull())
                 .select(*[F.when(F.col(_NEW).isNull(), F.col(f"{_OLD}{i}")).otherwise(F.col(f"{_NEW}{i}")).alias(n)
                           for i, n in enumerate(names)], CHANGE))
    there = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(key, names)]

    def content(df: DataFrame, removed: bool) -> DataFrame:
        wanted = differing.where((F.col(CHANGE) == "removed") == removed)
        return df.select(*columns).join(wanted, there, "inner").select(CHANGE, *columns)

    return content(after, False).unionByName(content(before, True))

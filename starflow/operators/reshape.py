"""Nested documents to flat rows.  Every operator here is narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.functions.fields import missing_fields


def unnest(docs: DataFrame, array: str, keep: Sequence[Column | str] = ()) -> DataFrame:
    """One row per object of an array of objects; none for an empty or NULL array."""
    return docs.select(*keep, F.inline(array))


def strict_rows(docs: DataFrame, array: str, schema: T.StructType, required: Sequence[str],
                keep: Sequence[Column | str] = ()) -> DataFrame:
    """``unnest`` over objects kept as JSON text that fails if a required key is absent.

    An explicit null counts as present; a field of an absent or null parent does not.
    """
    rows = docs.select(*keep, F.explode(array).alias("_text"))
    absent = missing_fields(F.col("_text"), required)
    message = F.concat(F.lit("missing fields: "), F.array_join(absent, ", "))
    checked = F.when(F.size(absent) == 0, F.col("_text")).otherwise(
        F.raise_error(message).cast("string"))
    parsed = F.from_json(checked, schema)
    kept = [c for c in rows.columns if c != "_text"]
    return rows.select(*kept, parsed.alias("_row")).select(*kept, "_row.*")


def zip_arrays(docs: DataFrame, arrays: Mapping[str, Column | str],
               keep: Sequence[Column | str] = ()) -> DataFrame:
    """Parallel arrays to rows by position; the shortest array ends the zip.

    ``arrays`` maps output column to array.  A NULL array counts as empty.
    """
    columns = [F.col(a) if isinstance(a, str) else a for a in arrays.values()]
    sizes = [F.when(c.isNull(), 0).otherwise(F.size(c)) for c in columns]
    shortest = F.least(*sizes) if len(sizes) > 1 else sizes[0]
    zipped = F.arrays_zip(*[F.slice(c, F.lit(1), shortest) for c in columns])
    return docs.select(*keep, F.inline(zipped).alias(*arrays))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def copy_column(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, F.col(source))


def project(df: DataFrame, *columns: Column | str) -> DataFrame:
    return df.select(*columns)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)

"""A layout by several keys at once, for look-ups that the layout by date does not serve.

Each key is cut into ranges that hold equal numbers of its distinct values, and the bits of the
ranges' numbers are dealt in turn into one number.  Rows near each other in it are near in every key,
so a file, and a row group in it, spans few values of each.  Bloom filters in the files rule out row
groups for a value that lies within their span.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CURVE = "_curve"


def interleaved(places: Sequence[Column], bits: int) -> Column:
    """One number of the lowest ``bits`` bits of each place, first the highest bit of each."""
    n = len(places)
    if n * bits > 62:
        raise ValueError("too many bits")
    single = [F.shiftleft(F.shiftright(p.cast("bigint"), b).bitwiseAND(F.lit(1)), b * n + n - 1 - i)
              for i, p in enumerate(places) for b in range(bits)]
    return reduce(lambda a, b: a + b, single)


def cut_points(df: DataFrame, column: str, pieces: int) -> list:
    """At most ``pieces - 1`` values that cut a column's distinct values evenly; of any type with an order."""
    ranges = df.select(column).where(F.col(column).isNotNull()).distinct().repartitionByRange(pieces, column)
    firsts = ranges.groupBy(F.spark_partition_id()).agg(F.min(column).alias("first")).select("first")
    return sorted(r[0] for r in firsts.collect())[1:]


def place(column: str, cuts: Sequence) -> Column:
    """The number of cut points at or below a value, found by halving; 0 for NULL."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(column) >= F.lit(cuts[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return F.coalesce(F.when(F.col(column).isNotNull(), search(0, len(cuts))), F.lit(0))


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], bits: int = 6,
                    bloom: Mapping[str, int] | None = None, row_group_bytes: int | None = None) -> None:
    """Store rows clustered by ``keys``, each cut into ``2 ** bits`` ranges, as a new folder.

    ``bloom`` names columns that get Bloom filters, with the distinct values to expect in a row group.
    Rows of one cell are spread by the keys themselves, so a hot cell becomes several files.  ``df`` is read
    once for each key and twice more: give a stored table.
    """
    places = [place(k, cut_points(df, k, 1 << bits)) for k in keys]
    clustered = (df.withColumn(_CURVE, interleaved(places, bits)).repartitionByRange(_CURVE, *keys)
                 .sortWithinPartitions(_CURVE, *keys).drop(_CURVE))
    writer = clustered.write
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    for column, values in (bloom or {}).items():
        writer = (writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{column}", values))
    writer.parquet(path)


def lookup(table: DataFrame, **values: object) -> DataFrame:
    """Rows with these values of their keys; plain equalities, which reach the files' statistics and filters."""
    for column, value in values.items():
        table = table.where(F.col(column).isNull() if value is None else F.col(column) == F.lit(value))
    return table

"""Backward as-of join: the newest right row at or before each left row.

Both sides are cut into time buckets per key and merged inside each bucket by
one sorted running ``last`` value, so work is linear and no pairs are formed.
What a bucket needs from before its start is a single carried row, found on a
table with one row per bucket.

Hot buckets are cut further, exactly: many right rows are sliced at quantiles of
their times, and many left rows in one slice are dealt out over salts, each of
which gets a copy of the slice's (by then few) right rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.session import stage

_TS, _BUCKET, _SLICE, _SALT = "_ts", "_bucket", "_slice", "_salt"
_LEFT, _RIGHT, _CUTS, _COPIES = "_left", "_right", "_cuts", "_copies"
_NL, _NR = "_left_rows", "_right_rows"
_SLICES = 256        # parts a hot bucket is cut into
_NULL_SPREAD = 1024  # groups over which left rows that cannot match are dealt out


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _sliced(df: DataFrame, group: list[str], cuts: DataFrame) -> DataFrame:
    below = F.size(F.filter(_CUTS, lambda cut: cut <= F.col(_TS)))
    number = F.when(F.col(_CUTS).isNull(), 0).otherwise(below)
    return df.join(cuts, group, "left").withColumn(_SLICE, number).drop(_CUTS)


def _cuts(right: DataFrame, group: list[str], hot: DataFrame) -> DataFrame:
    """Slice boundaries of the hot buckets: quantiles of their right rows' times."""
    points = F.array(*[F.lit(i / _SLICES) for i in range(1, _SLICES)])
    cuts = (right.select(*group, _TS).join(hot, group, "left_semi")
            .groupBy(*group).agg(F.percentile_approx(_TS, points).alias(_CUTS)))
    return stage(cuts, "asof_cuts")


def asof_join(left: DataFrame, right: DataFrame, ts: str, right_ts: str,
              by: Sequence[str] = (), tolerance_seconds: float | None = None,
              bucket_seconds: int = 86_400, max_rows: int = 2_000_000) -> DataFrame:
    """Left as-of join; the right side's columns are NULL where nothing matches.

    ``right`` must be unique on ``by`` and its time, and its other column names
    must differ from the left's.  ``max_rows`` is the size from which a bucket
    counts as hot.
    """
    by = list(by)
    payload = [c for c in right.columns if c not in by]
    width = bucket_seconds * 1_000_000
    group = [*by, _BUCKET]
    part = [*group, _SLICE]
    bucket = F.floor(F.col(_TS) / width).cast("bigint")

    r = (right.dropna(subset=[*by, right_ts])
         .select(*by, _micros(right_ts).alias(_TS), F.struct(*payload).alias(_RIGHT))
         .withColumn(_BUCKET, bucket))
    l = left.select(*by, _micros(ts).alias(_TS), F.struct(*left.columns).alias(_LEFT))
    l = l.withColumn(_BUCKET, bucket)

    end = [F.max_by(_RIGHT, _TS).alias(_RIGHT), F.count("*").alias(_NR)]
    ends = stage(r.groupBy(*group).agg(*end), "asof_ends")
    many = ends.where(F.col(_NR) > max_rows).select(*group)
    if many.isEmpty():
        r, l, ends = (df.withColumn(_SLICE, F.lit(0)) for df in (r, l, ends))
    else:
        cuts = _cuts(r, group, many)
        r, l = _sliced(r, group, cuts), _sliced(l, group, cuts)
        ends = r.groupBy(*part).agg(*end)

    # One row per bucket (slice) that holds left rows: its size and carried row.
    left_sizes = l.groupBy(*part).agg(F.count("*").alias(_NL))
    earlier = (Window.partitionBy(*(by or [F.lit(0)])).orderBy(_BUCKET, _SLICE)
               .rowsBetween(Window.unboundedPreceding, -1))
    # Without a key all buckets share one window, of one row per bucket.
    # A salt takes at least as many left rows as it copies right rows.
    share = F.greatest(F.lit(max_rows), F.coalesce(_NR, F.lit(0)))
    parts = stage(
        left_sizes.join(ends, part, "full")
        .withColumn(_RIGHT, F.last(_RIGHT, ignorenulls=True).over(earlier))
        .where(F.col(_NL).isNotNull())
        .withColumn(_COPIES, F.ceil(F.col(_NL) / share).cast("int"))
        .drop(_NL, _NR),
        "asof_parts")
    carried = (parts.where(F.col(_RIGHT).isNotNull())
               .select(*part, F.lit(None).cast("bigint").alias(_TS), _RIGHT, _COPIES))
    hot = parts.where(F.col(_COPIES) > 1).select(*part, _COPIES)

    # A left row with a NULL key or time matches nothing: any group will do.
    unmatchable = F.greatest(*[F.col(c).isNull() for c in [*by, _TS]], F.lit(False))
    if hot.isEmpty():
        r = r.withColumn(_COPIES, F.lit(1))
        spread = F.pmod(F.xxhash64(_LEFT), F.lit(_NULL_SPREAD))
        l = l.withColumn(_SALT, F.when(unmatchable, spread.cast("int")).otherwise(0))
    else:
        r = r.join(hot, part, "left").fillna(1, [_COPIES])
        groups = F.when(unmatchable, _NULL_SPREAD).otherwise(F.coalesce(_COPIES, F.lit(1)))
        dealt = (F.monotonically_increasing_id() % groups).cast("int")
        # Stored, so a lost executor cannot deal the same row out differently.
        l = stage(l.join(hot, part, "left").withColumn(_SALT, dealt).drop(_COPIES), "asof_left")
    r = r.unionByName(carried).withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.col(_COPIES) - 1)))

    columns = [*part, _SALT, _TS]
    merged = (l.select(*columns, _LEFT)
              .unionByName(r.select(*columns, _RIGHT), allowMissingColumns=True))
    # Carried rows (no time) come first; at equal times right rows precede left ones.
    so_far = (Window.partitionBy(*part, _SALT)
              .orderBy(F.asc_nulls_first(_TS), F.col(_LEFT).isNotNull())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    match = F.last(_RIGHT, ignorenulls=True).over(so_far)
    joined = merged.withColumn(_RIGHT, match).where(F.col(_LEFT).isNotNull())
    if tolerance_seconds is not None:
        age = F.col(_TS) - F.unix_micros(F.col(f"{_RIGHT}.{right_ts}").cast("timestamp"))
        joined = joined.withColumn(
            _RIGHT, F.when(age <= int(tolerance_seconds * 1_000_000), F.col(_RIGHT)))
    return joined.select(f"{_LEFT}.*", f"{_RIGHT}.*")

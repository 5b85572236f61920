"""Fact tables that are corrected after the fact.

Rows lie by date, each key once, with the file they came from.  A row that comes again from a later
file does not touch what is stored: it goes to a small file of corrections beside the rows of its
day.  Readers take the newest of each key, and ``compact`` folds the corrections in.  Which row is
newest depends on the rows alone, so any split of the same documents into loads gives the same
table.  Numbers are handed out once, from a mark that is committed with the rows, and stay.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.operators.dedupe import latest_per_key
from starflow.operators.keys import dense_key
from starflow.session import stage
from starflow.sources.snapshots import NO_DATE, Load, Part, Snapshot, read_parts
from starflow.sources.tables import write_by_date

FILE_BYTES = 256 << 20
_SEEN, _BEFORE, _NUMBER = "_seen", "_before", "_number"


@dataclass(frozen=True)
class FactTable:
    """How a fact table is kept.

    ``columns`` are its own; ``origin`` says which of two rows of one ``key`` is newer, and what is
    left undecided goes by the other columns in order, those in ``filled`` last: they may be known
    later than the row, and a row that has them counts as newer.
    """

    name: str
    columns: T.StructType
    key: Sequence[str]
    origin: T.StructType
    filled: Sequence[str] = ()
    number: str | None = None
    time: str = "timestamp"

    @property
    def corrections(self) -> str:
        return f"{self.name}_corrections"

    @property
    def stored(self) -> T.StructType:
        numbered = [T.StructField(self.number, T.LongType())] if self.number else []
        return T.StructType([*numbered, *self.columns.fields, *self.origin.fields, T.StructField("date", T.DateType())])

    @property
    def order(self) -> list[str]:
        """What is compared of two rows of a key."""
        plain = [c for c in self.columns.names if c not in self.key and c not in self.filled]
        return [*self.origin.names, *plain, *self.filled]

    @property
    def layout(self) -> list[str]:
        """Stations together within a day, in the order of time."""
        return [*[k for k in self.key if k != self.time], *[k for k in self.key if k == self.time]]

    @property
    def compared(self) -> list[str]:
        """The key with the time first: rows are sorted by numbers that hardly repeat, not by the few stations' names."""
        return sorted(self.key, key=lambda k: k != self.time)

    def newest(self, rows: DataFrame) -> DataFrame:
        """One row for each key; the same one however the rows are split."""
        rest = [self.number] if self.number and self.number in rows.columns else []
        ordered = rows.select(*self.key, *self.order, "date", *rest)
        return latest_per_key(ordered, self.compared, self.order).select(*[c for c in rows.columns if c in ordered.columns])

    def read(self, spark: SparkSession, state: Snapshot, days: Sequence[date | str | None] | None = None) -> DataFrame:
        """All rows as corrected, or those of some days.

        Only days with corrections are joined; of the others the files are read and no more.
        """
        rows, fixes = state.parts.get(self.name, {}), state.parts.get(self.corrections, {})
        wanted = list(rows) if days is None else [k for k in map(day_key, days) if k in rows]
        plain, touched = [k for k in wanted if k not in fixes], [k for k in wanted if k in fixes]
        clean = state.rows(spark, self.name, self.stored, plain)
        if not touched:
            return clean
        base = state.rows(spark, self.name, self.stored, touched)
        later = state.rows(spark, self.corrections, self.stored, touched)
        # Corrections are few, so the planner sends their keys to the rows and not the other way.
        keys = later.select(*self.key).distinct()
        same = _same(base, keys, self.compared)
        left, hit = base.join(keys, same, "left_anti"), base.join(keys, same, "left_semi")
        found = self.newest(hit.unionByName(later)).select(*self.stored.names)
        resolved = left.unionByName(found)
        return clean.unionByName(resolved) if plain else resolved

    def merge(self, load: Load, batch: DataFrame) -> tuple[int, int]:
        """Add the batch's rows: those of new keys as rows, newer ones of known keys as corrections.

        Anything else changes nothing, so a batch may come again, or in another order.
        Returns how many rows and corrections were added.
        """
        spark = load.spark
        given = batch.withColumn("date", F.to_date(self.time))
        names = [c for c in self.stored.names if c != self.number]
        rows = stage(self.newest(given.select(*names)), f"{self.name}-batch")
        # One value for each calendar day of the batch.
        days = [r[0] for r in rows.select("date").distinct().collect()]
        known = [k for k in map(day_key, days) if k in load.state.parts.get(self.name, {})]
        if known:
            before = self.read(spark, load.state, known)
            # Only the keys of the batch; the planner may filter the scan by them.
            before = before.join(rows.select(*self.key), _same(before, rows, self.compared), "left_semi")
            number = F.col(self.number) if self.number else F.lit(None).cast("bigint")
            before = before.select(*self.key, F.struct(*self.order).alias(_BEFORE), number.alias(_NUMBER), F.lit(True).alias(_SEEN))
            old = before.withColumnsRenamed({k: f"_{k}" for k in self.key})
            same = [rows[k].eqNullSafe(old[f"_{k}"]) for k in self.compared]
            judged = stage(rows.join(old, same, "left").drop(*(f"_{k}" for k in self.key))
                           .where(F.col(_SEEN).isNull() | (F.struct(*self.order) > F.col(_BEFORE)))
                           .drop(_BEFORE), f"{self.name}-judged")
        else:
            judged = rows.withColumns({_NUMBER: F.lit(None).cast("bigint"), _SEEN: F.lit(None).cast("boolean")})
        counts = judged.agg(F.count_if(F.col(_SEEN).isNull()).alias("new"), F.count_if(F.col(_SEEN)).alias("newer")).first()
        if counts["new"]:
            fresh = judged.where(F.col(_SEEN).isNull()).select(*names)
            if self.number:
                mark = load.marks.get(self.number, 0)
                fresh = dense_key(fresh, self.number, self.compared, start=mark + 1)
                load.marks[self.number] = mark + counts["new"]
            load.add_dated(self.name, lambda path: write_by_date(fresh.select(*self.stored.names), path, "date", self.layout))
        if counts["newer"]:
            newer = judged.where(_SEEN)
            if self.number:
                newer = newer.withColumn(self.number, F.col(_NUMBER))
            self._correct(load, newer)
        return counts["new"], counts["newer"]

    def _correct(self, load: Load, rows: DataFrame) -> None:
        load.add_dated(self.corrections, lambda path: write_by_date(
            rows.select(*self.stored.names), path, "date", self.layout))

    def fill(self, load: Load, days: Sequence[date], filled) -> DataFrame | None:
        """Store what has become known of stored rows of ``days``; only changed rows are written.

        ``filled`` takes the rows without the columns in ``filled`` and adds them.  Returns the changed
        rows, None if there are none.
        """
        known = [k for k in map(day_key, days) if k in load.state.parts.get(self.name, {})]
        if not known:
            return None
        before = self.read(load.spark, load.state, known)
        old = [F.col(c).alias(f"_old_{c}") for c in self.filled]
        found = filled(before.select(*[c for c in self.stored.names if c not in self.filled], *old))
        changed = F.struct(*self.filled) > F.struct(*(F.col(f"_old_{c}").alias(c) for c in self.filled))
        rows = stage(found.where(changed).select(*self.stored.names), f"{self.name}-filled")
        if rows.isEmpty():
            return None
        self._correct(load, rows)
        return rows

    def compact(self, load: Load, target_bytes: int = FILE_BYTES) -> list[str]:
        """Rewrite the small files of each day into files of about ``target_bytes``; returns the days.

        A day with corrections is rewritten whole, with them folded in.  Of any other day only the
        parts that have small files are, and only if that gives fewer files.  Rows stay in their order.
        """
        spark, state = load.spark, load.state
        rows, fixes = state.parts.get(self.name, {}), state.parts.get(self.corrections, {})
        chosen: dict[str, list[Part]] = {}
        for day, parts in rows.items():
            small = [p for p in parts if p.files and p.bytes < p.files * target_bytes // 2]
            if day in fixes:
                chosen[day] = list(parts)
            elif sum(p.files for p in small) > math.ceil(sum(p.bytes for p in small) / target_bytes):
                chosen[day] = small
        if not chosen:
            return []
        corrected = [d for d in chosen if d in fixes]
        whole = self.read(spark, state, corrected) if corrected else None
        others = [p for d, ps in chosen.items() if d not in fixes for p in ps]
        plain = read_parts(spark, state.root, self.name, others, self.stored) if others else None
        every = plain if whole is None else whole if plain is None else whole.unionByName(plain)
        # Ranges hold equal numbers of rows: a large day is cut into several, small ones share one.
        files = sum(max(1, math.ceil(sum(p.bytes for p in ps) / target_bytes)) for ps in chosen.values())
        ordered = every.repartitionByRange(files, "date", *self.layout).sortWithinPartitions("date", *self.layout)
        for day, parts in chosen.items():
            load.drop_parts(self.name, day, parts)
            if day in fixes:
                load.drop_parts(self.corrections, day)
        load.add_dated(self.name, lambda path: ordered.write.partitionBy("date").parquet(path))
        return sorted(chosen)

    def days(self, state: Snapshot) -> list[date]:
        return sorted(date.fromisoformat(k) for k in state.parts.get(self.name, {}) if k != NO_DATE)


def day_key(day: date | str | None) -> str:
    """A day as folders name it."""
    return NO_DATE if day is None else day if isinstance(day, str) else day.isoformat()


def _same(left: DataFrame, right: DataFrame, key: Sequence[str]) -> list[Column]:
    return [left[k].eqNullSafe(right[k]) for k in key]

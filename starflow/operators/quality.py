"""Declared constraints: checks that report rows, and conforming to a schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

VIOLATIONS = "violations"


def pk_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that are repeated or hold a NULL, with their row count ``n``."""
    null_key = F.greatest(*[F.col(k).isNull() for k in key], F.lit(False))
    return (df.groupBy(*key).agg(F.count("*").alias("n"))
            .where((F.col("n") > 1) | null_key))


def fk_orphans(df: DataFrame, parent: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Rows whose non-NULL foreign key (``{column: parent column}``) has no parent."""
    child = df
    for name in columns:
        child = child.where(F.col(name).isNotNull())
    # An anti join needs no distinct parents, and only a plain shuffle lets a hot key be split.
    parents = parent.select(*[F.col(p).alias(c) for c, p in columns.items()])
    return child.join(parents, list(columns), "left_anti").select(*df.columns)


def _breaches(not_null: Sequence[str], max_length: Mapping[str, int] | None) -> dict[str, Column]:
    """Reason to condition, each TRUE or FALSE."""
    breaches = {f"{c} is null": F.col(c).isNull() for c in not_null}
    for c, n in (max_length or {}).items():
        breaches[f"{c} longer than {n}"] = F.coalesce(F.char_length(c) > n, F.lit(False))
    return breaches


def valid_rows(df: DataFrame, not_null: Sequence[str] = (),
               max_length: Mapping[str, int] | None = None) -> DataFrame:
    """Rows that break nothing.  Plain predicates, which reach the scan."""
    return reduce(lambda rows, breach: rows.where(~breach),
                  _breaches(not_null, max_length).values(), df)


def quarantined_rows(df: DataFrame, not_null: Sequence[str] = (),
                     max_length: Mapping[str, int] | None = None) -> DataFrame:
    """The other rows, with all their reasons in ``violations``."""
    breaches = _breaches(not_null, max_length)
    broken = reduce(or_, breaches.values(), F.lit(False))
    reasons = F.array(*[F.when(breach, F.lit(reason)) for reason, breach in breaches.items()])
    return df.where(broken).withColumn(
        VIOLATIONS, F.array_compact(reasons).cast("array<string>"))


def checked(df: DataFrame, key: Sequence[str] = (), not_null: Sequence[str] = (),
            max_length: Mapping[str, int] | None = None) -> DataFrame:
    """Rows that break each rule, as ``rule`` and ``violations``, from one pass over the table.

    ``primary key`` counts the keys that are repeated or hold a NULL.  Each map task
    sends a row for each key it has seen, with the counts of all rules.
    """
    breaches = _breaches(not_null, max_length)
    counts = [F.count_if(b).alias(f"_rule{i}") for i, b in enumerate(breaches.values())]
    if key:
        null_key = F.greatest(*[F.col(k).isNull() for k in key], F.lit(False))
        by_key = df.groupBy(*key).agg(F.count("*").alias("_n"), *counts)
        sums = [F.coalesce(F.sum(f"_rule{i}"), F.lit(0)) for i in range(len(breaches))]
        names, sums = ["primary key", *breaches], [F.count_if((F.col("_n") > 1) | null_key), *sums]
    else:
        by_key, names, sums = df, list(breaches), [F.count_if(b) for b in breaches.values()]
    lines = F.array(*[F.struct(F.lit(n).alias("rule"), c.alias("violations")) for n, c in zip(names, sums)])
    return by_key.agg(lines.alias("_lines")).select(F.inline("_lines"))


def observed(df: DataFrame, not_null: Sequence[str] = (),
             max_length: Mapping[str, int] | None = None) -> tuple[DataFrame, Observation]:
    """``df`` and counts of its rows and of what breaks each rule, made while ``df`` is written.

    The counts are in the observation's ``get`` once a job has run over all of ``df``, which costs no pass of
    its own.
    """
    watch = Observation()
    counts = [F.count_if(b).alias(reason) for reason, b in _breaches(not_null, max_length).items()]
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *counts), watch


def conform(df: DataFrame, table: T.StructType,
            renames: Mapping[str, str] | None = None) -> DataFrame:
    """Exactly the declared columns, in order and type.

    A missing column becomes NULL, and so does a value that does not fit; ``misfits``
    finds the rows with such values.
    """
    renamed = df.withColumnsRenamed(dict(renames or {}))
    columns = []
    for field in table.fields:
        value = F.col(field.name) if field.name in renamed.columns else F.lit(None)
        columns.append(value.try_cast(field.dataType).alias(field.name))
    return renamed.select(*columns)


def misfits(df: DataFrame, table: T.StructType,
            renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rows with values that ``conform`` cannot keep, each as ``column: text`` in ``violations``."""
    renamed = df.withColumnsRenamed(dict(renames or {}))
    # A value that has its type already fits.
    kinds = {f.name: f.dataType for f in renamed.schema.fields}
    lost = {f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
            for f in table.fields if kinds.get(f.name, f.dataType) != f.dataType}
    texts = [F.when(gone, F.concat_ws(": ", F.lit(name), F.col(name).cast("string"))) for name, gone in lost.items()]
    found = F.array_compact(F.array(*texts)).cast("array<string>")
    return renamed.where(reduce(or_, lost.values(), F.lit(False))).withColumn(VIOLATIONS, found)

"""Optional and required fields of nested documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def optional(path: str, default: object = None) -> Column:
    """A nested field; NULL (or ``default``) when any step of the path is missing."""
    col = F.col(path)
    return col if default is None else F.coalesce(col, F.lit(default))


def missing_fields(text: Column, paths: Sequence[str]) -> Column:
    """Those of ``paths`` (``a`` or ``parent.a``) whose key is absent from a JSON object.

    Works on the JSON text, where an absent key and an explicit null differ.
    """
    by_parent: dict[str, list[str]] = {}
    for path in paths:
        parent, _, leaf = path.rpartition(".")
        by_parent.setdefault(parent, []).append(leaf)
    absent = []
    for parent, leaves in by_parent.items():
        node = F.get_json_object(text, f"$.{parent}") if parent else text
        keys = F.coalesce(F.json_object_keys(node), F.array().cast("array<string>"))
        prefix = f"{parent}." if parent else ""
        wanted = F.array_except(F.array(*[F.lit(leaf) for leaf in leaves]), keys)
        absent.append(F.transform(wanted, _prepend(prefix)))
    return F.concat(*absent)


def _prepend(prefix: str):
    return lambda key: F.concat(F.lit(prefix), key)

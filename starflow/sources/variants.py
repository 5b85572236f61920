"""Raw documents kept as VARIANT: parsed once, stored typed, read by path.

A field that the declared schema does not name yet can be read later without parsing the text
again, and a field that is absent is told from one that is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOCUMENT, TEXT = "document", "text"


def parse_documents(texts: DataFrame, text: str = "value") -> DataFrame:
    """``document`` as a variant, and the text of those that are no JSON in ``text``, else NULL.

    The other columns stay.  A NULL text is a NULL document.
    """
    parsed = F.try_parse_json(F.col(text))
    kept = [c for c in texts.columns if c != text]
    return texts.select(*kept, parsed.alias(DOCUMENT), F.when(parsed.isNull(), F.col(text)).alias(TEXT))


def part(value: Column | str, path: str) -> Column:
    """What stands at a path, as a variant: SQL NULL if absent, a variant null if null."""
    return F.try_variant_get(value, f"$.{path}", "variant")


def field(value: Column | str, path: str, kind: str) -> Column:
    """A field's value; NULL if absent, null or of another kind."""
    return F.try_variant_get(value, f"$.{path}", kind)


def state(value: Column | str, path: str) -> Column:
    """``absent``, ``null`` or ``present``."""
    at = part(value, path)
    return F.when(at.isNull(), "absent").when(F.is_variant_null(at), "null").otherwise("present")


def elements(docs: DataFrame, path: str, name: str = "element", keep: Sequence[Column | str] = ()) -> DataFrame:
    """A row for each element of the array at a path, as a variant; none where there is no array."""
    return docs.select(*keep, F.explode(F.try_variant_get(DOCUMENT, f"$.{path}", "array<variant>")).alias(name))


def strict_elements(docs: DataFrame, path: str, required: Sequence[str], name: str = "element",
                    keep: Sequence[Column | str] = ()) -> DataFrame:
    """``elements`` that fails on an element without one of the ``required`` fields; null counts as there."""
    rows = elements(docs, path, name, keep)
    absent = F.array_compact(F.array(*[F.when(part(name, p).isNull(), F.lit(p)) for p in required]))
    message = F.concat(F.lit("missing fields: "), F.array_join(absent, ", "))
    whole = F.when(F.size(absent) == 0, F.col(name)).otherwise(F.raise_error(message).cast("variant"))
    return rows.withColumn(name, whole)

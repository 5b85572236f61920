"""Raw JSON documents: read them with a declared schema, land them append-only."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.schemas import CORRUPT

FILE, MODIFIED = "_file", "_modified"
LANDED = "landed"


def _reader_options(multi_line: bool) -> dict[str, str]:
    return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
            "multiLine": str(multi_line).lower()}


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def with_origin(docs: DataFrame) -> DataFrame:
    """Add the file each document came from and when it was written."""
    return docs.withColumns({FILE: F.col("_metadata.file_path"),
                             MODIFIED: F.col("_metadata.file_modification_time")})


def read_documents(spark: SparkSession, path: str | list[str], schema: T.StructType,
                   multi_line: bool = True, modified_after: str | None = None) -> DataFrame:
    """One row per document of a folder or of a list of files, plus its origin.

    ``multi_line=True`` is for pretty-printed captures, one document per file;
    small files are packed into common tasks, a file is never split.
    ``multi_line=False`` is for landed JSON lines, which split freely.
    ``modified_after`` (``yyyy-MM-ddTHH:mm:ss``, UTC) skips files already taken.
    A document that does not parse in full has its text in ``_corrupt_record``.
    """
    if not path:
        origin = [T.StructField(FILE, T.StringType()), T.StructField(MODIFIED, T.TimestampType())]
        return spark.createDataFrame([], T.StructType([*with_corrupt(schema).fields, *origin]))
    reader = spark.read.schema(with_corrupt(schema)).options(**_reader_options(multi_line))
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after).option("timeZone", "UTC")
    return with_origin(reader.json(path)).select(*with_corrupt(schema).names, FILE, MODIFIED)


def stream_documents(spark: SparkSession, path: str, schema: T.StructType,
                     multi_line: bool = True, max_files: int | None = None) -> DataFrame:
    """The same documents as a stream over a growing landing directory."""
    reader = (spark.readStream.schema(with_corrupt(schema))
              .options(**_reader_options(multi_line)))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_origin(reader.json(path))


def readable(docs: DataFrame) -> DataFrame:
    """What could be parsed: an ill-typed field is NULL, a broken document all NULL.

    One bad field does not cost a document its other stations, and a broken
    document unnests to no rows.
    """
    return docs.drop(CORRUPT)


def objects_and_damage(docs: DataFrame, array: str, keep: Sequence[Column | str] = ()) -> DataFrame:
    """One row per object of an array, and one with the text of each document that did not parse in full.

    The latter has only ``keep`` and ``_corrupt_record``, the former no ``_corrupt_record``.
    One pass over the documents gives both.
    """
    kind = docs.select(F.col(array).alias("a")).schema["a"].dataType
    damage = F.when(F.col(CORRUPT).isNotNull(), F.array(F.struct(
        F.lit(None).cast(kind.elementType).alias("_object"), F.col(CORRUPT).alias(CORRUPT))))
    objects = F.transform(F.col(array), lambda item: F.struct(
        item.alias("_object"), F.lit(None).cast("string").alias(CORRUPT)))
    both = F.flatten(F.array_compact(F.array(objects, damage)))
    rows = docs.select(*keep, F.explode(both).alias("_piece"))
    kept = [c for c in rows.columns if c != "_piece"]
    return rows.select(*kept, "_piece._object.*", f"_piece.{CORRUPT}")


def damaged(docs: DataFrame) -> DataFrame:
    """Documents that did not parse in full, as text with their origin."""
    content = [c for c in docs.columns if c not in (CORRUPT, FILE, MODIFIED)]
    # Spark sets the corrupt column only while it parses some other column too.
    parsed = F.to_json(F.struct(*content)).isNotNull()
    return docs.where(F.col(CORRUPT).isNotNull() & parsed).select(CORRUPT, FILE, MODIFIED)


def land_documents(docs: DataFrame, path: str, day: date | None = None) -> None:
    """Add documents to the landing directory as JSON lines; earlier files stay.

    With ``day`` they go to its folder, ``landed=<day>``, so that no folder grows without end.
    """
    path = path if day is None else f"{path}/{LANDED}={day.isoformat()}"
    (docs.write.mode("append").option("ignoreNullFields", "true")
         .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
         .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path))

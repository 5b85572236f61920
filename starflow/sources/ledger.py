"""A ledger of the files that were taken, so that each is taken once whatever its time says.

The landing directory is listed, which reads no file, and the listing is anti-joined with the ledger.
A file that was written anew under its old name has another length or time and is taken again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.operators.reshape import union_all
from starflow.schemas import LONG, TEXT, TIME, fields

FILES = fields(source=TEXT, path=TEXT, length=LONG, modified=TIME)


def listing(spark: SparkSession, source: str, path: str, modified_after: str | None = None) -> DataFrame:
    """Every file below ``path``, in its ``landed=`` folders too, with its length and time."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after).option("timeZone", "UTC")
    # Only columns that the listing knows: no content is read.
    return reader.load(path).select(
        F.lit(source).alias("source"), "path", "length", F.col("modificationTime").alias("modified"))


def untaken(spark: SparkSession, sources: Mapping[str, str], taken: DataFrame,
            modified_after: str | None = None) -> DataFrame:
    """Files of the sources' folders that are not in ``taken``."""
    files = union_all([listing(spark, name, path, modified_after) for name, path in sources.items()])
    return files.join(taken, FILES.names, "left_anti")


def paths(files: DataFrame) -> dict[str, list[str]]:
    """Paths by source, for a reader, which keeps a list of the files it reads on the driver anyway."""
    found: dict[str, list[str]] = {}
    for row in files.orderBy("path").toLocalIterator():
        found.setdefault(row["source"], []).append(row["path"])
    return found

"""Words, hashes and batches of text as numpy arrays, for code that runs inside tasks.

A text is handled as its UTF-8 bytes.  The white space that separates words is
ASCII, so a byte of another character never looks like it.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Texts are worked on in groups of about so many bytes, which bounds a task's memory;
#: a longer text is a group of its own.
GROUP_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

# An odd multiplier has an inverse modulo 2**64, so the hash of any run of bytes
# follows from two prefix sums.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def prepare_workers(spark: SparkSession, rows: int = 2000) -> None:
    """Send this package to the executors' Python, and bound the rows of the batches it gets.

    Spark itself bounds their bytes, by ``spark.sql.execution.arrow.maxBytesPerBatch``.

    Spark hands the archive to executors itself, as it does for ``--py-files``, so they
    need not have the package installed.
    """
    context = spark.sparkContext
    if not getattr(context, "_starflow_sent", False):
        root = Path(__file__).resolve().parents[1]
        # Holds code alone, and goes with the session's context.
        context._starflow_code = tempfile.TemporaryDirectory(prefix="starflow-code-")
        archive = Path(context._starflow_code.name) / "starflow.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(str(archive))
        context._starflow_sent = True
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) not in range(1, rows + 1):
        spark.conf.set(name, str(rows))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all their bits depend on all of the input's."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(size, base)
            factors[0] = 1
            _powers[i] = np.multiply.accumulate(factors)
    return _powers


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each row's bounds in them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def groups(bounds: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Cut rows into runs of at most ``limit`` bytes, or of one row."""
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return _LOWER[data]


def spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word, words being runs without white space."""
    inside = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | first[1:-1]
    closes[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(bounds, starts, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal spans have equal hashes anywhere."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, and the number of words of each row."""
    data = lower(data)
    starts, ends, row = spans(data, bounds)
    return hashes(data, starts, ends), np.bincount(row, minlength=len(bounds) - 1)


def crc32_mod(column: str, n: int) -> Column:
    """crc32 of a column's value as text, modulo ``n``; null is taken as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n

"""Helpers the operators of this package share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: A word is what stands between these bytes: bytes.split() without arguments splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def utf8(column: pa.Array) -> list[bytes]:
    """A string column as bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


#: Settings of Spark for batches to Python: its default, ours.
_BATCH = (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1500"), ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8388608b"))
#: Bytes of a batch that a task works on at once, about.
AT_ONCE = 8 << 20


def parts(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of a bounded size (a row at least), so that what is made of it is small too."""
    rows = max(1, b.num_rows * AT_ONCE // max(b.nbytes, 1))
    for i in range(0, b.num_rows, rows):
        yield b.slice(i, rows)


def hand_back() -> None:
    """Give memory that isn't in use back to the system: workers live on between tasks, beside the JVM."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(spark: SparkSession) -> None:
    """Rows for Python in batches of some MB: those of the default 10,000 texts take hundreds of MB beside an executor's
    heap. A session's own setting stays."""
    for key, default, own in _BATCH:
        if spark.conf.get(key) == default:
            spark.conf.set(key, own)


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow by a function of one batch."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in parts(b):
                if (out := f(part)) is not None:
                    yield out
        hand_back()

    small_batches(df.sparkSession)
    return df.mapInArrow(each, schema)


def batch(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def longs(values) -> pa.Array:
    return pa.array(values, pa.int64())


def plain_names(docs: DataFrame, *used: str) -> tuple[DataFrame, list[str]]:
    """The table with its columns named c0, c1 and so on, and what the columns `used` are called in it, so that columns may
    have any name and none clashes with an operator's own."""
    names = docs.columns
    return docs.toDF(*(f"c{i}" for i in range(len(names)))), [f"c{names.index(c)}" for c in used]

"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import clean, remove, scratch

#: A new folder's path below the folder that driver and executors share, what removes it, and what removes all of the session's.
shared_dir, drop_stored, drop_all = scratch, remove, clean

#: A-Z to a-z, and nothing else: the case folding of the line and shingle keys.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Removes a query's shuffle files when it has ended, instead of when the driver collects its garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting that holds while something runs, and is put back then."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written and reread Parquet table in the shared folder.

    Unlike a local checkpoint it survives the loss of any executor, and it ends
    the lineage, so that nothing above is computed twice and its shuffle files
    can go at once.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    with setting(spark, CLEAN_UP, "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables of :func:`stored` that nothing reads any more."""
    for df in tables:
        drop_stored(df.sparkSession, df.stored_at)


#: Bytes of an Arrow batch between Spark and its Python workers where rows are long.
BATCH_BYTES = 8 << 20


def long_rows(spark: SparkSession) -> None:
    """Lets the session send Arrow batches of at most ``BATCH_BYTES``, so that workers' memory stays bounded.

    Queries and pipelines over whole texts call it; a smaller setting stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    digits = "".join(c for c in spark.conf.get(name, None) or "" if c.isdigit())
    if not digits or int(digits) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def column(name: str) -> Column:
    """The column of this very name, dots and quotes in it included."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(col):
    return F.translate(col, UPPER, LOWER)


def texts_of(column: pa.Array | pa.ChunkedArray) -> Iterator[str]:
    """The column's strings; null counts as empty."""
    for value in column.to_pylist():
        yield value or ""


def release_memory() -> None:
    """Gives memory that a task has freed back to the system: Python workers live on and go on to other stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that each holds about ``max_bytes`` of text, or one row.

    Rows with very long texts thus never meet in one batch, whatever the
    session's batch size is; no row is cut or lost.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        part = (np.cumsum(sizes) - sizes) // max_bytes
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
    release_memory()

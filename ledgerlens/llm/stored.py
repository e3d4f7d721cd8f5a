"""Intermediate tables in the shared folder."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from ledgerlens.session import scratch_path


def bucketed(df: DataFrame, buckets: int, key: str) -> DataFrame:
    """``df`` stored in buckets of ``key``, so that grouping by it needs no shuffle.

    The catalog entry goes at once; the files stay in the shared folder.
    """
    spark = df.sparkSession
    name = f"llm_{uuid4().hex}"
    path = scratch_path(spark, "buckets")
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    table = spark.table(name)
    table.schema  # noqa: B018  resolves the table before its name goes
    spark.sql(f"DROP TABLE {name}")
    return table


def squeeze(values: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values)


def expand(values: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(values)


def give_back() -> None:
    """Returns freed memory to the system: Python workers wait for their next task, and keep what they once needed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def giving_back(batches: Iterator) -> Iterator:
    """``batches``, with ``give_back`` after each and when they end."""
    try:
        for batch in batches:
            yield batch
            del batch
            give_back()
    finally:
        give_back()

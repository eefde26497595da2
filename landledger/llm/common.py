"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger.session import discard, materialize, scratch_path, settled  # noqa: F401  used by the operators


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def spread(column: str | Column, parts: int) -> Column:
    """A bucket number that depends on the value only."""
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")


def parts_for(amount: int, each: int, least: int = 1) -> int:
    """Number of parts so that each holds about ``each`` of ``amount``."""
    return max(least, -(-int(amount) // each))


def give_back() -> None:
    """Return freed memory to the system: Python workers live on after a task, and so do the pools of their allocators."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that gives its memory back when its task ends."""

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped

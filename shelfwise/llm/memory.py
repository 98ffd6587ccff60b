"""Giving back memory when a task ends: Python workers are used again, by other stages too."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

from shelfwise.llm.words import forget


def release() -> None:
    """Return what the Arrow pool and the C heap no longer use to the system."""
    forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library has no such call, and needs none
        pass


def released(run: Callable, *clear: Callable[[], None]) -> Callable:
    """The same function over batches, which calls ``clear`` and gives memory back at its end."""

    def bounded(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            for drop in clear:
                drop()
            release()

    return bounded


#: Rows of an Arrow batch of whole texts; the default of Spark puts a task's texts into one.
TEXT_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> Iterator[None]:
    """Steps that run inside hand whole texts to Python in batches of ``rows`` at most."""
    before = spark.conf.get(_BATCH)
    if not 0 < int(before) <= rows:
        spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def fresh(taken: list[str], *names: str) -> list[str]:
    """Column names like ``names`` that are not among ``taken``; Spark reads names without their case."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out

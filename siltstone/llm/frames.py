"""Small helpers shared by the operators: Arrow batches, columns, intermediate tables."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.session import discard, materialise

__all__ = ["bounded_batches", "discard", "ints", "kept", "map_batches", "materialise", "name", "read_table", "release", "task_count"]

#: Rows and bytes of the Arrow batches handed to Python.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that Python workers need little memory.

    Very long texts make a batch of fewer rows.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def kept() -> dict:
    """What this Python worker keeps from task to task."""
    return sys.modules.setdefault("_siltstone_worker", ModuleType("_siltstone_worker")).__dict__.setdefault("kept", {})


def release(owner: str = "") -> None:
    """Hand memory of a worker's earlier tasks back to the system; a worker runs many tasks.

    What it keeps goes too, unless the operator `owner` keeps it.
    """
    held = kept()
    if held.get("owner") != owner:
        held.clear()
        held["owner"] = owner
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries than glibc have none
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], dict[str, pa.Array]], schema: str) -> DataFrame:
    """One Arrow batch in, one out; empty batches are passed over."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            if batch.num_rows:
                out = pa.RecordBatch.from_pydict(f(batch))
                if out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def name(df: DataFrame, wish: str) -> str:
    """A column name that `df` doesn't have yet, so callers' columns never clash."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def ints(values) -> pa.Array:
    return pa.array(values, pa.int64())


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def task_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc32_of_id(column: str) -> Column:
    """crc32 of an id written as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))

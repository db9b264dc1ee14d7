"""Where intermediate tables go, and when a join side may be broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from . import files


def configure(spark: SparkSession) -> SparkSession:
    """Settings that the library's functions expect of a session."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")  # of a key that occurs twice, the last value counts
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a local session (tests) may fall back to a folder of its own; on a
    cluster every executor must see the same folder, so an unset value is an
    error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="siltstone-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage by writing `df` to the shared folder and reading it back."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._folder = path  # for `discard`
    return table


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that `materialise` gave. Whatever still reads them,
    even through other DataFrames, must have been materialised itself."""
    for table in tables:
        files.delete(table.sparkSession, table._folder)


def small_side(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """Broadcast hint for a join side, given only after measuring it.

    Counting stops at `max_rows` + 1. A side with more rows or bytes is returned
    without a hint, so the join shuffles and AQE may split skewed partitions.
    """
    size = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        fixed = isinstance(field.dataType, (T.NumericType, T.DatetimeType, T.BooleanType))
        size = size + (F.lit(8) if fixed else F.coalesce(F.octet_length(column.cast("string")), F.lit(0)))
    measured = df.select(size.alias("size")).limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum("size")).first()
    if measured[0] <= max_rows and (measured[1] or 0) <= max_bytes:
        return F.broadcast(df)
    return df

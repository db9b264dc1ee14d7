"""Streaming ingestion, streaming views, batching and deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.types import parse_timespan
from ..operators.lifecycle import micros, ntz
from ..operators.segments import BatchingPolicy, Bounds, greedy_groups
from ..operators.views import MaterializedView
from ..session import materialise
from ..sources.tables import Table


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    data_format: str = "parquet",
    *,
    enabled: bool = True,
    rate_gb_per_hour: float | None = None,
    every: str = "10s",
    **options: str,
) -> DataFrame:
    """Files of a folder as a stream. The rate hint bounds the bytes of each
    micro-batch, given how often one starts (`every`)."""
    if not enabled:
        raise ValueError("streaming ingestion is off for this table")
    reader = spark.readStream.schema(schema).format(data_format).options(**options)
    if rate_gb_per_hour is not None:
        reader = reader.option("maxBytesPerTrigger", trigger_bytes(rate_gb_per_hour, every))
    return reader.load(path)


def trigger_bytes(rate_gb_per_hour: float, every: str) -> int:
    return max(1, int(rate_gb_per_hour * 1024**3 * parse_timespan(every) / parse_timespan("1h")))


def start_view(view: MaterializedView, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep a view current: every micro-batch adds its partial aggregate."""
    return (
        stream.writeStream.foreachBatch(lambda df, batch_id: view.refresh(df, str(batch_id)) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_append(table: Table, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(lambda df, batch_id: table.append(df, batch=str(batch_id)) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def deduplicated(stream: DataFrame, time: str, keys: Sequence[str], lookback: str) -> DataFrame:
    """The first of the rows with equal keys that arrive within `lookback`. State
    older than that is dropped, so it does not grow with the stream."""
    seconds = parse_timespan(lookback) // 1_000_000
    zoned = stream.withColumn(time, F.col(time).cast("timestamp"))
    kept = zoned.withWatermark(time, f"{seconds} seconds").dropDuplicatesWithinWatermark(list(keys))
    return kept.withColumn(time, F.col(time).cast(stream.schema[time].dataType))


class StreamBatcher:
    """Seal batches of a stream. Items of batches that are still open are kept in
    a table and join the next micro-batch; that table holds less than one batch
    per key. Items must arrive in time order per key."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], time: str, ties: Sequence[str],
                 size: str, policy: BatchingPolicy, block_rows: int | None = None):
        self.keys, self.time, self.ties, self.size, self.policy = list(keys), time, list(ties), size, policy
        self.block_rows = block_rows
        self.open_items = Table(spark, f"{root}/open")
        self.sealed = Table(spark, f"{root}/sealed")

    def add(self, items: DataFrame, batch_id: str, *, as_of: datetime | str | None = None) -> None:
        """Take a micro-batch. `as_of` is the clock that ages open batches; without
        it, a batch ages only when a later item of its key arrives."""
        if self.open_items.exists() and batch_id in self.open_items.batches:
            return
        p, keep = self.policy, [*self.keys, self.time, *self.ties, self.size]
        rows = items.select(*keep)
        if self.open_items.exists():
            rows = self.open_items.read().unionByName(rows)
        rows = rows.withColumn("_at", micros(F.col(self.time))).withColumn("_size", F.coalesce(F.col(self.size).cast("long"), F.lit(0)))
        bounds = Bounds(p.max_items, {"_size": p.max_bytes}, "_at", p.max_span_micros, closing=True)
        grouped = materialise(
            greedy_groups(materialise(rows, "items"), self.keys, ["_at", *self.ties], bounds, "batch_start", self.block_rows),
            "grouped",
        )
        batches = grouped.groupBy(*self.keys, "batch_start").agg(
            F.min(self.time).alias("first_time"),
            F.max(self.time).alias("last_time"),
            F.count(F.lit(1)).alias("items"),
            F.sum("_size").alias("bytes"),
            F.max("_rn").alias("_last"),
        )
        batches = materialise(batches, "batches")
        ends = batches.groupBy(*self.keys).agg(F.max("_last").alias("_end"))
        reason = (
            F.when(F.col("items") >= p.max_items, "items")
            .when(F.col("bytes") >= p.max_bytes, "bytes")
            .when(F.col("_last") < F.col("_end"), "age")
        )
        if as_of is not None:
            reason = reason.when(micros(ntz(as_of)) >= micros(F.col("first_time")) + p.max_span_micros, "age")
        verdict = batches.join(ends, self.keys).withColumn("sealed_by", reason)
        done = verdict.where("sealed_by IS NOT NULL").select(
            *self.keys, "first_time", "last_time", "items", "bytes", "sealed_by"
        )
        waiting = grouped.join(
            verdict.where("sealed_by IS NULL").select(*self.keys, "batch_start"), [*self.keys, "batch_start"], "left_semi"
        ).select(*keep)
        self.sealed.append(done, batch=batch_id)
        self.open_items.replace(waiting, batch=batch_id)

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        return (
            stream.writeStream.foreachBatch(lambda df, batch_id: self.add(df, f"batch-{batch_id}"))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

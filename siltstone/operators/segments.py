"""Greedy grouping of ordered rows under bounds, also when one key is huge.

"Fill a group until a bound is met, then open the next" is sequential per key:
where a group starts depends on all groups before it. To keep a hot key from
running in one task, its rows are cut into blocks of fixed length, and

1. every block works out, for each row a group could start with near its top,
   where the first group after the block would then start (no block waits for
   another);
2. those jumps are followed from the first row of the key by repeated
   doubling, in a number of rounds logarithmic in the number of blocks;
3. every block, now knowing where its first group starts, labels its rows.

A group never holds more than `max_items` rows, so each block only needs the
first `max_items` rows of the next one besides its own. Keys that fit in one
block need none of this: one window shuffle brings their rows together.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from ..session import materialise, small_side
from .ordered import blocked_totals, split_hot, windowed_totals

# The functions that run in tasks travel with the job, so executors need not
# have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Bounds:
    """When the next group starts.

    `closing` False: before a row that would take the group over a bound (sums
    above `sums`, axis difference above `span`). True: after the row that
    reaches a sum, and before a row at or after first + `span`.
    """

    max_items: int
    sums: dict[str, int] = field(default_factory=dict)
    axis: str | None = None  # long column, rising with the order
    span: int | None = None
    closing: bool = False

    def next_starts(self, table: dict[str, np.ndarray]) -> np.ndarray:
        """For each row, where the next group starts if one starts at this row."""
        size = len(table["_rn"])
        here = np.arange(size)
        nxt = here + self.max_items
        for name, limit in self.sums.items():
            upto = table[f"_cum_{name}"]
            goal = upto - table[name] + limit
            if self.closing:
                found = np.searchsorted(upto, goal, side="left") + 1
            else:
                found = np.searchsorted(upto, goal, side="right")
            nxt = np.minimum(nxt, found)
        if self.axis and self.span is not None:
            at = table[self.axis]
            nxt = np.minimum(nxt, np.searchsorted(at, at + self.span, side="left" if self.closing else "right"))
        return np.minimum(np.maximum(nxt, here + 1), size)


def _arrays(table: pa.Table, bounds: Bounds) -> dict[str, np.ndarray]:
    names = ["_rn", *bounds.sums, *[f"_cum_{n}" for n in bounds.sums], *([bounds.axis] if bounds.axis else [])]
    return {n: table.column(n).to_numpy() for n in dict.fromkeys(names)}


def _blocks_of(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.Table]:
    """Rows come sorted by block; a block begins where `_rn` is its first number."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        first = batch.column(batch.schema.get_field_index("_blk")).to_numpy() * block_rows + 1
        starts = np.flatnonzero(batch.column(batch.schema.get_field_index("_rn")).to_numpy() == first)
        done = 0
        for start in starts:
            if start > done:
                held.append(batch.slice(done, start - done))
            if held:
                yield pa.Table.from_batches(held)
            held, done = [], start
        if batch.num_rows > done:
            held.append(batch.slice(done))
    if held:
        yield pa.Table.from_batches(held)


def _jumps(bounds: Bounds, block_rows: int, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks_of(batches, block_rows):
            rows = _arrays(table, bounds)
            size, own = len(rows["_rn"]), min(block_rows, len(rows["_rn"]))
            leave = np.arange(size + 1)
            nxt = bounds.next_starts(rows)
            for i in range(own - 1, -1, -1):
                leave[i] = leave[nxt[i]]
            first = table.column("_blk")[0].as_py() == 0
            heads = np.arange(1 if first else min(bounds.max_items, own))
            heads = heads[leave[heads] < size]
            out = table.select(columns).take(pa.array(heads)).append_column("_to", pa.array(rows["_rn"][leave[heads]]))
            yield from out.to_batches()

    return run


def _labels(bounds: Bounds, block_rows: int, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks_of(batches, block_rows):
            entry = table.column("_entry")[0].as_py()
            if entry is None:
                continue  # the last group of the block before covers all of it
            rows = _arrays(table, bounds)
            nxt, own = bounds.next_starts(rows), min(block_rows, len(rows["_rn"]))
            begin = at = int(entry - rows["_rn"][0])
            group = np.empty(len(rows["_rn"]), dtype=np.int64)
            while at < own:
                group[at:nxt[at]] = rows["_rn"][at]
                at = int(nxt[at])
            out = table.select(columns).slice(begin, at - begin)
            yield from out.append_column("_group", pa.array(group[begin:at])).to_batches()

    return run


def _follow(jumps: DataFrame, keys: Sequence[str], block_rows: int) -> DataFrame:
    """All rows reached from row 1 of each key: (keys, rn)."""
    link = materialise(jumps.select(*keys, F.col("_rn").alias("a"), F.col("_to").alias("b")), "jumps")
    # A row that no jump leads to is never reached. Groups that start apart soon
    # start together, so this leaves few rows per block.
    aimed_at = link.select(*keys, F.col("b").alias("a")).distinct()
    link = materialise(link.where("a = 1").unionByName(link.where("a > 1").join(aimed_at, [*keys, "a"], "left_semi")), "jumps")
    furthest = link.agg(F.max("b")).first()[0] or 1
    hops, blocks = 1, (furthest - 1) // block_rows + 1
    reached = link.where("a = 1").select(*keys, F.col("a").alias("rn"))
    while hops < blocks:
        # `reached` holds the first `hops` rows of the way, `link` leads `hops` on.
        step = link.withColumnRenamed("a", "rn")
        both = F.explode(F.array_compact(F.array("rn", "b"))).alias("rn")
        reached = reached.join(step, [*keys, "rn"], "left").select(*keys, both)
        onward = link.select(*keys, F.col("a").alias("b"), F.col("b").alias("c"))
        link = materialise(link.join(onward, [*keys, "b"]).select(*keys, "a", F.col("c").alias("b")), "jumps")
        hops *= 2
    return materialise(reached, "reached")


def greedy_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bounds: Bounds,
    out: str = "group_start",
    block_rows: int | None = None,
) -> DataFrame:
    """`df` plus `_rn` (place within the key) and `out`: the place of the row
    that opens the group. `order` must be unique within a key; `keys` not null.
    `df` is read more than once; hand over a table or something as cheap."""
    keys, block_rows = list(keys), max(block_rows or 100_000, bounds.max_items)
    totals = {"_rn": F.lit(1).cast("long"), **{f"_cum_{n}": F.col(n).cast("long") for n in bounds.sums}}
    names = [*df.columns, "_rn"]
    schema = T.StructType([*df.schema.fields, T.StructField("_rn", T.LongType()), T.StructField("_group", T.LongType())])
    label = _labels(bounds, block_rows, names)

    cold, hot = split_hot(df, keys, block_rows)
    # The window leaves each key whole and in order, so no further shuffle.
    whole = windowed_totals(cold, keys, order, totals).withColumns(
        {"_blk": F.lit(0).cast("long"), "_entry": F.lit(1).cast("long")}
    )
    result = whole.mapInArrow(label, schema)
    if hot is not None:
        blocks = _entered_blocks(hot, keys, order, bounds, totals, block_rows)
        result = result.unionByName(blocks.mapInArrow(label, schema))
    return result.withColumnRenamed("_group", out)


def _entered_blocks(
    hot: DataFrame, keys: list[str], order: Sequence[str], bounds: Bounds, totals: dict, block_rows: int
) -> DataFrame:
    """Rows of hot keys in sorted blocks, each with the top of the next one and
    with `_entry`, the place where its first group starts."""
    placed = blocked_totals(hot, keys, order, totals)
    placed = materialise(placed.withColumn("_blk", F.floor((F.col("_rn") - 1) / block_rows)), "placed")
    at_top = (F.col("_blk") > 0) & ((F.col("_rn") - 1) % block_rows < bounds.max_items)
    homes = F.when(at_top, F.array(F.col("_blk"), F.col("_blk") - 1)).otherwise(F.array("_blk"))
    spread = placed.withColumn("_blk", F.explode(homes))

    def sorted_blocks(df: DataFrame) -> DataFrame:
        return df.repartition(*keys, "_blk").sortWithinPartitions(*keys, "_blk", "_rn")

    slim = list(dict.fromkeys([*keys, "_blk", "_rn", *bounds.sums, *[f"_cum_{n}" for n in bounds.sums],
                               *([bounds.axis] if bounds.axis else [])]))
    jump_schema = T.StructType(
        [placed.schema[c] for c in keys] + [T.StructField(c, T.LongType()) for c in ("_blk", "_rn", "_to")]
    )
    jumps = sorted_blocks(spread.select(*slim)).mapInArrow(_jumps(bounds, block_rows, [*keys, "_blk", "_rn"]), jump_schema)
    entries = (
        _follow(jumps, keys, block_rows)
        .groupBy(*keys, F.floor((F.col("rn") - 1) / block_rows).alias("_blk"))
        .agg(F.min("rn").alias("_entry"))  # a block is entered once: jumps lead from block to block
    )
    # The first block of a key is entered at row 1, also where no jump leaves it.
    entered = spread.join(small_side(entries), [*keys, "_blk"], "left").withColumn(
        "_entry", F.when(F.col("_blk") == 0, F.lit(1).cast("long")).otherwise(F.col("_entry"))
    )
    return sorted_blocks(entered)


@dataclass(frozen=True)
class BatchingPolicy:
    """Seal an open batch on age, item count or raw bytes, whichever comes first."""

    max_items: int
    max_bytes: int
    max_span_micros: int


def seal_batches(
    items: DataFrame,
    keys: Sequence[str],
    time: str,
    ties: Sequence[str],
    size: str,
    policy: BatchingPolicy,
    block_rows: int | None = None,
) -> DataFrame:
    """One row per batch: keys, first and last time, items, bytes, and the bound
    that sealed it (`open` for the last batch of a key if none did). Keys, times
    and ties are not null; an unknown size counts as nothing."""
    timed = items.withColumn("_at", F.unix_micros(F.col(time).cast("timestamp"))).withColumn(
        "_size", F.coalesce(F.col(size).cast("long"), F.lit(0))
    )
    bounds = Bounds(policy.max_items, {"_size": policy.max_bytes}, "_at", policy.max_span_micros, closing=True)
    slim = timed.select(*keys, time, *ties, "_at", "_size")
    grouped = greedy_groups(slim, keys, ["_at", *ties], bounds, "batch_start", block_rows)
    batches = materialise(
        grouped.groupBy(*keys, "batch_start").agg(
            F.min(time).alias("first_time"),
            F.max(time).alias("last_time"),
            F.count(F.lit(1)).alias("items"),
            F.sum("_size").alias("bytes"),
            F.max("_rn").alias("_last"),
        ),
        "batches",
    )
    last = batches.groupBy(*keys).agg(F.max("_last").alias("_end"))
    return (
        batches.join(last, list(keys))
        .withColumn(
            "sealed_by",
            F.when(F.col("items") >= policy.max_items, "items")
            .when(F.col("bytes") >= policy.max_bytes, "bytes")
            .when(F.col("_last") < F.col("_end"), "age")
            .otherwise("open"),
        )
        .drop("_last", "_end")
    )

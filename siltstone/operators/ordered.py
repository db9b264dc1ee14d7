"""Running totals that stay parallel when one key holds most of the rows.

A plain window puts all rows of a key in one task. Keys are therefore counted
first. Those of up to `block_rows` rows use the window. The rows of hotter keys
are range partitioned by key and order, so that each key is spread over many
blocks; totals run inside a block, and a small table of block totals carries
the sum from one block to the next.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise, small_side

BLOCK_ROWS = 1_000_000


def split_hot(df: DataFrame, keys: Sequence[str], block_rows: int, counted: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys that fit in a block, and rows of those that do not (None if
    there are none). The count is a map-side combined pass over the keys alone."""
    counted = df if counted is None else counted
    if not keys:
        return (df, None) if counted.limit(block_rows + 1).count() <= block_rows else (df.limit(0), df)
    hot = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block_rows).select(*keys)
    hot = materialise(hot, "hot-keys")
    if hot.isEmpty():
        return df, None
    side = small_side(hot)
    return df.join(side, list(keys), "left_anti"), df.join(side, list(keys), "left_semi")


def range_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """`df` with `_block`: blocks follow (keys, order), and a block may end in
    the middle of a key. Written out, because the bounds come from a sample and
    a recomputation might choose others. `order` must be unique within a key."""
    by = [*keys, *order]
    ranged = df.repartitionByRange(blocks, *by) if blocks else df.repartitionByRange(*by)
    return materialise(ranged.withColumn("_block", F.spark_partition_id()), "blocks")


def carried_totals(blocked: DataFrame, keys: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """Per (block, key) that continues a key from an earlier block: the total of
    all earlier blocks. A block continues at most one key, so there are no more
    rows than blocks."""
    per_block = blocked.groupBy("_block", *keys).agg(*[t.alias(n) for n, t in totals.items()])
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return (
        per_block.withColumn("_n", F.count(F.lit(1)).over(earlier))
        .select("_block", *keys, "_n", *[F.sum(n).over(earlier).alias(n) for n in totals])
        .where("_n > 0")
        .drop("_n")
    )


def windowed_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Running totals of keys that each fit in one task."""
    here = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({n: F.sum(v).over(here) for n, v in values.items()})


def blocked_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, Column], blocks: int | None = None
) -> DataFrame:
    """Running totals of keys of any size."""
    addends = {f"_add_{n}": v for n, v in values.items()}
    blocked = range_blocks(df.withColumns(addends), keys, order, blocks)
    carried = carried_totals(blocked, keys, {f"_carry_{n}": F.sum(f"_add_{n}") for n in values})
    here = Window.partitionBy("_block", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = blocked.withColumns({n: F.sum(f"_add_{n}").over(here) for n in values})
    condition = local["_block"] == carried["_block"]
    for k in keys:
        condition = condition & local[k].eqNullSafe(carried[k])
    # At most one row per block, so the side is bounded by the block count.
    joined = local.join(F.broadcast(carried), condition, "left")
    return joined.select(
        *[local[c] for c in df.columns],
        *[(local[n] + F.coalesce(carried[f"_carry_{n}"], F.lit(0))).alias(n) for n in values],
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    block_rows: int = BLOCK_ROWS,
    blocks: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add one running total per entry of `values` (name -> addend), including
    the current row, in `order` within `keys`. `df` is read more than once; hand
    over a table or something as cheap, or the table `counted` of the same keys."""
    cold, hot = split_hot(df, keys, block_rows, counted)
    result = windowed_totals(cold, keys, order, values)
    return result if hot is None else result.unionByName(blocked_totals(hot, keys, order, values, blocks))

"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by (hash of the text, id, a drawn number). The bytes below candidate keys
(probes) are counted exactly over all partitions; around each wanted boundary
new probes are drawn from the keys between its two nearest probes, until the
boundary meets the tolerance or no key lies between. Then the rows move once.

Equal texts are neighbours in that order, so a group of copies is cut only where
a boundary falls into it, and a group larger than a shard is spread by its ids.
Rows equal in both are told apart by the drawn number: a boundary within them
takes its part of them, near enough as they are many. Slots are counted over the
rows as they were dealt out and written. The driver sees probes and their counts: a fixed number for each shard and for
each `task_bytes` of data, never a key of each row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.frames import bounded_batches, materialise, name
from siltstone.llm.text import mix
from siltstone.session import small_side

SIGN = np.uint64(1 << 63)
#: Probes drawn around one boundary in one round.
PROBES = 64
#: Seed of the drawn numbers.
SEED = 11


def _keys(*parts: np.ndarray) -> np.ndarray:
    """Tuples of three longs as 24 bytes whose byte order is the order of the tuples."""
    rows = np.empty((len(parts[0]), 3), ">u8")
    for j, part in enumerate(parts):
        rows[:, j] = part.view(np.uint64) ^ SIGN
    return np.ascontiguousarray(rows).view("S24").ravel()


def _draws(*parts: np.ndarray) -> np.ndarray:
    """A number from 0 to 1 for each key, the same for equal keys."""
    h, i, salt = (part.view(np.uint64) for part in parts)
    return mix(h ^ mix(i + np.uint64(1) + mix(salt))).astype(np.float64) / 2.0**64


def _columns(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
    """The parts of the keys, and the sizes."""
    *parts, size = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4))
    return parts, size


def _histogram(slim: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows below each probe, in all partitions."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            parts, size = _columns(batch)
            at = np.searchsorted(probes, _keys(*parts), "right")
            np.add.at(sizes, at, size)
            rows += np.bincount(at, minlength=len(rows))
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_pydict({"at": pa.array(used), "bytes": pa.array(sizes[used]), "n": pa.array(rows[used])})

    found = slim.mapInArrow(count, "at long, bytes long, n long").groupBy("at").agg(F.sum("bytes"), F.sum("n")).collect()
    sizes, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for at, size, n in found:
        sizes[at], rows[at] = size, n
    return np.cumsum(sizes)[:-1], np.cumsum(rows)[:-1]


def _sample(slim: DataFrame, lows: np.ndarray, highs: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """Distinct keys strictly between lows[j] and highs[j], each drawn with chance rates[j]."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, _ = _columns(batch)
            keys, chance = _keys(*parts), _draws(*parts)
            at = np.searchsorted(lows, keys, "left") - 1
            inside = (at >= 0) & (keys < highs[at]) & (chance < rates[at])
            if inside.any():
                yield pa.RecordBatch.from_pydict({c: pa.array(part[inside]) for c, part in zip("hir", parts)})

    found = slim.mapInArrow(draw, "h long, i long, r long").distinct().collect()
    return np.sort(_keys(*(np.array([row[j] for row in found], np.int64) for j in range(3))))


def boundaries(slim: DataFrame, shards: int, tolerance: float, task_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys that the ranges begin at, and the shard of each range.

    `slim` has the columns hash, id, salt and size. A shard has one range for each
    `task_bytes` or so, which bounds the work of one task.
    """
    total, rows = slim.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if not rows:
        return np.zeros(0, "S24"), np.zeros(1, np.int64)
    pieces = shards * max(1, -(-total // (shards * task_bytes)))
    least, most = np.array([b"\0" * 24], "S24"), np.array([b"\xff" * 24], "S24")
    wanted = total * np.arange(1, shards, dtype=np.float64) / shards
    probes = _sample(slim, least, most, np.array([min(1.0, PROBES * pieces / rows)]))
    below, under = _histogram(slim, probes)
    while len(wanted):
        miss = np.abs(below[None, :] - wanted[:, None]).min(axis=1) if len(below) else np.full(len(wanted), np.inf)
        open_ = np.flatnonzero(miss > tolerance * total / shards)
        if not len(open_):
            break
        at = np.unique(np.searchsorted(below, wanted[open_], "left"))
        edges, counts = np.concatenate([least, probes, most]), np.concatenate([[0], under, [rows]])
        lows, highs, inside = edges[at], edges[at + 1], counts[at + 1] - counts[at]
        fresh = np.setdiff1d(_sample(slim, lows, highs, np.minimum(1.0, PROBES / np.maximum(inside, 1))), probes)
        if not len(fresh):
            if (inside <= PROBES).all():
                break
            # The draw met none of the few distinct keys left here: take them all.
            fresh = np.setdiff1d(_sample(slim, lows, highs, np.ones(len(lows))), probes)
            if not len(fresh):
                break
        probes = np.union1d(probes, fresh)
        below, under = _histogram(slim, probes)
    cuts = {}
    for k in range(1, pieces):
        if len(below):
            j = int(np.abs(below - total * k / pieces).argmin())
            shard_cut = k * shards % pieces == 0
            cuts[j] = max(cuts.get(j, 0), int(shard_cut) and k * shards // pieces)
    shard_of = [0]
    for j in sorted(cuts):
        shard_of.append(max(shard_of[-1], cuts[j]))
    return probes[sorted(cuts)], np.array(shard_of, np.int64)


def shard_documents(docs: DataFrame, shards: int = 16, tolerance: float = 0.001, task_bytes: int = 32 << 20,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with `size` (bytes of the text plus one), `shard` and `slot` (place in the shard, gapless from 0).

    Shards differ from an equal share by `tolerance` of it, or by the one row
    across a boundary if that is more. Null texts count as empty, null ids as the
    smallest. Rows equal in text and id stand in any order; a shard takes its part
    of them as drawn, so with n of them it may be off by about the root of n. Very
    long texts are single rows. Columns of `docs` with these three names are replaced; an empty
    table gives no rows.
    """
    docs = docs.drop("size", "shard", "slot")
    spark = docs.sparkSession
    bounded_batches(spark)
    h, i, salt, at, first = (name(docs, c) for c in ("_hash", "_id", "_salt", "_range", "_first"))
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.withColumns({
        h: F.xxhash64(body),
        i: F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))),
        salt: F.floor(F.rand(SEED) * 2.0**62),
        "size": F.octet_length(body).cast("long") + 1,
    })
    slim = materialise(keyed.select(F.col(h).alias("hash"), F.col(i).alias("id"), F.col(salt).alias("salt"), "size"), "shard-keys")
    keys, shard_of = boundaries(slim, shards, tolerance, task_bytes)

    @F.pandas_udf("int")
    def range_of(hashes, ids, salts):
        import pandas as pd

        return pd.Series(np.searchsorted(keys, _keys(*(c.to_numpy(np.int64) for c in (hashes, ids, salts))), "right"))

    @F.pandas_udf("int")
    def shard_of_range(ranges):
        import pandas as pd

        return pd.Series(shard_of[ranges.to_numpy()])

    # Each range goes to a task of its own. What is written is what slots are counted over.
    dealt = keyed.withColumn(at, range_of(h, i, salt)).repartitionById(len(shard_of), F.col(at))
    row = F.row_number().over(Window.partitionBy(at).orderBy(h, i, salt)).cast("long")
    dealt = materialise(dealt.withColumn("slot", row - 1).drop(h, i, salt), "dealt")
    ranges = dealt.groupBy(at).agg(F.count(F.lit(1)).alias("n")).withColumn("shard", shard_of_range(at))
    earlier = Window.partitionBy("shard").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    places = materialise(ranges.select(at, "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(first)), "places")
    return dealt.join(small_side(places), at).withColumn("slot", F.col("slot") + F.col(first)).drop(at, first)

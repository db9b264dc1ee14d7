"""Ingestion time, retention, hot window, partitioning and small-file merge."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, types as T
from pyspark.sql import functions as F

from .. import files
from ..functions.types import parse_timespan, timespan_micros
from ..session import materialise, small_side
from ..sources.tables import Table
from .segments import Bounds, greedy_groups

INGESTION_TIME = "_ingestion_time"
# Fixed value: the greatest count of units in a retention period.
MOST_UNITS = 364_635


def ntz(value: datetime | str | Column) -> Column:
    """A time without zone; sessions run in UTC."""
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp_ntz")


def micros(t: Column) -> Column:
    return F.unix_micros(t.cast("timestamp"))


def from_micros(n: Column) -> Column:
    return F.timestamp_micros(n).cast("timestamp_ntz")


def before(as_of: datetime | str, period: str | int) -> Column:
    """`as_of` minus a period; folds to a literal, so filters on it reach the scan."""
    span = parse_timespan(period) if isinstance(period, str) else period
    return from_micros(micros(ntz(as_of)) - F.lit(span))


# -- ingestion time --------------------------------------------------------
def with_ingestion_time(df: DataFrame, *, enabled: bool = True, as_of: datetime | str | Column | None = None) -> DataFrame:
    """Stamp the arrival time of a batch; null where the policy is off."""
    if not enabled:
        stamp = F.lit(None).cast("timestamp_ntz")
    elif as_of is None:
        stamp = F.current_timestamp().cast("timestamp_ntz")
    else:
        stamp = ntz(as_of)
    return df.withColumn(INGESTION_TIME, stamp)


# -- retention -------------------------------------------------------------
@dataclass(frozen=True)
class Retention:
    soft_delete: str
    recoverable: bool = True

    def __post_init__(self):
        count = re.fullmatch(r"(\d+)[dhms]", self.soft_delete.strip())
        if count and not 1 <= int(count.group(1)) <= MOST_UNITS:
            raise ValueError(f"a period of 1 to {MOST_UNITS} units, not {self.soft_delete!r}")
        parse_timespan(self.soft_delete)


def retained(df: DataFrame, policy: Retention, as_of: datetime | str, time: str = INGESTION_TIME) -> DataFrame:
    """Rows still visible; a row exactly as old as the period is. Rows without a
    time never expire."""
    return df.where((F.col(time) >= before(as_of, policy.soft_delete)) | F.col(time).isNull())


def expired(df: DataFrame, policy: Retention, as_of: datetime | str, time: str = INGESTION_TIME) -> DataFrame:
    """Expired rows that can be brought back; none if the policy does not keep them.
    `drop_expired` and `recover_expired` do so with the parts of a table."""
    return df.where((F.col(time) < before(as_of, policy.soft_delete)) & F.lit(policy.recoverable))


def drop_expired(table: Table, policy: Retention, as_of: datetime | str, time: str = INGESTION_TIME) -> list[str]:
    """Take every part out of the table whose rows have all expired, in one commit;
    gives those part folders. No row is rewritten: a part with a row that has not
    expired, or has no time, stays whole, and `retained` hides its expired rows.
    Only the names of such parts come to the driver."""
    ends = table.part_ends(time)
    gone = [r["part"] for r in ends.where((F.col("undated") == 0) & (F.col("last") < before(as_of, policy.soft_delete))).select("part").collect()]
    table.retire(gone, str(as_of))
    return gone


def recover_expired(table: Table, policy: Retention, as_of: datetime | str, within: str = "14d") -> list[str]:
    """Put back the batches that `drop_expired` took out at most `within` before
    `as_of`; gives their ids. Refused if the policy does not keep them."""
    if not policy.recoverable:
        raise ValueError("the policy does not keep expired rows")
    spark = table.spark
    oldest = spark.range(1).select(before(as_of, within).cast("string"), ntz(as_of).cast("string")).first()
    stamps = {r["batch"]: r["at"] for r in table.retired}
    batches = [b for b, at in stamps.items() if datetime.fromisoformat(oldest[0]) <= datetime.fromisoformat(at) <= datetime.fromisoformat(oldest[1])]
    table.restore(batches)
    return batches


def purge_expired(table: Table, policy: Retention, as_of: datetime | str, within: str = "14d") -> list[str]:
    """Delete the files of parts that can't be recovered any more: taken out longer
    than `within` ago, or at all if the policy does not keep them. Gives their folders."""
    limit = datetime.fromisoformat(table.spark.range(1).select(before(as_of, within).cast("string")).first()[0])
    held = set(table.folders)
    late = {r["part"] for r in table.retired if not policy.recoverable or datetime.fromisoformat(r["at"]) < limit} - held
    for part in late:
        files.delete(table.spark, f"{table.path}/{part}")
    return sorted(late)


def retained_by_policy(df: DataFrame, policies: DataFrame, on: Sequence[str], as_of: datetime | str,
                       time: str = INGESTION_TIME) -> DataFrame:
    """Retention of many entities at once: each row is kept for the period in the
    JSON `policy` of its entity. `policies` is (*on, policy), unique by `on`; rows
    of entities without a policy stay."""
    periods = policies.select(*on, timespan_micros(F.get_json_object("policy", "$.SoftDeletePeriod")).alias("_period"))
    oldest = micros(ntz(as_of)) - F.col("_period")
    # One row per entity: as a rule small, and then the rows are not shuffled.
    kept = df.join(small_side(materialise(periods, "periods")), list(on), "left").where(
        F.col("_period").isNull() | F.col(time).isNull() | (micros(F.col(time)) >= oldest)
    )
    return kept.select(*df.columns)


def hot_rows(df: DataFrame, span: str, as_of: datetime | str, time: str = INGESTION_TIME, keep: bool = False) -> DataFrame:
    """The recent slice; with `keep`, held in executor memory and disk."""
    rows = df.where(F.col(time) >= before(as_of, span))
    return rows.persist() if keep else rows


# -- partitioning ----------------------------------------------------------
@dataclass(frozen=True)
class HashKey:
    column: str
    max_partitions: int = 64
    seed: int = 1
    mode: str = "Default"

    def __post_init__(self):
        if self.mode not in ("Default", "Uniform"):
            raise ValueError(f"unknown assignment mode {self.mode!r}")

    @property
    def name(self) -> str:
        return f"_hash_{self.column}"

    @property
    def outside(self) -> Column:
        return F.lit(-1)

    def place(self, value: Column) -> Column:
        # The seed is hashed as an INT: its type is part of the hash.
        return F.pmod(F.xxhash64(F.lit(self.seed).cast("int"), value), F.lit(self.max_partitions)).cast("int")

    def equals(self, value, data_type: str | T.DataType) -> Column:
        """A filter on the raw column, with the partition it can only be in."""
        typed = F.lit(value).cast(data_type)
        return (F.col(self.column) == typed) & F.col(self.name).isin(F.lit(-1), self.place(typed))


@dataclass(frozen=True)
class RangeKey:
    column: str
    range_size: str
    reference: str
    override_creation_time: bool = False

    @property
    def name(self) -> str:
        return f"_range_{self.column}"

    @property
    def outside(self) -> Column:
        return F.lit(None).cast("timestamp_ntz")

    def place(self, value: Column) -> Column:
        size, origin = F.lit(parse_timespan(self.range_size)), micros(ntz(self.reference))
        since = micros(value) - origin
        return from_micros(origin + since - F.pmod(since, size))

    def between(self, low: datetime | str, high: datetime | str) -> Column:
        """low <= column < high, with the partitions that can hold such rows."""
        part, raw = F.col(self.name), F.col(self.column)
        inside = (part >= self.place(ntz(low))) & (part <= self.place(ntz(high)))
        return (inside | part.isNull()) & (raw >= ntz(low)) & (raw < ntz(high))


@dataclass(frozen=True)
class Partitioning:
    """One or two keys; rows that arrived before `effective` stay outside."""

    keys: Sequence[HashKey | RangeKey]
    effective: datetime | str | None = None

    def __post_init__(self):
        if not 1 <= len(self.keys) <= 2:
            raise ValueError("a partitioning has one or two keys")
        if len({k.column for k in self.keys}) != len(self.keys):
            raise ValueError("partition keys must differ")

    def assign(self, df: DataFrame, time: str = INGESTION_TIME) -> DataFrame:
        applies = F.lit(True) if self.effective is None else F.col(time) >= ntz(self.effective)
        df = df.withColumns(
            {k.name: F.when(applies, k.place(F.col(k.column))).otherwise(k.outside) for k in self.keys}
        )
        for k in self.keys:
            if isinstance(k, RangeKey) and k.override_creation_time:
                df = df.withColumn("_created", F.coalesce(k.name, F.col(time)))
        return df

    def write(self, df: DataFrame, path: str, time: str = INGESTION_TIME) -> None:
        """One folder per partition. Rows are rebalanced by partition and a hot
        partition is split over several tasks and files."""
        names = [k.name for k in self.keys]
        self.assign(df, time).hint("rebalance", *names).write.partitionBy(*names).parquet(path)


# -- small-file merge ------------------------------------------------------
@dataclass(frozen=True)
class MergePolicy:
    max_rows: int = 16_000_000
    max_mb: int = 30_000
    max_files: int = 100
    max_range_hours: int = 24
    allow_merge: bool = True
    allow_rebuild: bool = True
    lookback: str = "Default"  # Default (14 d), All, HotCache, Custom
    custom_period: str | None = None

    def __post_init__(self):
        if self.lookback not in ("Default", "All", "HotCache", "Custom"):
            raise ValueError(f"unknown lookback {self.lookback!r}")
        if self.lookback == "Custom" and not self.custom_period:
            raise ValueError("a custom lookback needs a period")

    def period(self, hot_span: str | None) -> str | None:
        if self.lookback == "HotCache":
            return hot_span
        return {"Default": "14d", "All": None, "Custom": self.custom_period}[self.lookback]


def plan_merges(
    files: DataFrame,
    keys: Sequence[str],
    policy: MergePolicy,
    as_of: datetime | str,
    hot_span: str | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Which files to merge. `files` has the keys (never null), `path`, `rows`,
    `bytes` and `created`. Files of a key are taken by age; a file that would
    take a group over a bound opens the next. Gives files in groups of two or
    more with `merge_group`, the place of the group's first file."""
    period = policy.period(hot_span)
    if period is not None:
        files = files.where(F.col("created") >= before(as_of, period))
    if not policy.allow_merge:
        files = files.limit(0)
    bounds = Bounds(
        policy.max_files,
        {"rows": policy.max_rows, "bytes": policy.max_mb * 1024 * 1024},
        "_at",
        policy.max_range_hours * 3_600_000_000,
    )
    slim = files.select(
        *keys, "path", *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ("rows", "bytes")], "created", micros(F.col("created")).alias("_at")
    )
    grouped = greedy_groups(materialise(slim, "files"), keys, ["_at", "path"], bounds, "merge_group", block_rows)
    # A group has at most `max_files` files, so this window is small everywhere.
    together = Window.partitionBy(*keys, "merge_group")
    counted = grouped.drop("_at", "_rn").withColumn("files", F.count(F.lit(1)).over(together))
    return counted.where("files > 1")


# A part folder in the path of a data file: as appended, or one group of a merge.
_PART = r"(part-[0-9a-f]{32}(?:/merge_group=[0-9]+)?)/[^/]+$"


def part_table(table) -> DataFrame:
    """One row per part folder of a table: path, rows, bytes, created. Rows are
    counted from file metadata; no column is read."""
    rows = table.read().select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    per_file = rows.groupBy("file_path", "file_size", "file_modification_time").agg(F.count(F.lit(1)).alias("rows"))
    return (
        per_file.groupBy(F.regexp_extract("file_path", _PART, 1).alias("path"))
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("file_size").alias("bytes"),
            F.max("file_modification_time").cast("timestamp_ntz").alias("created"),
        )
        .withColumn("table_name", F.lit(table.path))
    )


def run_merges(table, policy: MergePolicy, as_of: datetime | str) -> int:
    """Rewrite small parts of a table, one part per group, and switch them in
    with one commit. Gives the number of parts replaced. The driver sees names of
    part folders only; a large group is split over several tasks and files of its folder."""
    if not policy.allow_rebuild:
        return 0
    plan = plan_merges(part_table(table), ["table_name"], policy, as_of).select("path", "merge_group")
    group_of = {r["path"]: r["merge_group"] for r in plan.collect()}
    if not group_of:
        return 0
    batches = {batch: part for part, held in table.folders.items() if part in group_of for batch in held}
    rows = table.read_batches(list(batches))
    located = rows.withColumn("path", F.regexp_extract("_metadata.file_path", _PART, 1))
    merged = located.join(small_side(plan), "path").select(*rows.columns, "merge_group").hint("rebalance", "merge_group")
    staged = table.stage(merged, ["merge_group"])
    table.move_batches({batch: f"{staged}/merge_group={group_of[part]}" for batch, part in batches.items()})
    return len(group_of)

"""Row-level security, restricted tables, grants and principal matching."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from ..plans.stored import Functions, Query, run_query
from ..session import materialise, small_side

# Functions of this module travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Display name of each role.
ROLE_NAMES = {"admins": "Admin", "ingestors": "Ingestor"}
#: Places (as a power of two) in the filter of needles, 8 MB; bytes of text hashed at once.
FILTER_BITS, HASHED = 26, 1 << 18
_BASE = 0x2545F4914F6CDD1D


@dataclass(frozen=True)
class RowSecurity:
    """What readers see instead of the table. `query` reads ``{source}`` (or the
    argument `source`) and may use the column `_principal`, the reader's name."""

    query: Query
    enabled: bool = True


def secured(df: DataFrame, policy: RowSecurity, principal: str | None = None, functions: Functions | None = None) -> DataFrame:
    if not policy.enabled:
        return df
    who = F.current_user() if principal is None else F.lit(principal)
    rows = run_query(df.sparkSession, policy.query, functions, source=df.withColumn("_principal", who))
    return rows.select(*[c for c in rows.columns if c != "_principal"])


def restricted(df: DataFrame, grants: DataFrame, table: str, principal: str, enabled: bool = True) -> DataFrame:
    """All rows for a principal with a grant on the table, none for others."""
    if not enabled:
        return df
    granted = grants.where((F.col("table_name") == table) & (F.lower("principal") == principal.lower()))
    return df.where(granted.select(F.lit(1)).exists())


def is_member(df: DataFrame, members: DataFrame, principal: str, group: str) -> DataFrame:
    """Rows whose principal belongs to the group; `members` is (group_name, principal)."""
    of_group = members.where(F.col("group_name") == group).select(F.col("principal").alias("_member"))
    return df.join(of_group, F.col(principal) == F.col("_member"), "left_semi")


def role_name(role: Column) -> Column:
    named = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    return F.coalesce(named[role], role)


def effective_access(changes: DataFrame) -> DataFrame:
    """Current grants from a log of (table_name, principal, role, action, at):
    the latest of ``add`` and ``drop`` per table, principal and role decides; of
    two at the same time the drop does."""
    order = F.struct(F.col("at"), (F.col("action") == "drop").alias("d"))
    return (
        changes.groupBy("table_name", "principal", "role")
        .agg(F.max_by("action", order).alias("action"))
        .where("action = 'add'")
        .select("table_name", "principal", role_name(F.col("role")).alias("role"))
    )


def resolve_scope(entities: DataFrame, policies: DataFrame, value: str, out: str) -> DataFrame:
    """The policy of each (database_name, entity_name): its own if there is one,
    else that of its database. `policies` is (database_name, entity_name, value),
    with a null entity for the database."""
    own = policies.where("entity_name IS NOT NULL").withColumnRenamed(value, "_own")
    general = policies.where("entity_name IS NULL").select("database_name", F.col(value).alias("_general"))
    return (
        entities.join(small_side(own), ["database_name", "entity_name"], "left")
        .join(small_side(general), "database_name", "left")
        .withColumn(out, F.coalesce("_own", "_general"))
        .withColumn(
            "policy_scope",
            F.when(F.col("_own").isNotNull(), "entity").when(F.col("_general").isNotNull(), "database").otherwise("none"),
        )
        .drop("_own", "_general")
    )


# -- principal matching ----------------------------------------------------
def _pieces(text: Column, lengths: list[int]) -> Column:
    """Distinct substrings of `text` that have one of the lengths."""

    def of_length(n: Column) -> Column:
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(text, i, n))

    return F.array_distinct(F.flatten(F.transform(F.array(*[F.lit(n) for n in lengths]), of_length)))


def _lengths(df: DataFrame, column: str) -> list[int]:
    """The lengths that occur: no more numbers than the longest text has letters."""
    return sorted(r[0] for r in df.select(F.length(column)).distinct().where(F.length(column) > 0).collect())


def _windows(column: pa.Array, lengths: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray, np.ndarray]]:
    """Bytes, rows, a length, where windows of that length begin in them, and the windows' hashes.

    A hash is the window's own, wherever it stands. Windows that cut a character are left out."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + HASHED, "right")) - 1)
        raw = np.frombuffer(data, np.uint8)[bounds[low] : bounds[high]] if data is not None else np.zeros(0, np.uint8)
        rows = np.repeat(np.arange(low, high), np.diff(bounds[low : high + 1]))
        whole = np.append((raw & 0xC0) != 0x80, True)  # a character begins here
        power, inverse = (np.cumprod(np.append(np.uint64(1), np.full(len(raw), base, np.uint64)), dtype=np.uint64) for base in (_BASE, pow(_BASE, -1, 2**64)))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw + np.uint64(1)) * power[:-1], out=sums[1:])
        for n in lengths:
            places = max(0, len(raw) - n + 1)
            at = np.flatnonzero((rows[:places] == rows[n - 1 :]) & whole[:places] & whole[n:]) if places else np.zeros(0, np.int64)
            hashes = (sums[at + n] - sums[at]) * inverse[at] + np.uint64(n)
            hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
            yield raw, rows, n, at, hashes ^ (hashes >> np.uint64(29))
        low = high


def _slots(hashes: np.ndarray) -> list[np.ndarray]:
    return [((hashes >> np.uint64(by)) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64) for by in (0, 64 - FILTER_BITS)]


def _filter(needles: DataFrame) -> np.ndarray:
    """A Bloom filter of the needles' texts, as 64-bit words; its size is fixed."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.compute.binary_length(batch.column(0)).to_numpy(zero_copy_only=False)
            for n in np.unique(own).tolist():
                for *_, hashes in _windows(batch.column(0).filter(pa.array(own == n)), [n]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_slots(hashes)))], ["slot"])

    slots = needles.select("needle").mapInArrow(places, "slot long")
    word, bit = F.shiftright("slot", 6), F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")
    words = slots.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def first_within(hay: DataFrame, needles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """For each needle the least `entry_id` of the hay whose text contains it.

    `hay` is (text, entry_id, *by), `needles` (needle, *by); `by` must agree.
    Substrings of the lengths that needles have are hashed in the tasks; those
    that a filter of the needles lets pass are looked up by equality, and
    the least id is taken before the needles are joined: no pairs are made, and
    a needle that most of the hay contains costs one row per task."""
    needles = materialise(needles.where("needle <> ''").distinct(), "needles")
    lengths = sorted(r[0] for r in needles.select(F.octet_length("needle")).distinct().collect())
    if not lengths:
        return needles.withColumn("entry_id", F.lit(None).cast(hay.schema["entry_id"].dataType)).limit(0)
    shared = hay.sparkSession.sparkContext.broadcast(_filter(needles))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            for raw, rows, n, at, hashes in _windows(batch.column(0), lengths):
                for i in range(2):  # the second place only where the first is set
                    slot = _slots(hashes)[i]
                    hit = (words[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) > 0
                    at, hashes = at[hit], hashes[hit]
                if len(at):
                    texts = raw[at[:, None] + np.arange(n)].tobytes()
                    ends = pa.array(np.arange(len(at) + 1, dtype=np.int32) * n)
                    found = pa.StringArray.from_buffers(len(at), ends.buffers()[1], pa.py_buffer(texts))
                    yield pa.RecordBatch.from_arrays([found, *(c.take(pa.array(rows[at])) for c in batch.columns[1:])], names)

    kept = hay.where("text is not null").select("text", "entry_id", *by)
    names = ["needle", *kept.columns[1:]]
    schema = T.StructType([T.StructField("needle", T.StringType()), *kept.schema.fields[1:]])
    pieces = kept.mapInArrow(run, schema)
    asked = pieces.join(small_side(needles), ["needle", *by], "left_semi")
    return asked.groupBy("needle", *by).agg(F.min("entry_id").alias("entry_id"))


def first_containing(texts: DataFrame, hay: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """For each text the least `entry_id` of the hay that the text contains.
    `texts` is (text, *by), `hay` (needle, entry_id, *by)."""
    least = hay.where("needle <> ''").groupBy("needle", *by).agg(F.min("entry_id").alias("entry_id"))
    lengths = _lengths(least, "needle") or [1]
    pieces = texts.distinct().select("text", *by, F.explode(_pieces(F.col("text"), lengths)).alias("needle"))
    found = pieces.join(least, ["needle", *by])
    return found.groupBy("text", *by).agg(F.min("entry_id").alias("entry_id"))


def match_principals(requests: DataFrame, directory: DataFrame) -> DataFrame:
    """For each request (principal, role) the first entry of the directory
    (entry_id, fqn, display_name, role) that is the same principal: equal
    ignoring case, one name within the other, or the part after ``=`` within the
    display name; the entry's role must end with the requested role's name.
    Requests without a match get a null entry."""
    asked = materialise(
        requests.select("principal", "role").distinct().where("principal <> ''").select(
            "principal", "role", F.lower("principal").alias("_in"), role_name(F.col("role")).alias("_want"),
            F.expr("substring(lower(principal), instr(principal, '=') + 1)").alias("_ident"),
            F.contains("principal", F.lit("=")).alias("_typed"),
        ),
        "asked",
    )
    # An entry serves every requested role that its own role ends with.
    endings = F.transform(F.sequence(F.lit(1), F.length("role")), lambda i: F.substring(F.col("role"), i, F.length("role")))
    entries = materialise(
        directory.where("role <> ''").select(
            "entry_id", F.lower("fqn").alias("_fqn"), F.lower("display_name").alias("_shown"), F.explode(endings).alias("_want")
        ).join(small_side(asked.select("_want").distinct()), "_want", "left_semi"),
        "entries",
    )
    by = ["_want"]
    typed = asked.where("_typed AND _ident <> ''")
    in_name = first_within(entries.select(F.col("_fqn").alias("text"), "entry_id", *by), asked.select(F.col("_in").alias("needle"), *by), by)
    in_shown = first_within(entries.select(F.col("_shown").alias("text"), "entry_id", *by), typed.select(F.col("_ident").alias("needle"), *by), by)
    around = first_containing(asked.select(F.col("_in").alias("text"), *by), entries.select(F.col("_fqn").alias("needle"), "entry_id", *by), by)
    found = (
        asked.join(in_name.withColumnRenamed("needle", "_in"), ["_in", *by])
        .unionByName(asked.join(around.withColumnRenamed("text", "_in"), ["_in", *by]))
        .unionByName(typed.join(in_shown.withColumnRenamed("needle", "_ident"), ["_ident", *by]))
    )
    first = found.groupBy("principal", "role").agg(F.min("entry_id").alias("entry_id"))
    return requests.join(first, ["principal", "role"], "left")


def with_principal_details(matches: DataFrame, directory: DataFrame, attributes: Sequence[str] = ("fqn", "principal_type", "display_name", "notes")) -> DataFrame:
    """Attributes of the matched entry; null where nothing matched. `directory` is
    unique by entry_id; of its columns only the matched entries' are looked up."""
    matches = materialise(matches, "matches")  # asked for twice
    wanted = matches.select("entry_id").where("entry_id IS NOT NULL").distinct()
    found = materialise(directory.select("entry_id", *attributes).join(small_side(materialise(wanted, "matched")), "entry_id", "left_semi"), "details")
    return matches.join(small_side(found), "entry_id", "left")

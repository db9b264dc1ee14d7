"""Materialized views: aggregates kept as mergeable state and refreshed by batch.

State is appended, one small part per refresh, and merged when read; compaction
folds the parts into one. A refresh therefore costs what the new rows cost, not
what the view holds.

A source that is a :class:`Table` is followed by its batch ids: rows that come late,
at equal times or without a time are all seen, once. A source that is a plain
DataFrame has no batches; there only the time tells new rows from old.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, types as T
from pyspark.sql import functions as F

from .. import files
from ..functions.types import parse_timespan
from ..plans.stored import Functions, Query, run_query
from ..session import materialise, small_side
from ..sources.tables import Table
from .aggregates import Summary
from .lifecycle import INGESTION_TIME, micros, ntz
from .ordered import running_totals
from .schema import conform, merged


@dataclass(frozen=True)
class ViewSpec:
    """`query` (optional) shapes source rows before the summary; its input is
    ``{source}`` or the argument `source`."""

    summary: Summary
    query: Query | None = None
    time: str = INGESTION_TIME
    backfill: bool = False
    effective: datetime | None = None
    auto_update_schema: bool = False
    allow_without_rls: bool = False
    created_by: str | None = None  # datetime group key that dates backfilled state
    max_records: int | None = None
    concurrency: int = 1
    lookback: str | None = None  # rows of a key further apart than this are rows of their own in the view

    def __post_init__(self):
        if self.lookback is not None and (parse_timespan(self.lookback) <= 0 or self.max_records):
            raise ValueError("a look-back is a period, and its backfill is not cut in chunks")
        if self.effective is not None and not self.backfill:
            raise ValueError("an effective time needs backfill")
        if self.auto_update_schema and not self.summary.follows_source:
            raise ValueError("only arg_max(*), arg_min(*) and take_any(*) views can follow the source schema")
        if self.created_by and self.created_by not in self.summary.keys:
            raise ValueError("state can only be dated by a group key")


class MaterializedView:
    def __init__(self, spark: SparkSession, path: str, spec: ViewSpec, functions: Functions | None = None):
        self.spark, self.spec, self.functions = spark, spec, functions
        self.state = Table(spark, path)

    # -- state -------------------------------------------------------------
    def _shape(self, rows: DataFrame) -> DataFrame:
        if self.spec.query is None:
            return rows
        return run_query(self.spark, self.spec.query, self.functions, source=rows)

    def _upto(self, shaped: DataFrame):
        time = self.spec.time
        return (F.max(time) if time in shaped.columns else F.lit(None)).cast("timestamp_ntz").alias("_upto")

    def _partial(self, rows: DataFrame, created=None, keys: Sequence[str] = ()) -> DataFrame:
        """State with `_created`, its date, and `_upto`, the latest row in it, and
        so asked of the state. `keys` are more columns to group by."""
        shaped, summary = self._shape(rows), self.spec.summary
        if self.spec.lookback is not None:
            return self._sessions(shaped, created)
        if keys:
            summary = replace(summary, keys=[*keys, *summary.keys])
        state = summary.partial(shaped, self._upto(shaped))
        created = F.current_timestamp().cast("timestamp_ntz") if created is None else created
        return state.withColumn("_created", created)

    def _sessions(self, shaped: DataFrame, created) -> DataFrame:
        """State by key and run of rows that are less than the look-back apart; rows without a time are one run."""
        spec, time = self.spec, F.col(self.spec.time)
        if spec.time not in shaped.columns:
            raise ValueError(f"a view with a look-back keeps the time {spec.time!r}")
        span = f"{parse_timespan(spec.lookback)} microseconds"
        summary = replace(spec.summary, keys=[*spec.summary.keys, "_from"])
        # The runs of a batch are found by built-in session windows; whole-row measures then go by run.
        dated = shaped.where(time.isNotNull())
        runs = dated.groupBy(*spec.summary.keys, F.session_window(time.cast("timestamp"), span).alias("_run")).agg(F.min(time).alias("_from"), F.max(time).alias("_to"))
        runs = materialise(runs.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(spec.summary.keys)], "_from", "_to"), "runs")
        same = (time >= F.col("_from")) & (time <= F.col("_to"))
        for i, k in enumerate(spec.summary.keys):
            same = F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) & same
        placed = dated.join(small_side(runs), same).select(*shaped.columns, "_from")
        rows = placed.unionByName(shaped.where(time.isNull()).withColumn("_from", F.lit(None).cast(shaped.schema[spec.time].dataType)))
        created = F.current_timestamp().cast("timestamp_ntz") if created is None else created
        return summary.partial(rows, self._upto(rows)).withColumn("_created", created)

    def _joined_runs(self, state: DataFrame) -> DataFrame:
        """`state` with `_session`: runs of a key, from any batches, that are less than the look-back apart."""
        spec = self.spec
        line = Window.partitionBy(*spec.summary.keys).orderBy("_from", "_upto")
        before = F.max("_upto").over(line.rowsBetween(Window.unboundedPreceding, -1))
        begins = before.isNull() | (micros(F.col("_from")) - micros(before) >= parse_timespan(spec.lookback))
        return state.withColumn("_begins", begins.cast("int")).withColumn("_session", F.sum("_begins").over(line.rowsBetween(Window.unboundedPreceding, 0))).drop("_begins")

    def _state_schema(self, rows: DataFrame) -> T.StructType:
        shaped, summary = self._shape(rows), self.spec.summary
        if self.spec.lookback is not None:
            shaped, summary = shaped.withColumn("_from", F.col(self.spec.time)), replace(summary, keys=[*summary.keys, "_from"])
        return summary.state_schema(shaped, self._upto(shaped)).add("_created", T.TimestampNTZType())

    def _reach(self, part: str, rows: DataFrame) -> datetime | None:
        """The latest time in a written part, or in `rows` if the view's query
        leaves the time out."""
        written = self.state.read_staged(part).agg(F.max("_upto")).first()[0]
        if written is None and self.spec.time in rows.columns and self.spec.query is not None:
            return rows.agg(F.max(self.spec.time)).first()[0]
        return written

    def _fresh(self, source: Table) -> list[str]:
        """Batches of the source that the state does not hold."""
        known = set((self.state.notes.get("consumed") or []) if self.state.exists() else [])
        fresh = [b for b in source.batches if b not in known]
        if any(not known.isdisjoint(held) and not known.issuperset(held) for held in source.folders.values()):
            raise ValueError("the source has merged batches that the view holds with others that it does not; catch up before merging")
        return fresh

    def _all(self, source: DataFrame | Table, as_of: datetime | None) -> tuple[DataFrame, list[str]]:
        """Rows of the source and the batches they are in. Rows without a time count as old."""
        if isinstance(source, Table):
            if as_of is not None:
                raise ValueError("the batches of a table say what is in the state; as_of goes with a DataFrame")
            batches = source.batches
            return source.read_batches(batches), batches
        time = F.col(self.spec.time) if as_of is not None else None
        return (source if as_of is None else source.where((time <= ntz(as_of)) | time.isNull())), []

    def create(self, source: DataFrame | Table, *, as_of: datetime | None = None, source_secured: bool = False) -> "MaterializedView":
        """Build the first state: from all current rows, from rows that arrived
        after the effective time (or at no known time), or from nothing ("from now on")."""
        if source_secured and not self.spec.allow_without_rls:
            raise PermissionError("the source has row-level security; the view must be allowed to read past it")
        if self.state.exists():
            raise ValueError("the view exists")
        spec, time = self.spec, self.spec.time
        rows, consumed = self._all(source, as_of)
        if not spec.backfill:
            upto = rows.agg(F.max(time)).first()[0] if as_of is None else as_of
            self.state.append(self._partial(rows.limit(0)), batch="backfill", notes={"materialized_to": _text(upto), "consumed": consumed})
            return self
        if spec.effective is not None:
            rows = rows.where((F.col(time) > ntz(spec.effective)) | F.col(time).isNull())
        created = F.col(spec.created_by).cast("timestamp_ntz") if spec.created_by else None
        if not spec.max_records:
            written = [("backfill", self.state.stage(self._partial(rows, created)))]
        else:
            written = self._chunks(rows, created)
        upto = as_of or max(filter(None, (self._reach(part, rows) for _, part in written)), default=None)
        self.state.add_staged(dict(written), self._state_schema(rows), notes={"materialized_to": _text(upto), "consumed": consumed})
        return self

    def _chunks(self, rows: DataFrame, created) -> list[tuple[str, str]]:
        """The state by chunks of at most `max_records` rows, as (batch, part).

        The source is read once: its rows get the chunk of their second, by which
        they are grouped as well, and the state is written with a folder for each
        chunk. If the view's query leaves the chunk out, each chunk is a job with a
        time filter that reaches the scan."""
        spec, time = self.spec, F.col(self.spec.time)
        seconds = chunked_seconds(rows, spec.time, spec.max_records)
        bounds = seconds.groupBy("_chunk").agg(F.min("_low").alias("low"), F.max("_high").alias("high")).orderBy("_chunk").collect()
        label = {r["_chunk"]: f"backfill-{_text(r['low'])}" for r in bounds} | {-1: "backfill-undated"}
        at, chunk = (f"{'_' * max(1, max(map(len, rows.columns)))}{c}" for c in ("at", "chunk"))  # longer than any column
        places = small_side(seconds.select(F.col("_second").alias(at), F.col("_chunk").alias(chunk)))
        placed = rows.join(places, F.date_trunc("second", time) == F.col(at), "left").drop(at)
        placed = placed.withColumn(chunk, F.coalesce(chunk, F.lit(-1).cast("long")))
        if chunk in self._shape(placed).columns:
            part = self.state.stage(self._partial(placed, created, [chunk]).withColumnRenamed(chunk, "_chunk"), ["_chunk"])
            return [(name, f"{part}/_chunk={i}") for i, name in label.items() if files.exists(self.spark, f"{self.state.path}/{part}/_chunk={i}")]
        chunks = [(label[r["_chunk"]], rows.where((time >= ntz(r["low"])) & (time <= ntz(r["high"])))) for r in bounds]
        chunks.append((label[-1], rows.where(time.isNull())))
        with ThreadPoolExecutor(max(1, spec.concurrency)) as pool:
            return list(pool.map(lambda c: (c[0], self.state.stage(self._partial(c[1], created))), chunks))

    def refresh(self, batch: DataFrame, batch_id: str) -> "MaterializedView":
        """Fold in newly arrived rows. The same `batch_id` twice is a no-op."""
        batch_id = f"refresh-{batch_id}"
        if self.state.exists() and batch_id in self.state.batches:
            return self
        return self._fold(batch, batch_id)

    def catch_up(self, source: Table) -> "MaterializedView":
        """Fold in every batch of the source that the state does not hold. State and
        batch ids are one commit, so a run that died is simply repeated."""
        fresh = self._fresh(source)
        if not fresh:
            return self
        held = len(self.state.notes.get("consumed") or []) if self.state.exists() else 0
        return self._fold(source.read_batches(fresh), f"batches-{held + len(fresh)}", {"consumed": fresh})

    def _fold(self, batch: DataFrame, batch_id: str, listed: dict[str, list] | None = None) -> "MaterializedView":
        known = self.state.exists()
        partial = self._partial(batch)
        schema = partial.schema
        if known:
            # New source columns stay out unless the view follows its source.
            schema = merged(self.state.schema, schema) if self.spec.auto_update_schema else self.state.schema
        part = self.state.stage(conform(partial, schema))
        before = self.state.notes.get("materialized_to") if known else None
        upto = max(filter(None, (before, _text(self._reach(part, batch)))), default=None)
        self.state.add_staged({batch_id: part}, schema, notes={"materialized_to": upto}, listed=listed)
        return self

    def compact(self) -> "MaterializedView":
        """Fold all parts of the state into one."""
        dates = [F.max(c).alias(c) for c in ("_upto", "_created")]
        state, summary = self.state.read(), self.spec.summary
        if self.spec.lookback is not None:
            state, dates = self._joined_runs(state), [F.min("_from").alias("_from"), *dates]
            summary = replace(summary, keys=[*summary.keys, "_session"])
        self.state.swap_parts(self.state.batches, conform(summary.merge(state, *dates).drop("_session"), self.state.schema))
        return self

    def alter(self, spec: ViewSpec, source: DataFrame | Table, *, as_of: datetime | None = None) -> "MaterializedView":
        """Change the query: the state is built anew and switched in."""
        self.spec = spec
        rows, consumed = self._all(source, as_of)
        part = self.state.stage(self._partial(rows))
        upto = as_of or self._reach(part, rows)
        self.state.set_staged({"altered": part}, self._state_schema(rows), notes={"materialized_to": _text(upto), "consumed": consumed})
        return self

    # -- reading -----------------------------------------------------------
    @property
    def materialized_to(self) -> datetime | None:
        text = self.state.notes.get("materialized_to")
        return datetime.fromisoformat(text) if text else None

    def pending(self, source: DataFrame | Table) -> DataFrame:
        """Source rows that the state does not hold yet."""
        if isinstance(source, Table):
            return source.read_batches(self._fresh(source))
        upto = self.materialized_to
        return source if upto is None else source.where(F.col(self.spec.time) > ntz(upto))

    def read(self, source: DataFrame | Table | None = None) -> DataFrame:
        """The view. With `source`, rows not yet materialised count as well."""
        state = self.state.read()
        if source is not None:
            state = state.unionByName(self._partial(self.pending(source)), allowMissingColumns=True)
        if self.spec.lookback is None:
            return self.spec.summary.final(self.spec.summary.merge(state))
        by_session = replace(self.spec.summary, keys=[*self.spec.summary.keys, "_session"])
        return by_session.final(by_session.merge(self._joined_runs(state))).drop("_session")

    def status(self, source: DataFrame | Table, *, as_of: datetime, healthy_lag_micros: int, enabled: bool = True) -> DataFrame:
        """One row: materialised to, lag, rows pending, healthy, enabled."""
        upto = ntz(self.materialized_to)
        time = F.col(self.spec.time)
        lag = micros(ntz(as_of)) - micros(upto)
        if isinstance(source, Table):  # the parts that wait are read, not told apart row by row
            waiting = self.pending(source).agg(F.count(F.lit(1)).alias("rows_pending")).withColumn("_one", F.lit(1))
            found = source.read().agg(F.max(time).alias("source_to")).withColumn("_one", F.lit(1)).join(waiting, "_one")
        else:
            found = source.agg(F.count_if(upto.isNull() | (time > upto)).alias("rows_pending"), F.max(time).alias("source_to"))
        return found.select(
            upto.alias("materialized_to"),
            "source_to",
            lag.alias("lag_micros"),
            "rows_pending",
            F.when((F.col("rows_pending") == 0) | (lag <= healthy_lag_micros), "true").otherwise("false").alias("is_healthy"),
            F.lit(str(enabled).lower()).alias("is_enabled"),
        )


def _text(t: datetime | None) -> str | None:
    return t.isoformat(sep=" ") if t is not None else None


def chunked_seconds(rows: DataFrame, time: str, max_records: int) -> DataFrame:
    """(_second, _low, _high, _chunk): each arrival second with rows, its first and
    last time, and its chunk of at most `max_records` rows (a single second is
    never split). Only the counts per second are ordered."""
    second = F.date_trunc("second", time).alias("_second")
    counts = materialise(
        rows.where(F.col(time).isNotNull()).groupBy(second).agg(
            F.count(F.lit(1)).alias("_rows"), F.min(time).alias("_low"), F.max(time).alias("_high")
        ),
        "arrivals",
    )
    largest = counts.agg(F.max("_rows")).first()[0] or 0
    room = max_records - largest if largest < max_records else max_records
    placed = running_totals(counts, [], ["_second"], {"_upto": F.col("_rows")})
    chunk = F.floor((F.col("_upto") - 1) / max(1, room)).cast("long").alias("_chunk")
    return materialise(placed.select("_second", "_low", "_high", chunk), "chunks")


def chunk_bounds(rows: DataFrame, time: str, max_records: int) -> list[tuple[datetime, datetime]]:
    """Time ranges of at most `max_records` rows each. Only the ranges, one per chunk, come to the driver."""
    chunks = chunked_seconds(rows, time, max_records).groupBy("_chunk").agg(F.min("_low").alias("low"), F.max("_high").alias("high"))
    return [(r["low"], r["high"]) for r in chunks.orderBy("low").collect()]

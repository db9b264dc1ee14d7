"""Aggregates and materialized views."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators.aggregates import Arg, Count, Distinct, Sum, Summary, TakeAny
from ..operators.views import MaterializedView, ViewSpec
from ..session import fresh_dir
from .registry import each, load, query, ranges

LATEST = Summary(["user_id"], [Arg("row", "ts", ["event_id"])])
TOTALS = Summary(["event_type"], [Count("n"), Sum("total", "value", "decimal(38,2)"), Arg("last", "ts", ["event_id"], ["event_id"])])
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
LATEST_SQL = """SELECT event_id, ts, user_id, event_type, value, props FROM
                (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events {where}) WHERE r = 1"""
TOTALS_SQL = """SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, max_by(event_id, ts) AS event_id
                FROM events {where} GROUP BY event_type"""


def _totals(df):
    return df.withColumn("total", F.col("total").cast("double"))


def _view(spark, label, spec):
    return MaterializedView(spark, fresh_dir(spark, label), spec)


@query("arg_max", LATEST_SQL.format(where=""))
def arg_max(spark, sf):
    return agg.arg_max(load(spark, sf, "events"), "ts", ["user_id"], ["event_id"])


@query("arg_min", LATEST_SQL.format(where="").replace("DESC", "ASC"))
def arg_min(spark, sf):
    return agg.arg_min(load(spark, sf, "events"), "ts", ["user_id"], ["event_id"])


@query("take_any", "SELECT conv_id, min(turn) AS turn, min_by(role, turn) AS role, min_by(text, turn) AS text FROM conversations GROUP BY conv_id")
def take_any(spark, sf):
    return agg.take_any(load(spark, sf, "conversations"), ["conv_id"], ["turn"])


@query("take_any_unordered", "SELECT conv_id, true AS one_of_them FROM conversations GROUP BY conv_id")
def take_any_unordered(spark, sf):
    """Which turn is kept is open; that it is one of the conversation's is not."""
    turns = load(spark, sf, "conversations")
    kept = agg.take_any(turns, ["conv_id"])
    found = kept.join(turns.withColumn("_there", F.lit(True)), ["conv_id", "turn", "role", "text"], "left")
    return found.select("conv_id", F.coalesce("_there", F.lit(False)).alias("one_of_them"))


@query("count_by_key", "SELECT event_type, count(*) AS count_ FROM events GROUP BY event_type")
def count_by_key(spark, sf):
    return agg.count_by(load(spark, sf, "events"), ["event_type"])


@query("distinct_count_exact", "SELECT event_type, count(DISTINCT user_id) AS dcount_user FROM events GROUP BY event_type")
def distinct_count_exact(spark, sf):
    return agg.dcount(load(spark, sf, "events"), "user_id", ["event_type"], "dcount_user", exact=True)


@query("distinct_count_sketch", "SELECT l_returnflag, true AS within_five_percent FROM lineitem GROUP BY l_returnflag")
def distinct_count_sketch(spark, sf):
    """The estimate, merged from states of two halves, against the exact number."""
    lines = load(spark, sf, "lineitem")
    summary = Summary(["l_returnflag"], [Distinct("estimate", "l_orderkey")])
    states = summary.partial(lines.where("l_linestatus = 'F'")).unionByName(summary.partial(lines.where("l_linestatus <> 'F'")))
    exact = agg.dcount(lines, "l_orderkey", ["l_returnflag"], "exact", exact=True)
    both = summary.final(summary.merge(states)).join(exact, "l_returnflag")
    return both.select("l_returnflag", (F.abs(F.col("estimate") - F.col("exact")) <= 0.05 * F.col("exact")).alias("within_five_percent"))


@query("merge_partial_aggregates", TOTALS_SQL.format(where=""))
def merge_partial_aggregates(spark, sf):
    events, states = load(spark, sf, "events"), None
    for part in ranges("value", (5, 20, 80)):
        state = TOTALS.partial(events.where(part))
        states = state if states is None else states.unionByName(state)
    return _totals(TOTALS.final(TOTALS.merge(states)))


@query("view_backfill", LATEST_SQL.format(where=""))
def view_backfill(spark, sf):
    view = _view(spark, "latest", ViewSpec(LATEST, time="ts", backfill=True))
    return view.create(load(spark, sf, "events")).read().select(*EVENT_COLUMNS)


@query("view_effective_time", LATEST_SQL.format(where="WHERE ts > TIMESTAMP '2024-01-15'"))
def view_effective_time(spark, sf):
    view = _view(spark, "effective", ViewSpec(LATEST, time="ts", backfill=True, effective=datetime(2024, 1, 15)))
    return view.create(load(spark, sf, "events")).read().select(*EVENT_COLUMNS)


@query("view_from_now_on", LATEST_SQL.format(where="WHERE ts > TIMESTAMP '2024-01-20'"))
def view_from_now_on(spark, sf):
    """Created empty on the 20th; what arrived later counts."""
    events = load(spark, sf, "events")
    view = _view(spark, "from-now", ViewSpec(LATEST, time="ts"))
    view.create(events, as_of=datetime(2024, 1, 20))
    return view.read(events).select(*EVENT_COLUMNS)


DAYS = [datetime(2024, 1, d) for d in (8, 15, 22)]


@query("view_incremental_refresh", TOTALS_SQL.format(where=""))
def view_incremental_refresh(spark, sf):
    """Four batches; one is replayed, and the state is compacted on the way."""
    events = load(spark, sf, "events")
    view = _view(spark, "refreshed", ViewSpec(TOTALS, time="ts"))
    for i, part in enumerate(ranges("ts", DAYS)):
        batch = events.where(part)
        view.refresh(batch, str(i))
        if i == 2:
            view.compact().refresh(batch, str(i))
    return _totals(view.read())


@query("view_with_delta", TOTALS_SQL.format(where=""))
def view_with_delta(spark, sf):
    events = load(spark, sf, "events")
    view = _view(spark, "delta", ViewSpec(TOTALS, time="ts", backfill=True)).create(events, as_of=datetime(2024, 1, 12))
    return _totals(view.read(events))


@query("view_chunked_backfill", TOTALS_SQL.format(where=""))
def view_chunked_backfill(spark, sf):
    """A fifth of the rows per chunk, two chunks at a time."""
    events = load(spark, sf, "events")
    spec = ViewSpec(TOTALS, time="ts", backfill=True, max_records=max(1, events.count() // 5), concurrency=2)
    return _totals(_view(spark, "chunked", spec).create(events).read())


@query(
    "view_altered",
    """SELECT event_id, ts, user_id, upper(event_type) AS event_type, 1 AS newcol FROM
       (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
)
def view_altered(spark, sf):
    events = load(spark, sf, "events")
    view = _view(spark, "altered-view", ViewSpec(LATEST, time="ts", backfill=True)).create(events)
    changed = "SELECT event_id, ts, user_id, upper(event_type) AS event_type, 1 AS newcol FROM {source}"
    return view.alter(ViewSpec(LATEST, changed, time="ts"), events).read().select("event_id", "ts", "user_id", "event_type", "newcol")


@query("view_dated_by_key", "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS created, count(DISTINCT event_type) AS rows FROM events GROUP BY 1")
def view_dated_by_key(spark, sf):
    """Backfilled state is dated by the day it is about, not by the day of the run."""
    summary = Summary(["day", "event_type"], [Count("n")])
    by_day = "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP_NTZ) AS day, event_type, ts FROM {source}"
    spec = ViewSpec(summary, by_day, time="ts", backfill=True, created_by="day")
    view = _view(spark, "dated", spec).create(load(spark, sf, "events"))
    return view.state.read().groupBy(F.col("_created").alias("created")).agg(F.count(F.lit(1)).alias("rows"))


@query("view_past_row_security", LATEST_SQL.format(where=""))
def view_past_row_security(spark, sf):
    """The source is secured; with consent the view reads all its rows."""
    view = _view(spark, "consented", ViewSpec(LATEST, time="ts", backfill=True, allow_without_rls=True))
    return view.create(load(spark, sf, "events"), source_secured=True).read().select(*EVENT_COLUMNS)


@query(
    "view_status",
    """SELECT TIMESTAMP '2024-01-12' AS materialized_to, max(ts) AS source_to,
              CAST(epoch_us(TIMESTAMP '2024-02-01') - epoch_us(TIMESTAMP '2024-01-12') AS BIGINT) AS lag_micros,
              count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-12') AS rows_pending, 'false' AS is_healthy, 'true' AS is_enabled FROM events""",
)
def view_status(spark, sf):
    events = load(spark, sf, "events")
    view = _view(spark, "status", ViewSpec(TOTALS, time="ts", backfill=True)).create(events, as_of=datetime(2024, 1, 12))
    return view.status(events, as_of=datetime(2024, 2, 1), healthy_lag_micros=3_600_000_000)


@query("view_first_per_key", "SELECT conv_id, min(turn) AS turn, min_by(role, turn) AS role FROM conversations GROUP BY conv_id")
def view_first_per_key(spark, sf):
    """A deduplicating view: one turn per conversation, fed role by role."""
    turns = load(spark, sf, "conversations").select("conv_id", "turn", "role")
    view = _view(spark, "first", ViewSpec(Summary(["conv_id"], [TakeAny("row", "turn")])))
    for i, part in enumerate(each("role", ("assistant", "user"))):
        view.refresh(turns.where(part), str(i))
    return view.read().select("conv_id", "turn", "role")


@query(
    "view_lookback",
    """WITH line AS (SELECT *, max(ts) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM events WHERE ts IS NOT NULL),
       runs AS (SELECT user_id, ts, event_id, sum(CAST(before IS NULL OR ts >= before + INTERVAL 6 HOUR AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM line
                UNION ALL SELECT user_id, ts, event_id, 0 FROM events WHERE ts IS NULL)
       SELECT user_id, count(*) AS n, arg_min(event_id, {'ts': ts, 'id': event_id}) AS first_event FROM runs GROUP BY user_id, run""",
)
def view_lookback(spark, sf):
    """The first of the events of a user that follow each other within six hours.
    Three batches; the last two bring events from before those of the first."""
    events = load(spark, sf, "events")
    summary = Summary(["user_id"], [Count("n"), Arg("first_event", "ts", ["event_id"], ["event_id"], least=True)])
    view = _view(spark, "lookback", ViewSpec(summary, time="ts", lookback="6h", backfill=True))
    first, *later = (events.where(part) for part in each("event_type", ["view", "purchase"]))
    view.create(first)
    for i, batch in enumerate(later):
        view.refresh(batch, str(i))
        view.refresh(batch, str(i))
        view.compact() if i else None
    return view.read().select("user_id", "n", F.col("event_id").alias("first_event"))

"""Structured Streaming: update policies, export, batching, views and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F


from ..operators.aggregates import Arg, Count, Sum, Summary
from ..operators.segments import BatchingPolicy, seal_batches
from ..operators.views import MaterializedView, ViewSpec
from ..session import fresh_dir, materialise
from ..sources.external import ExternalTable
from ..sources.tables import Table
from ..streaming.export import ContinuousExport
from ..streaming.ingest import StreamBatcher, deduplicated, read_stream, start_append, start_view
from ..streaming.update_policy import Ingestion, UpdatePolicy
from .registry import each, load, query, ranges, spread


def _in_files(spark, df):
    """`df` as several files, each a range of ids, and how many make a third."""
    path = fresh_dir(spark, "event-files")
    df.repartitionByRange(spread(df), "event_id").write.parquet(path)
    return path, max(1, len(spark.read.parquet(path).inputFiles()) // 3)


def _event_stream(spark, sf):
    """Events in three or four micro-batches."""
    events = load(spark, sf, "events")
    path, third = _in_files(spark, events)
    return read_stream(spark, path, events.schema, maxFilesPerTrigger=str(third))


def _finish(running):
    running.awaitTermination()
    if running.exception() is not None:
        raise running.exception()


PURCHASES = UpdatePolicy("events", "purchases", "SELECT event_id, user_id, value FROM {source} WHERE event_type = 'purchase'")


@query("update_policy", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def update_policy(spark, sf):
    tables = Ingestion(spark, fresh_dir(spark, "tables"), [
        PURCHASES, UpdatePolicy("events", "clicks", "SELECT * FROM {source}", enabled=False)
    ])
    _finish(tables.start(_event_stream(spark, sf), "events", fresh_dir(spark, "checkpoint")))
    if tables.table("clicks").exists():
        raise AssertionError("a disabled policy wrote rows")
    return tables.table("purchases").read().select("event_id", "user_id", "value")


@query(
    "update_policy_failures",
    """SELECT 'kept' AS mode, count(*) AS source_rows, false AS target FROM events
       UNION ALL SELECT 'transactional', 0, false""",
)
def update_policy_failures(spark, sf):
    """A policy that divides by zero: without a transaction the source keeps its
    rows, with one nothing is written."""
    broken, found = "SELECT event_id, assert_true(value < 0) AS x FROM {source}", None
    for mode, transactional in (("kept", False), ("transactional", True)):
        tables = Ingestion(spark, fresh_dir(spark, mode), [UpdatePolicy("events", "bad", broken, transactional=transactional)])
        try:
            tables.ingest(load(spark, sf, "events"), "events", "1")
        except Exception:
            if not transactional:
                raise
        source = tables.table("events")
        rows = source.read() if source.exists() else load(spark, sf, "events").limit(0)
        row = rows.agg(F.count(F.lit(1)).alias("source_rows")).select(
            F.lit(mode).alias("mode"), "source_rows", F.lit(tables.table("bad").exists()).alias("target")
        )
        found = row if found is None else found.unionByName(row)
    return found


@query(
    "update_policy_properties",
    """SELECT event_id, TIMESTAMP '2024-01-31' AS _ingestion_time, 'morning,eu' AS _tags FROM events WHERE event_type = 'purchase'""",
)
def update_policy_properties(spark, sf):
    policy = UpdatePolicy("events", "purchases", PURCHASES.query, propagate=True)
    tables = Ingestion(spark, fresh_dir(spark, "tagged"), [policy])
    tables.ingest(load(spark, sf, "events"), "events", "1", as_of="2024-01-31", tags=["morning", "eu"])
    return tables.table("purchases").read().select("event_id", "_ingestion_time", "_tags")


@query(
    "update_policy_cascade",
    "SELECT user_id, count(*) AS purchases, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM events WHERE event_type = 'purchase' GROUP BY user_id",
)
def update_policy_cascade(spark, sf):
    """Events feed purchases, purchases feed sums per user and batch."""
    per_user = UpdatePolicy("purchases", "spending", lambda source: source.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("spent")
    ))
    tables = Ingestion(spark, fresh_dir(spark, "cascade"), [per_user, PURCHASES])
    _finish(tables.start(_event_stream(spark, sf), "events", fresh_dir(spark, "checkpoint")))
    return tables.table("spending").read().groupBy("user_id").agg(
        F.sum("n").alias("purchases"), F.sum("spent").cast("double").alias("spent")
    )


class _DyingIngestion(Ingestion):
    """Dies when the table `fatal` is committed."""

    fatal: str | None = None

    def table(self, name: str) -> Table:
        table = super().table(name)
        if name == self.fatal:
            table.add_staged = self._die
        return table

    def _die(self, *args, **more):
        raise OSError("the driver died")


@query(
    "update_policy_commit_failure",
    """SELECT moment, count(*) FILTER (WHERE moment = 'replayed' OR ts < TIMESTAMP '2024-01-15' OR ts IS NULL) AS source_rows,
              count(*) FILTER (WHERE event_type = 'purchase' AND (moment = 'replayed' OR ts < TIMESTAMP '2024-01-15' OR ts IS NULL)) AS target_rows
       FROM events, (VALUES ('crashed'), ('replayed')) t(moment) GROUP BY moment""",
)
def update_policy_commit_failure(spark, sf):
    """The second batch dies between the commits of its two tables, and is replayed."""
    policy = UpdatePolicy("events", "purchases", PURCHASES.query, transactional=True)
    tables = _DyingIngestion(spark, fresh_dir(spark, "dying"), [policy])
    first, second = (load(spark, sf, "events").where(part) for part in ranges("ts", ["2024-01-15"]))
    tables.ingest(first, "events", "1")
    counts = []
    for moment, tables.fatal in (("crashed", "purchases"), ("crashed", "events"), ("replayed", None), ("replayed", None)):
        try:
            tables.ingest(second, "events", "2")
        except OSError:
            if tables.fatal is None:
                raise
        tables.fatal = None
        rows = [tables.table(name).read().agg(F.count(F.lit(1)).alias(f"{name}_rows")) for name in ("events", "purchases")]
        counts.append(materialise(rows[0].withColumn("moment", F.lit(moment)).join(rows[1].withColumn("moment", F.lit(moment)), "moment"), "counts"))
    found = counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])
    return found.select("moment", F.col("events_rows").alias("source_rows"), F.col("purchases_rows").alias("target_rows")).distinct()


EXPORT_SCHEMA = "event_id:long, user_id:long, ts:datetime"


@query("continuous_export", "SELECT event_id, user_id, ts FROM events WHERE event_type <> 'error'")
def continuous_export(spark, sf):
    """Three runs and one without new rows: nothing twice, nothing lost."""
    external = ExternalTable(EXPORT_SCHEMA, "json", fresh_dir(spark, "exported"))
    export = ContinuousExport("SELECT event_id, user_id, ts FROM {source} WHERE event_type <> 'error'", external, time="ts")
    events, state = load(spark, sf, "events"), fresh_dir(spark, "export-state")
    for as_of in ("2024-01-10", "2024-01-20", "2024-01-20", "2100-01-01"):
        export.run(spark, events, state, as_of)
    return external.read(spark)


@query("continuous_export_stream", "SELECT event_id, user_id, ts FROM events")
def continuous_export_stream(spark, sf):
    external = ExternalTable(EXPORT_SCHEMA, "csv", fresh_dir(spark, "exported-stream"))
    export = ContinuousExport("SELECT event_id, user_id, ts FROM {source}", external)
    _finish(export.start(_event_stream(spark, sf), fresh_dir(spark, "checkpoint"), availableNow=True))
    return external.read(spark)


@query(
    "export_forced_latency_mixed_batch",
    """SELECT run, count(*) AS exported, min(event_id) AS first_id, max(event_id) AS last_id
       FROM (SELECT event_id, CASE WHEN ts IS NULL OR ts <= TIMESTAMP '2024-01-10' THEN 'first' WHEN ts <= TIMESTAMP '2024-01-20' THEN 'second' ELSE 'third' END AS run FROM events) GROUP BY run""",
)
def export_forced_latency_mixed_batch(spark, sf):
    """Two batches of all times each; every run gives the rows that have waited long enough, once."""
    external = ExternalTable("event_id:long", "parquet", fresh_dir(spark, "mixed"))
    export, state = ContinuousExport("SELECT event_id FROM {source}", external, forced_latency="2d", time="ts"), fresh_dir(spark, "mixed-state")
    source, events = Table(spark, fresh_dir(spark, "mixed-source")), load(spark, sf, "events")
    for label, part in zip(("errors", "others"), each("event_type", ["error"])):
        source.append(events.where(part), batch=label)
    for as_of in ("2024-01-12 00:00:00", "2024-01-22 00:00:00", "2024-01-22 00:00:00", "2100-01-01 00:00:00"):
        export.run(spark, source, state, as_of)
    rows = spark.read.parquet(external.path_list[0])
    run = F.when(F.col("run") == 0, "first").when(F.col("run") <= 2, "second").otherwise("third")
    return rows.groupBy(run.alias("run")).agg(F.count(F.lit(1)).alias("exported"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query(
    "export_forced_latency",
    """SELECT 'first' AS run, count(*) AS rows, max(ts) AS newest FROM events WHERE ts <= TIMESTAMP '2024-01-18'
       UNION ALL SELECT 'second', count(*), max(ts) FROM events WHERE ts > TIMESTAMP '2024-01-18' AND ts <= TIMESTAMP '2024-01-28'""",
)
def export_forced_latency(spark, sf):
    """Rows of the last two days wait; those held back leave with the next run."""
    external = ExternalTable(EXPORT_SCHEMA, "parquet", fresh_dir(spark, "late"))
    export = ContinuousExport("SELECT * FROM {source}", external, forced_latency="2d", time="ts")
    state, found = fresh_dir(spark, "late-state"), None
    for run, as_of in (("first", "2024-01-20"), ("second", "2024-01-30")):
        export.run(spark, load(spark, sf, "events"), state, as_of)
    folders = sorted({path.rsplit("/", 1)[0] for path in external.read(spark).inputFiles()})
    for run, folder in zip(("first", "second"), folders):
        rows = spark.read.schema(external.struct).parquet(folder).agg(F.count(F.lit(1)).alias("rows"), F.max("ts").alias("newest"))
        rows = rows.select(F.lit(run).alias("run"), "rows", "newest")
        found = rows if found is None else found.unionByName(rows)
    return found


BATCH_POLICY = BatchingPolicy(max_items=20, max_bytes=600, max_span_micros=3 * 86_400_000_000)


def _batch_sql(key: str) -> str:
    return f"""WITH RECURSIVE items AS (
  SELECT {key} AS k, ts, CAST(ceil(value) AS BIGINT) AS size, CAST(row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) AS BIGINT) AS n FROM events),
 steps AS (
  SELECT k, n, ts, size, n AS start, ts AS first, CAST(1 AS BIGINT) AS c, size AS b FROM items WHERE n = 1
  UNION ALL
  SELECT i.k, i.n, i.ts, i.size,
         CASE WHEN s.c >= 20 OR s.b >= 600 OR i.ts >= s.first + INTERVAL 3 DAY THEN i.n ELSE s.start END,
         CASE WHEN s.c >= 20 OR s.b >= 600 OR i.ts >= s.first + INTERVAL 3 DAY THEN i.ts ELSE s.first END,
         CASE WHEN s.c >= 20 OR s.b >= 600 OR i.ts >= s.first + INTERVAL 3 DAY THEN 1 ELSE s.c + 1 END,
         CASE WHEN s.c >= 20 OR s.b >= 600 OR i.ts >= s.first + INTERVAL 3 DAY THEN i.size ELSE s.b + i.size END
  FROM steps s JOIN items i ON i.k = s.k AND i.n = s.n + 1)
 SELECT k AS {key}, min(ts) AS first_time, max(ts) AS last_time, count(*) AS items, CAST(sum(size) AS BIGINT) AS bytes,
        CASE WHEN count(*) >= 20 THEN 'items' WHEN sum(size) >= 600 THEN 'bytes'
             WHEN max(n) < max(any_value(m)) OVER (PARTITION BY k) THEN 'age' ELSE 'open' END AS sealed_by
 FROM (SELECT *, max(n) OVER (PARTITION BY k) AS m FROM steps) GROUP BY k, start"""


def _items(spark, sf):
    return load(spark, sf, "events").withColumn("size", F.ceil("value").cast("long"))


@query("ingestion_batching", _batch_sql("user_id"))
def ingestion_batching(spark, sf):
    return seal_batches(_items(spark, sf), ["user_id"], "ts", ["event_id"], "size", BATCH_POLICY).drop("batch_start")


@query("ingestion_batching_hot_source", _batch_sql("event_type"))
def ingestion_batching_hot_source(spark, sf):
    """Few sources with many items each, cut into blocks that run apart."""
    return seal_batches(_items(spark, sf), ["event_type"], "ts", ["event_id"], "size", BATCH_POLICY, block_rows=500).drop("batch_start")


@query("ingestion_batching_stream", f"SELECT user_id, first_time, last_time, items, bytes, sealed_by FROM ({_batch_sql('user_id')}) WHERE sealed_by <> 'open'")
def ingestion_batching_stream(spark, sf):
    """The same batches when events arrive in three micro-batches, week by week."""
    path, checkpoint, items = fresh_dir(spark, "weeks"), fresh_dir(spark, "checkpoint"), _items(spark, sf)
    batcher = StreamBatcher(spark, fresh_dir(spark, "batcher"), ["user_id"], "ts", ["event_id"], "size", BATCH_POLICY)
    for part in ranges("ts", ("2024-01-10", "2024-01-20")):
        items.where(part & F.col("ts").isNotNull()).write.mode("append").parquet(path)
        _finish(batcher.start(read_stream(spark, path, items.schema), checkpoint))
    return batcher.sealed.read()


@query("streaming_ingestion", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def streaming_ingestion(spark, sf):
    """A rate hint that lets a third of the files in every 10 seconds."""
    events = load(spark, sf, "events")
    path, third = _in_files(spark, events)
    size = spark.read.format("binaryFile").load(f"{path}/*.parquet").select("length").agg(F.max("length")).first()[0]
    stream = read_stream(spark, path, events.schema, rate_gb_per_hour=third * size * 360 / 1024**3, every="10s")
    table = Table(spark, fresh_dir(spark, "streamed"))
    _finish(start_append(table, stream, fresh_dir(spark, "checkpoint")))
    return table.read()


@query(
    "streaming_view",
    """SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, max_by(event_id, ts) AS event_id FROM events GROUP BY event_type""",
)
def streaming_view(spark, sf):
    summary = Summary(["event_type"], [Count("n"), Sum("total", "value", "double"), Arg("last", "ts", ["event_id"], ["event_id"])])
    view = MaterializedView(spark, fresh_dir(spark, "streamed-view"), ViewSpec(summary, time="ts"))
    _finish(start_view(view, _event_stream(spark, sf), fresh_dir(spark, "checkpoint")))
    return view.read()


@query("deduplication_with_lookback", "SELECT event_id, ts, user_id FROM events")
def deduplication_with_lookback(spark, sf):
    """Every event is delivered twice and kept once."""
    events = load(spark, sf, "events").select("event_id", "ts", "user_id")
    path, _ = _in_files(spark, events.unionAll(events))
    once = deduplicated(read_stream(spark, path, events.schema), "ts", ["event_id"], "45d")
    table = Table(spark, fresh_dir(spark, "once"))
    _finish(start_append(table, once, fresh_dir(spark, "checkpoint")))
    return table.read()

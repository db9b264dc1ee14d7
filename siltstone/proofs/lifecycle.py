"""Ingestion time, retention, partitioning, small-file merge and security."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lifecycle as life
from ..operators import security as sec
from ..operators.aggregates import Arg, Summary
from ..operators.views import MaterializedView, ViewSpec
from ..plans import policies
from ..plans.stored import Functions
from ..session import fresh_dir, materialise
from ..sources.tables import Table
from .registry import each, load, query, ranges

AS_OF = "2024-01-31 00:00:00"


def _arrived(spark, sf):
    """Events with their time as the time of arrival."""
    return life.with_ingestion_time(load(spark, sf, "events"), as_of=F.col("ts"))


@query("ingestion_time", "SELECT event_id, TIMESTAMP '2024-01-31' AS _ingestion_time, CAST(NULL AS TIMESTAMP) AS when_off FROM events")
def ingestion_time(spark, sf):
    events = load(spark, sf, "events").select("event_id")
    off = life.with_ingestion_time(events, enabled=False).withColumnRenamed("_ingestion_time", "when_off")
    return life.with_ingestion_time(off, as_of=AS_OF).select("event_id", "_ingestion_time", "when_off")


@query(
    "retention",
    """SELECT event_type, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-17') AS kept,
              count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-17') AS recoverable, CAST(0 AS BIGINT) AS unrecoverable FROM events GROUP BY event_type""",
)
def retention(spark, sf):
    events = _arrived(spark, sf)
    keep, drop = life.Retention("14d"), life.Retention("14d", recoverable=False)
    sets = (
        life.retained(events, keep, AS_OF).withColumn("what", F.lit("kept"))
        .unionByName(life.expired(events, keep, AS_OF).withColumn("what", F.lit("recoverable")))
        .unionByName(life.expired(events, drop, AS_OF).withColumn("what", F.lit("unrecoverable")))
    )
    names = ("kept", "recoverable", "unrecoverable")
    return sets.groupBy("event_type").agg(*[F.count_if(F.col("what") == w).alias(w) for w in names])


def _aged(spark, sf):
    """A table of all events whose batches are a week each; rows without a time are in the first."""
    table, weeks = Table(spark, fresh_dir(spark, "aged")), ["2024-01-08", "2024-01-15", "2024-01-22"]
    for i, part in enumerate(ranges("ts", weeks)):
        table.append(_arrived(spark, sf).where(part), batch=str(i))
    return table


KEPT_PARTS = """WITH e AS (SELECT *, CASE WHEN ts IS NULL OR ts < TIMESTAMP '2024-01-15' THEN 0 WHEN ts < TIMESTAMP '2024-01-22' THEN 1 ELSE 2 END AS part FROM events),
       ends AS (SELECT part, max(ts) < TIMESTAMP '2024-01-24' AND count(*) = count(ts) AS gone FROM e GROUP BY part)"""


@query("retention_drop", KEPT_PARTS + """ SELECT event_type, count(*) AS stored, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-24' OR ts IS NULL) AS visible
       FROM e JOIN ends USING (part) WHERE NOT gone GROUP BY event_type""")
def retention_drop(spark, sf):
    """Weeks that are over a week old leave the table; what is left of others is hidden. Dropping twice changes nothing."""
    table, policy = _aged(spark, sf), life.Retention("7d")
    life.drop_expired(table, policy, AS_OF)
    life.drop_expired(table, policy, AS_OF)
    visible = F.col("_ingestion_time") >= life.before(AS_OF, "7d")
    return table.read().groupBy("event_type").agg(
        F.count(F.lit(1)).alias("stored"), F.count_if(visible | F.col("_ingestion_time").isNull()).alias("visible")
    )


@query("retention_recover", KEPT_PARTS + """ SELECT event_type, count(*) FILTER (WHERE NOT gone) AS after_drop, count(*) AS after_recovery,
       count(*) FILTER (WHERE NOT gone) AS after_late_recovery FROM e JOIN ends USING (part) GROUP BY event_type""")
def retention_recover(spark, sf):
    """Dropped weeks come back within the interval, once; after it they do not, and a replayed batch stays out."""
    table, policy, found = _aged(spark, sf), life.Retention("7d"), []

    def count(moment):
        found.append(materialise(table.read().groupBy("event_type").agg(F.count(F.lit(1)).alias(moment)), "moment"))

    life.drop_expired(table, policy, AS_OF)
    count("after_drop")
    life.recover_expired(table, policy, "2024-02-05 00:00:00")
    life.recover_expired(table, policy, "2024-02-05 00:00:00")
    count("after_recovery")
    life.drop_expired(table, policy, AS_OF)
    table.append(_arrived(spark, sf), batch="0")
    life.recover_expired(table, policy, "2024-02-15 00:00:00")
    count("after_late_recovery")
    both = found[1].join(found[0], "event_type", "left").join(found[2], "event_type", "left")
    return both.select("event_type", *[F.coalesce(m, F.lit(0)).alias(m) for m in ("after_drop", "after_recovery", "after_late_recovery")])


@query(
    "retention_by_policy",
    """SELECT l_linestatus, l_returnflag, count(*) AS kept, min(l_shipdate) AS oldest FROM lineitem
       WHERE l_shipdate >= CASE WHEN l_returnflag = 'A' THEN TIMESTAMP '2001-06-01' - INTERVAL 365 DAY
                                WHEN l_linestatus = 'F' THEN TIMESTAMP '2001-06-01' - INTERVAL 1000 DAY ELSE TIMESTAMP '1900-01-01' END
       GROUP BY l_linestatus, l_returnflag""",
)
def retention_by_policy(spark, sf):
    """Line statuses as databases, return flags as tables. Flag A has a policy of
    its own, status F one for all its tables, the others none."""
    lines = load(spark, sf, "lineitem").select(
        F.col("l_linestatus").alias("database_name"), F.col("l_returnflag").alias("entity_name"), "l_shipdate"
    )
    entities = lines.select("database_name", "entity_name").distinct()
    own = entities.where("entity_name = 'A'").withColumn("policy", F.lit('{"SoftDeletePeriod": "365.00:00:00", "Recoverability": "Enabled"}'))
    general = entities.where("database_name = 'F'").select("database_name").distinct().select(
        "database_name", F.lit(None).cast("string").alias("entity_name"), F.lit('{"SoftDeletePeriod": "1000d"}').alias("policy")
    )
    applied = sec.resolve_scope(entities, own.unionByName(general), "policy", "policy")
    kept = life.retained_by_policy(lines, applied, ["database_name", "entity_name"], "2001-06-01", "l_shipdate")
    return kept.groupBy(F.col("database_name").alias("l_linestatus"), F.col("entity_name").alias("l_returnflag")).agg(
        F.count(F.lit(1)).alias("kept"), F.min("l_shipdate").alias("oldest")
    )


@query("hot_window", "SELECT event_type, count(*) AS hot FROM events WHERE ts >= TIMESTAMP '2024-01-28' GROUP BY event_type")
def hot_window(spark, sf):
    return life.hot_rows(_arrived(spark, sf), "3d", AS_OF).groupBy("event_type").agg(F.count(F.lit(1)).alias("hot"))


@query(
    "hash_partitioning",
    "SELECT count(*) AS rows, true AS one_place_each, true AS in_range, true AS pruned_lookup FROM lineitem",
)
def hash_partitioning(spark, sf):
    """Written by hash of the order; every order lies in one folder, and a lookup
    through the partition finds what a plain filter finds."""
    lines = load(spark, sf, "lineitem")
    key = life.HashKey("l_orderkey", 64, seed=2, mode="Uniform")
    path = fresh_dir(spark, "hashed")
    life.Partitioning([key]).write(lines, path, time="l_shipdate")
    written = spark.read.parquet(path)
    places = written.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.min(key.name).alias("low"), F.max(key.name).alias("high")
    )
    top = lines.agg(F.max("l_orderkey")).first()[0]
    looked_up, plain = written.where(key.equals(top, "bigint")).count(), lines.where(F.col("l_orderkey") == top).count()
    return places.agg(
        F.sum("n").alias("rows"), F.min(F.col("low") == F.col("high")).alias("one_place_each"),
        F.min((F.col("low") >= 0) & (F.col("high") < 64)).alias("in_range"),
    ).withColumn("pruned_lookup", F.lit(looked_up == plain and plain > 0))


RANGE_SQL = """TIMESTAMP '1990-01-01' + INTERVAL 1 DAY * CAST(2 * floor((epoch_us({t}) - epoch_us(TIMESTAMP '1990-01-01')) / 172800000000) AS INTEGER)"""


@query("range_partitioning", f"SELECT {RANGE_SQL.format(t='ts')} AS starts, count(*) AS rows, max(event_id) AS last_id FROM events GROUP BY 1")
def range_partitioning(spark, sf):
    key = life.RangeKey("ts", "2.00:00:00", "1990-01-01", override_creation_time=True)
    placed = life.Partitioning([key]).assign(_arrived(spark, sf))
    return placed.groupBy(F.col("_created").alias("starts")).agg(F.count(F.lit(1)).alias("rows"), F.max("event_id").alias("last_id"))


@query(
    "range_partition_pruning",
    """SELECT event_type, count(*) AS rows FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13 12:00:00' GROUP BY event_type""",
)
def range_partition_pruning(spark, sf):
    """A time filter, rewritten so that only the folders of those days are read."""
    key, path = life.RangeKey("ts", "2d", "1990-01-01"), fresh_dir(spark, "ranged")
    life.Partitioning([key]).write(_arrived(spark, sf), path)
    some = spark.read.schema(_ranged_schema(spark, sf, key)).parquet(path).where(key.between("2024-01-10", "2024-01-13 12:00:00"))
    return some.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


def _ranged_schema(spark, sf, key):
    return life.Partitioning([key]).assign(_arrived(spark, sf)).schema


@query(
    "mixed_partitioning",
    f"""SELECT CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN {RANGE_SQL.format(t='ts')} END AS starts, ts < TIMESTAMP '2024-01-10' AS outside,
              count(*) AS rows, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2""",
)
def mixed_partitioning(spark, sf):
    """By user and by two days, for rows that arrived from the 10th on."""
    keys = [life.HashKey("user_id", 8), life.RangeKey("ts", "2d", "1990-01-01")]
    placed = life.Partitioning(keys, effective="2024-01-10").assign(_arrived(spark, sf))
    return placed.groupBy(F.col(keys[1].name).alias("starts"), (F.col(keys[0].name) == -1).alias("outside")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("users")
    )


MERGE_SQL = """WITH RECURSIVE files AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY table_name ORDER BY created) AS BIGINT) AS n FROM
  (SELECT o_orderpriority AS table_name, o_orderdate AS created, count(*) AS rows, CAST(sum(floor(o_totalprice)) AS BIGINT) AS bytes
   FROM orders GROUP BY o_orderpriority, o_orderdate)),
 steps AS (
  SELECT table_name, n, created, rows, bytes, n AS start, created AS first, rows AS r, bytes AS b FROM files WHERE n = 1
  UNION ALL
  SELECT f.table_name, f.n, f.created, f.rows, f.bytes,
         CASE WHEN fits THEN s.start ELSE f.n END, CASE WHEN fits THEN s.first ELSE f.created END,
         CASE WHEN fits THEN s.r + f.rows ELSE f.rows END, CASE WHEN fits THEN s.b + f.bytes ELSE f.bytes END
  FROM (SELECT s.*, f.table_name AS ft, f.n AS fn,
               f.n - s.start < 10 AND s.r + f.rows <= 15 AND s.b + f.bytes <= 2097152 AND f.created <= s.first + INTERVAL 10 DAY AS fits
        FROM steps s JOIN files f ON f.table_name = s.table_name AND f.n = s.n + 1) s
  JOIN files f ON f.table_name = s.ft AND f.n = s.fn)
 SELECT table_name, start AS merge_group, count(*) AS files, CAST(sum(rows) AS BIGINT) AS rows, min(created) AS oldest, max(created) AS newest
 FROM steps GROUP BY table_name, start HAVING count(*) > 1"""


@query("merge_grouping", MERGE_SQL)
def merge_grouping(spark, sf):
    """Files made of the orders of a day and priority, their prices as sizes,
    grouped under bounds on rows, bytes, files and age."""
    files = load(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("table_name"), F.col("o_orderdate").alias("created")
    ).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.floor("o_totalprice")).alias("bytes"),
        F.date_format(F.first("o_orderdate"), "yyyyMMdd").alias("path"),
    )
    policy = life.MergePolicy(max_rows=15, max_mb=2, max_files=10, max_range_hours=240, lookback="All")
    plan = life.plan_merges(files, ["table_name"], policy, AS_OF)
    return plan.groupBy("table_name", "merge_group").agg(
        F.first("files").alias("files"), F.sum("rows").alias("rows"), F.min("created").alias("oldest"), F.max("created").alias("newest")
    )


@query("merge_run", "SELECT o_orderstatus, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, true AS fewer_parts FROM orders GROUP BY o_orderstatus")
def merge_run(spark, sf):
    """Fifteen small parts become one; the rows stay the same."""
    orders, table = load(spark, sf, "orders"), Table(spark, fresh_dir(spark, "merged"))
    for status in each("o_orderstatus", ("F", "O")):
        for priority in each("o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")):
            table.append(orders.where(status & priority))
    before = len(table.folders)
    life.run_merges(table, life.MergePolicy(lookback="All"), AS_OF)
    return table.read().groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys")
    ).withColumn("fewer_parts", F.lit(len(table.folders) < before))


# -- row-level security ----------------------------------------------------
@query(
    "row_security_on_table",
    """SELECT o_orderkey, o_orderdate, o_totalprice, 'secured' AS reader FROM orders WHERE year(o_orderdate) = 1996
       UNION ALL SELECT o_orderkey, o_orderdate, o_totalprice, 'open' FROM orders""",
)
def row_security_on_table(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    functions = Functions(spark).register(
        "only_1996", "SELECT * FROM {source} WHERE o_orderdate >= TIMESTAMP_NTZ'1996-01-01' AND o_orderdate < TIMESTAMP_NTZ'1997-01-01'",
        skip_validation=True,
    )
    on, off = sec.RowSecurity("only_1996"), sec.RowSecurity("only_1996", enabled=False)
    return sec.secured(orders, on, "anyone", functions).withColumn("reader", F.lit("secured")).unionByName(
        sec.secured(orders, off, "anyone", functions).withColumn("reader", F.lit("open"))
    )


@query(
    "row_security_by_principal",
    """SELECT o_orderkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_7'""",
)
def row_security_by_principal(spark, sf):
    """A reader named after a nation sees the orders of that nation."""
    orders = load(spark, sf, "orders").join(load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        load(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("o_orderkey", "c_nationkey", "n_name")
    policy = sec.RowSecurity(lambda source: source.where("n_name = _principal"))
    return sec.secured(orders, policy, "NATION_7").select("o_orderkey", "c_nationkey")


@query(
    "row_security_on_view",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
       WHERE r = 1 AND event_type = 'click'""",
)
def row_security_on_view(spark, sf):
    spec = ViewSpec(Summary(["user_id"], [Arg("row", "ts", ["event_id"], ["event_id", "event_type"])]), time="ts", backfill=True, allow_without_rls=True)
    view = MaterializedView(spark, fresh_dir(spark, "secured-view"), spec).create(load(spark, sf, "events"), source_secured=True)
    return sec.secured(view.read(), sec.RowSecurity("SELECT * FROM {source} WHERE event_type = 'click'"), "anyone")


@query(
    "restricted_table",
    """SELECT s_suppkey, who FROM supplier, (VALUES ('granted'), ('unrestricted')) w(who)""",
)
def restricted_table(spark, sf):
    """Grants: each customer on the table named after its segment."""
    supplier = load(spark, sf, "supplier").select("s_suppkey")
    grants = load(spark, sf, "customer").select(F.col("c_mktsegment").alias("table_name"), F.col("c_name").alias("principal"))
    some = load(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").agg(F.min("c_name")).first()[0]
    views = {
        "granted": sec.restricted(supplier, grants, "BUILDING", some.upper()),
        "denied": sec.restricted(supplier, grants, "MACHINERY", some),
        "unrestricted": sec.restricted(supplier, grants, "MACHINERY", some, enabled=False),
    }
    found = None
    for who, rows in views.items():
        rows = rows.withColumn("who", F.lit(who))
        found = rows if found is None else found.unionByName(rows)
    return found


@query(
    "effective_access",
    """SELECT table_name, principal, CASE role WHEN 'admins' THEN 'Admin' ELSE 'Ingestor' END AS role FROM
       (SELECT o_orderpriority AS table_name, o_custkey AS principal, CASE WHEN o_totalprice > 250000 THEN 'admins' ELSE 'ingestors' END AS role,
               max_by(o_orderstatus, (o_orderdate, o_orderstatus = 'P')) AS last FROM orders GROUP BY ALL) WHERE last <> 'P'""",
)
def effective_access(spark, sf):
    """Orders as a log of grants; status P drops the role."""
    log = load(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("table_name"), F.col("o_custkey").alias("principal"),
        F.when(F.col("o_totalprice") > 250000, "admins").otherwise("ingestors").alias("role"),
        F.when(F.col("o_orderstatus") == "P", "drop").otherwise("add").alias("action"), F.col("o_orderdate").alias("at"),
    )
    return sec.effective_access(log)


@query(
    "policy_scope",
    """SELECT c.c_name AS entity_name, n.n_name AS database_name,
              CASE WHEN c.c_mktsegment = 'BUILDING' THEN CAST(30 AS BIGINT) WHEN n.n_regionkey < 3 THEN CAST(365 AS BIGINT) END AS days,
              CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'entity' WHEN n.n_regionkey < 3 THEN 'database' ELSE 'none' END AS policy_scope
       FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def policy_scope(spark, sf):
    """Nations as databases, customers as tables; a table's own policy wins."""
    nation = load(spark, sf, "nation")
    tables = load(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    entities = tables.select(F.col("n_name").alias("database_name"), F.col("c_name").alias("entity_name"))
    policies = nation.where("n_regionkey < 3").select(
        F.col("n_name").alias("database_name"), F.lit(None).cast("string").alias("entity_name"), F.lit(365).cast("long").alias("days")
    ).unionByName(
        tables.where("c_mktsegment = 'BUILDING'").select(
            F.col("n_name").alias("database_name"), F.col("c_name").alias("entity_name"), F.lit(30).cast("long").alias("days")
        )
    )
    return sec.resolve_scope(entities, policies, "days", "days").select("entity_name", "database_name", "days", "policy_scope")


DOCUMENTS = [
    ("row_level_security", '{"IsEnabled": true, "Query": "SELECT * FROM {source} WHERE event_type <> \'error\'"}'),
    ("ingestion_time", '{"IsEnabled": false}'),
    ("restricted_view", '{"IsEnabled": true}'),
    ("request_classification", '{"IsEnabled": true, "ClassificationFunction": "CASE WHEN hour(ts) < 6 THEN \'ASIA\' WHEN value > 50 THEN \'Nowhere\' END"}'),
]


@query(
    "policy_documents",
    """SELECT CASE WHEN hour(ts) < 6 THEN 'ASIA' ELSE 'default' END AS workload_group, count(*) AS requests, CAST(0 AS BIGINT) AS stamped, CAST(0 AS BIGINT) AS seen_without_grant
       FROM events WHERE event_type <> 'error' GROUP BY 1""",
)
def policy_documents(spark, sf):
    """Documents of four policies, read and applied to all events; regions are the groups that exist."""
    text = dict(DOCUMENTS)
    stamped = life.with_ingestion_time(load(spark, sf, "events"), enabled=policies.is_enabled(text["ingestion_time"]), as_of=AS_OF)
    rows = sec.secured(stamped, policies.row_security(text["row_level_security"]), "someone")
    grants = spark.createDataFrame([], "table_name string, principal string, role string")
    seen = sec.restricted(rows, grants, "events", "someone", policies.is_enabled(text["restricted_view"])).select("event_id", F.lit(1).alias("_seen"))
    groups = load(spark, sf, "region").select(F.col("r_name").alias("group_name"))
    grouped = policies.classification(text["request_classification"]).apply(rows.join(seen, "event_id", "left"), groups)
    return grouped.groupBy("workload_group").agg(
        F.count(F.lit(1)).alias("requests"), F.count("_ingestion_time").alias("stamped"), F.count("_seen").alias("seen_without_grant")
    )

"""Data-quality checks and request logs."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..functions.scalars import has_term, member, parse_dynamic
from ..operators import quality as q
from ..operators import requests as req
from ..operators.lifecycle import from_micros, micros
from ..operators.security import is_member
from .registry import load, query


@query("check_length", "SELECT doc_id, 'length' AS rule FROM documents WHERE NOT (octet_length(encode(text)) BETWEEN 200 AND 5000)")
def check_length(spark, sf):
    return q.violations(load(spark, sf, "documents"), [q.Check("length", q.length_between("text", 200, 5000))], ["doc_id"])


@query(
    "check_set",
    """SELECT doc_id, 'lang' AS rule FROM documents WHERE lang NOT IN ('en', 'de')
       UNION ALL SELECT doc_id, 'source' FROM documents WHERE lower(source) NOT IN ('src1', 'src2', 'src3')""",
)
def check_set(spark, sf):
    checks = [q.Check("lang", q.in_set("lang", ["en", "de"])), q.Check("source", q.in_set("source", ["SRC1", "Src2", "src3"], ignore_case=True))]
    return q.violations(load(spark, sf, "documents"), checks, ["doc_id"])


@query("check_not_empty", "SELECT 'url' AS rule, count(*) AS rows, count(*) FILTER (WHERE url IS NULL OR url = '') AS violations FROM pages")
def check_not_empty(spark, sf):
    return q.violation_counts(load(spark, sf, "pages"), [q.Check("url", q.not_empty("url"))])


@query("check_pattern", r"SELECT page_id, 'https' AS rule FROM pages WHERE NOT regexp_matches(url, '^https://[^/]+\.example\.(com|org)/')")
def check_pattern(spark, sf):
    return q.violations(load(spark, sf, "pages"), [q.Check("https", q.matches("url", r"^https://[^/]+\.example\.(com|org)/"))], ["page_id"])


@query(
    "check_json",
    """SELECT 'props' AS rule, count(*) AS rows, CAST(0 AS BIGINT) AS violations FROM events
       UNION ALL SELECT 'cut', count(*), count(*) FILTER (WHERE event_type = 'error') FROM events
       UNION ALL SELECT 'twice', count(*), count(*) FILTER (WHERE event_type = 'view') FROM events""",
)
def check_json(spark, sf):
    events = load(spark, sf, "events").withColumn(
        "cut", F.when(F.col("event_type") == "error", F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    ).withColumn(  # a name that occurs twice is fine, a second value is not
        "twice", F.concat(F.lit('{"a":1,"a":'), F.col("props"), F.when(F.col("event_type") == "view", '}, "--end of record--"], [').otherwise("}"))
    )
    return q.violation_counts(events, [q.Check("props", q.valid_json("props")), q.Check("cut", q.valid_json("cut")), q.Check("twice", q.valid_json("twice"))])


@query(
    "check_uuid",
    """SELECT 'uuid' AS rule, count(*) AS rows, count(*) FILTER (WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')) AS violations FROM customer
       UNION ALL SELECT 'system_or_uuid', count(*), count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') FROM customer""",
)
def check_uuid(spark, sf):
    h = F.md5("c_name")
    made = F.concat_ws("-", *[F.substring(h, F.lit(a), F.lit(n)) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    ids = load(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", "system").when(F.col("c_mktsegment") == "MACHINERY", F.concat(made, F.lit("0"))).otherwise(made).alias("id")
    )
    return q.violation_counts(ids, [q.Check("uuid", q.uuid("id")), q.Check("system_or_uuid", q.system_or_uuid("id"))])


def _options(spark, sf):
    """Orders with optional columns: closed ones have a date, urgent ones a note."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return load(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.when(priority != "5-LOW", F.col("o_orderdate")).alias("closed_on"),
        F.when(priority == "1-URGENT", "rush").when(status == "P", "").alias("note"),
    )


@query("check_required_if", "SELECT o_orderkey, 'closed_on' AS rule FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW' UNION ALL SELECT o_orderkey, 'note' FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT'")
def check_required_if(spark, sf):
    status = F.col("o_orderstatus")
    checks = [q.Check("closed_on", q.required_if(status == "F", "closed_on")), q.Check("note", q.required_if(status == "P", "note"))]
    return q.violations(_options(spark, sf), checks, ["o_orderkey"])


@query(
    "check_one_of",
    """WITH o AS (SELECT o_orderkey, CAST(o_orderpriority <> '5-LOW' AS INTEGER) + CAST(o_orderpriority = '1-URGENT' OR o_orderstatus = 'P' AS INTEGER) AS given FROM orders)
       SELECT o_orderkey, 'exactly_one' AS rule FROM o WHERE given <> 1 UNION ALL SELECT o_orderkey, 'at_least_one' FROM o WHERE given = 0""",
)
def check_one_of(spark, sf):
    checks = [q.Check("exactly_one", q.exactly_one_of("closed_on", "note")), q.Check("at_least_one", q.at_least_one_of("closed_on", "note"))]
    return q.violations(_options(spark, sf), checks, ["o_orderkey"])


# -- request logs ----------------------------------------------------------
REQUEST_SQL = """(SELECT event_id, user_id, ts AS started, ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS ended, event_type,
                         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value FROM events)"""
GROUP_SQL = """CASE WHEN event_type = 'error' AND hour(started) >= 18 THEN 'Evening incidents'
                    WHEN user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'FURNITURE') AND k BETWEEN 20 AND 60 THEN 'Furniture buyers'
                    WHEN event_type = 'click' OR value < 10 THEN 'Light traffic' ELSE 'default' END"""


def _requests(spark, sf):
    """Events as a log: each request runs `value` minutes."""
    events = load(spark, sf, "events")
    ended = from_micros(micros(F.col("ts")) + F.round(F.col("value") * 60_000_000).cast("long"))
    properties = F.to_json(F.struct(
        F.concat(F.lit("web/"), "event_type", F.lit("/v2")).alias("origin"), F.get_json_object("props", "$.k").cast("int").alias("k")
    ))
    return events.select(
        "event_id", "user_id", F.col("ts").alias("started"), ended.alias("ended"), "event_type", "value", properties.alias("request_properties")
    )


def _classified(spark, sf, enabled=True):
    members = load(spark, sf, "customer").select(F.col("c_mktsegment").alias("group_name"), F.col("c_custkey").alias("principal"))
    requests = _requests(spark, sf).withColumn("_p", parse_dynamic(F.col("request_properties")))
    buyers = is_member(requests.select("user_id").distinct(), members, "user_id", "FURNITURE").withColumn("_buyer", F.lit(True))
    requests = requests.join(buyers, "user_id", "left")
    origin, k = member(F.col("_p"), "origin"), member(F.col("_p"), "k", "int")
    rules = [
        (has_term(origin, "error") & (F.hour("started") >= 18), "Evening incidents"),
        (F.col("_buyer") & k.between(20, 60), "Furniture buyers"),
        (has_term(origin, "click") | (F.col("value") < 10), "Light traffic"),
        (F.col("event_type") == "signup", "A group that no longer exists"),
        (F.col("event_type") == "error", ""),
    ]
    names = ("Light traffic", "Evening incidents", "default", "Furniture buyers", "A group without rules")
    known = load(spark, sf, "region").select(F.element_at(F.array(*map(F.lit, names)), F.col("r_regionkey") + 1).alias("group_name"))
    return req.classify(requests, rules, known, enabled=enabled).drop("_p", "_buyer")


@query("classify_requests", f"SELECT event_id, {GROUP_SQL} AS workload_group, 'default' AS when_disabled FROM {REQUEST_SQL}")
def classify_requests(spark, sf):
    off = req.classify(_classified(spark, sf), [], load(spark, sf, "region"), enabled=False, out="when_disabled")
    return off.select("event_id", "workload_group", "when_disabled")


LIMITS = json.dumps([
    {"IsEnabled": True, "Scope": "WorkloadGroup", "LimitKind": "ConcurrentRequests", "Properties": {"MaxConcurrentRequests": 4}},
    {"IsEnabled": True, "Scope": "Principal", "LimitKind": "ConcurrentRequests", "Properties": {"MaxConcurrentRequests": 1}},
])


def _concurrency_sql(scope: str) -> str:
    return f"""sum(step) OVER (PARTITION BY {scope} ORDER BY moment, kind, event_id, own ROWS UNBOUNDED PRECEDING)"""


CONCURRENT_SQL = f"""WITH r AS (SELECT *, {GROUP_SQL} AS workload_group FROM {REQUEST_SQL}),
       line AS (SELECT event_id, user_id, workload_group, epoch_us(started) AS moment, 1 AS kind, 0 AS own, 1 AS step FROM r
                UNION ALL SELECT event_id, user_id, workload_group, epoch_us(ended), CAST(ended <= started AS INTEGER), CAST(ended <= started AS INTEGER), -1 FROM r),
       counted AS (SELECT *, {_concurrency_sql('workload_group')} AS g, {_concurrency_sql('workload_group, user_id')} AS p FROM line)
       SELECT event_id, workload_group, CAST(g AS BIGINT) AS concurrent_in_group, CAST(p AS BIGINT) AS concurrent_for_principal,
              CASE WHEN g > 4 OR p > 1 THEN 'queued' ELSE 'admitted' END AS verdict FROM counted WHERE step = 1"""


def _decided(spark, sf, **more):
    decided = req.decide(
        _classified(spark, sf).select("event_id", "user_id", "workload_group", "started", "ended"),
        req.rate_limits(LIMITS), "event_id", "started", "ended", principal="user_id", queuing=True, **more,
    )
    return decided.select("event_id", "workload_group", "concurrent_in_group", "concurrent_for_principal", "verdict")


@query("concurrent_requests", CONCURRENT_SQL)
def concurrent_requests(spark, sf):
    return _decided(spark, sf)


@query("concurrent_requests_hot_group", CONCURRENT_SQL)
def concurrent_requests_hot_group(spark, sf):
    """The same, with the larger groups spread over blocks of the time line."""
    return _decided(spark, sf, block_rows=1000)


POLICY = {
    "Evening incidents": {"MaxResultRecords": {"IsRelaxable": True, "Value": 75}, "MaxExecutionTime": {"IsRelaxable": False, "Value": "00:45:00"}},
    "Furniture buyers": {"MaxResultBytes": {"IsRelaxable": True, "Value": 1500}, "DataScope": {"IsRelaxable": True, "Value": "HotCache"}},
    "default": {"MaxResultRecords": {"IsRelaxable": True, "Value": 40}},
}


@query(
    "request_limits",
    f"""WITH r AS (SELECT *, {GROUP_SQL} AS g FROM {REQUEST_SQL}),
       f AS (SELECT event_id, g, (g = 'Evening incidents' AND k > 75) OR (g = 'default' AND k > 40) AS over_records, g = 'Furniture buyers' AND ceil(value * 100) > 1500 AS over_bytes,
                    g = 'Evening incidents' AND round(value * 60000000) > 2700000000 AS over_time, g = 'Furniture buyers' AND started < TIMESTAMP '2024-01-28' AS out_of_scope FROM r)
       SELECT event_id, g AS workload_group, over_records, over_bytes, over_time, out_of_scope,
              (over_records OR over_bytes OR out_of_scope) AND NOT over_time AS relaxable FROM f""",
)
def request_limits(spark, sf):
    requests = _classified(spark, sf).select(
        "event_id", "workload_group", F.get_json_object("request_properties", "$.k").cast("long").alias("records"),
        F.ceil(F.col("value") * 100).cast("long").alias("bytes"), F.round(F.col("value") * 60_000_000).cast("long").alias("elapsed_micros"),
        (F.col("started") >= F.lit("2024-01-28").cast("timestamp_ntz")).alias("hot"),
    )
    policies = spark.createDataFrame([(g, json.dumps(p)) for g, p in POLICY.items()], "group_name string, policy string")
    return req.limits_report(requests, policies).drop("records", "bytes", "elapsed_micros", "hot")


@query(
    "split_policy_document",
    """SELECT c_custkey, 'RequestLimitsPolicy' AS policy_name, '{"MaxResultRecords":{"IsRelaxable":true,"Value":' || CAST(c_nationkey AS VARCHAR) || '}}' AS policy FROM customer
       UNION ALL SELECT c_custkey, 'RequestRateLimitPolicies', '[{"Scope":"Principal"},' || CAST(c_custkey AS VARCHAR) || ']' FROM customer
       UNION ALL SELECT c_custkey, 'RequestQueuingPolicy', CASE WHEN c_mktsegment = 'BUILDING' THEN 'null' ELSE '{"IsEnabled":true}' END FROM customer
       UNION ALL SELECT c_custkey, 'QueryConsistencyPolicy', 'null' FROM customer""",
)
def split_policy_document(spark, sf):
    document = F.concat(
        F.lit('{"RequestLimitsPolicy": {"MaxResultRecords": {"IsRelaxable": true, "Value": '), F.col("c_nationkey").cast("string"),
        F.lit('}}, "RequestRateLimitPolicies": [{"Scope": "Principal"}, '), F.col("c_custkey").cast("string"),
        F.lit('], "RequestQueuingPolicy": '), F.when(F.col("c_mktsegment") == "BUILDING", "null").otherwise('{"IsEnabled": true}'),
        F.lit(', "QueryConsistencyPolicy": null}'),
    )
    documents = load(spark, sf, "customer").select("c_custkey", document.alias("document"))
    return req.split_policies(documents, ["c_custkey"], "document")

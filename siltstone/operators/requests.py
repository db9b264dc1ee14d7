"""Request logs: classification into groups, concurrency and limits."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import case, parse_dynamic
from ..functions.types import timespan_micros
from ..session import materialise, small_side
from .drift import lookup
from .lifecycle import micros
from .ordered import BLOCK_ROWS, running_totals

DEFAULT_GROUP = "default"


def classify(requests: DataFrame, rules: Sequence[tuple[Column, str]], groups: DataFrame, *, enabled: bool = True,
             out: str = "workload_group") -> DataFrame:
    """The group of the first rule that holds. Disabled classification, no rule,
    an empty name and a name not in `groups` (group_name) give ``default``."""
    if not enabled:
        return requests.withColumn(out, F.lit(DEFAULT_GROUP))
    chosen = case(*[x for rule in rules for x in rule], DEFAULT_GROUP)
    known = groups.select("group_name", F.col("group_name").alias("_known")).distinct()
    return (
        lookup(requests.withColumn("group_name", chosen), known, "group_name", "_known", DEFAULT_GROUP, out)
        .drop("group_name")
    )


@dataclass(frozen=True)
class RateLimit:
    scope: str  # WorkloadGroup or Principal
    max_concurrent: int
    enabled: bool = True


def rate_limits(policies_json: str) -> list[RateLimit]:
    """The concurrency limits of a policy document."""
    return [
        RateLimit(p["Scope"], int(p["Properties"]["MaxConcurrentRequests"]), bool(p.get("IsEnabled", True)))
        for p in json.loads(policies_json)
        if p.get("LimitKind") == "ConcurrentRequests"
    ]


def _time_line(requests: DataFrame, scope: Sequence[str], request_id: str, start: str, end: str, payload: Column) -> DataFrame:
    """A row for each start (`_step` 1, with the payload) and each end (-1)."""
    at_once = F.col(end) <= F.col(start)
    edges = F.array(
        F.struct(micros(F.col(start)).alias("_at"), F.lit(1).alias("_kind"), F.lit(0).alias("_own"), F.lit(1).alias("_step"), payload.alias("_request")),
        # Ends come before starts of the same time, but a request without
        # duration ends right after its own start. One without an end still runs.
        F.when(F.col(end).isNotNull(), F.struct(
            micros(F.greatest(start, end)).alias("_at"), at_once.cast("int").alias("_kind"), at_once.cast("int").alias("_own"), F.lit(-1).alias("_step"),
            F.when(F.lit(False), payload).alias("_request"),
        )),
    )
    return requests.select(*scope, F.col(request_id).alias("_id"), F.inline(F.array_compact(edges)))


_ORDER = ["_at", "_kind", "_id", "_own"]


def concurrency(requests: DataFrame, scope: Sequence[str], request_id: str, start: str, end: str,
                out: str = "concurrent", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, count): requests of the scope that run when each one starts, itself
    included.

    Every request is a +1 and a -1 on the time line and the count is their
    running total, spread over blocks so that one dominant scope stays parallel.
    A request that ends when another starts no longer runs; one without an end
    still runs. Every request counts as admitted. Ids are unique; scopes and
    starts are not null."""
    line = _time_line(requests, scope, request_id, start, end, F.struct(request_id))
    totals = running_totals(line, scope, _ORDER, {out: F.col("_step")}, block_rows)
    return totals.where("_step = 1").select(F.col("_id").alias(request_id), F.col(out).cast("long"))


def decide(requests: DataFrame, limits: Sequence[RateLimit], request_id: str, start: str, end: str, *,
           group: str = "workload_group", principal: str = "principal", queuing: bool = False,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Concurrency per enabled limit and a verdict: ``admitted``, or ``queued``
    (queuing on) or ``throttled`` where any limit is exceeded.

    All limits count over one time line, which starts carry their requests along:
    rows dealt out by group serve the limit of each principal in it as well, and
    nothing is joined back."""
    scopes = {}
    for limit in limits:
        if limit.enabled:
            whole = limit.scope == "WorkloadGroup"
            name, scope = ("concurrent_in_group", [group]) if whole else ("concurrent_for_principal", [group, principal])
            scopes[name] = scope, min(limit.max_concurrent, scopes[name][1] if name in scopes else limit.max_concurrent)
    line = materialise(_time_line(requests, [group, principal], request_id, start, end, F.struct(*requests.columns)), "time-line")
    totals = line
    for name, (scope, _) in sorted(scopes.items(), key=lambda s: len(s[1][0])):
        totals = running_totals(totals, scope, _ORDER, {name: F.col("_step")}, block_rows, counted=line)
    decided = totals.where("_step = 1").select("_request.*", *[F.col(name).cast("long").alias(name) for name in scopes])
    over = F.lit(False)
    for name, (_, most) in scopes.items():
        over = over | (F.col(name) > most)
    return decided.withColumn("verdict", F.when(over, "queued" if queuing else "throttled").otherwise("admitted"))


def _limit(policy: Column, name: str, member: str, kind: str) -> Column:
    return F.get_json_object(policy, f"$.{name}.{member}").try_cast(kind)


def limits_report(requests: DataFrame, policies: DataFrame, *, group: str = "workload_group") -> DataFrame:
    """Which limits each request breaks.

    `requests` has the group, `records`, `bytes`, `elapsed_micros` and `hot`
    (whether it only read hot rows); `policies` is (group_name, policy JSON).
    A limit that is absent bounds nothing. `relaxable` is true where all
    broken limits may be relaxed."""
    p = F.col("policy")
    limits = policies.select(
        F.col("group_name").alias("_group"),
        _limit(p, "MaxResultRecords", "Value", "long").alias("_records"),
        _limit(p, "MaxResultBytes", "Value", "long").alias("_bytes"),
        timespan_micros(F.get_json_object(p, "$.MaxExecutionTime.Value")).alias("_time"),
        F.get_json_object(p, "$.DataScope.Value").alias("_scope"),
        *[
            F.coalesce(_limit(p, n, "IsRelaxable", "boolean"), F.lit(False)).alias(a)
            for n, a in (("MaxResultRecords", "_r1"), ("MaxResultBytes", "_r2"), ("MaxExecutionTime", "_r3"), ("DataScope", "_r4"))
        ],
    )
    joined = requests.join(small_side(limits), F.col(group) == F.col("_group"), "left")
    broken = {
        "over_records": ("records", F.col("records") > F.col("_records"), "_r1"),
        "over_bytes": ("bytes", F.col("bytes") > F.col("_bytes"), "_r2"),
        "over_time": ("time", F.col("elapsed_micros") > F.col("_time"), "_r3"),
        "out_of_scope": ("scope", (F.col("_scope") == "HotCache") & ~F.col("hot"), "_r4"),
    }
    flags = {name: F.coalesce(c, F.lit(False)) for name, (_, c, _) in broken.items()}
    relaxable = F.lit(True)
    for name, (_, _, may) in broken.items():
        relaxable = relaxable & (~flags[name] | F.col(may))
    any_broken = F.lit(False)
    for flag in flags.values():
        any_broken = any_broken | flag
    return joined.select(*requests.columns, *[f.alias(n) for n, f in flags.items()], (any_broken & relaxable).alias("relaxable"))


def split_policies(documents: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """One row per member of a JSON object: `policy_name` and `policy` as JSON
    text. A member that is null gives the text ``null``; text that is not a JSON
    object gives no rows."""
    parsed = documents.select(*key, parse_dynamic(F.col(column)).alias("_doc")).where(
        "schema_of_variant(_doc) LIKE 'OBJECT%'"
    )
    return parsed.lateralJoin(documents.sparkSession.tvf.variant_explode(F.col("_doc").outer())).select(
        *key, F.col("key").alias("policy_name"), F.to_json("value").alias("policy")
    )

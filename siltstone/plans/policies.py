"""Policies from their JSON documents, as kept in a policy table.

A policy table has one row per entity and policy: (database_name, entity_name,
policy_name, policy), the last being JSON text and a null entity standing for
the whole database. `security.resolve_scope` picks the row that applies.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lifecycle import HashKey, MergePolicy, Partitioning, RangeKey, Retention
from ..operators.requests import DEFAULT_GROUP, classify
from ..operators.security import RowSecurity
from ..operators.segments import BatchingPolicy
from ..functions.types import parse_timespan
from ..streaming.ingest import trigger_bytes
from ..streaming.update_policy import UpdatePolicy


def _document(text: str, *required: str) -> dict:
    document = json.loads(text)
    if not isinstance(document, dict):
        raise ValueError("a policy is a JSON object")
    missing = [name for name in required if document.get(name) is None]
    if missing:
        raise ValueError(f"policy lacks {missing}")
    return document


def retention(text: str) -> Retention:
    policy = _document(text, "SoftDeletePeriod")
    return Retention(policy["SoftDeletePeriod"], policy.get("Recoverability", "Enabled") == "Enabled")


def hot_span(text: str) -> str:
    """The span of a caching policy; either form, ``{"Value": span}`` or the span."""
    span = _document(text, "DataHotSpan")["DataHotSpan"]
    return span["Value"] if isinstance(span, dict) else span


def merging(text: str) -> MergePolicy:
    policy, default = _document(text), MergePolicy()
    lookback = policy.get("Lookback") or {}
    return MergePolicy(
        max_rows=policy.get("RowCountUpperBoundForMerge", default.max_rows),
        max_mb=policy.get("OriginalSizeMBUpperBoundForMerge", default.max_mb),
        max_files=policy.get("MaxExtentsToMerge", default.max_files),
        max_range_hours=policy.get("MaxRangeInHours", default.max_range_hours),
        allow_merge=policy.get("AllowMerge", default.allow_merge),
        allow_rebuild=policy.get("AllowRebuild", default.allow_rebuild),
        lookback=lookback.get("Kind", default.lookback),
        custom_period=lookback.get("CustomPeriod"),
    )


def batching(text: str) -> BatchingPolicy:
    policy = _document(text, "MaximumBatchingTimeSpan", "MaximumNumberOfItems", "MaximumRawDataSizeMB")
    return BatchingPolicy(
        max_items=policy["MaximumNumberOfItems"],
        max_bytes=policy["MaximumRawDataSizeMB"] * 1024 * 1024,
        max_span_micros=parse_timespan(policy["MaximumBatchingTimeSpan"]),
    )


def partitioning(text: str) -> Partitioning:
    policy, keys = _document(text, "PartitionKeys"), []
    for key in policy["PartitionKeys"]:
        column, kind, how = key["ColumnName"], key["Kind"], key.get("Properties") or {}
        if kind == "Hash":
            if how.get("Function") != "XxHash64":
                raise ValueError(f"unknown hash function {how.get('Function')!r}")
            mode = how.get("PartitionAssignmentMode") or "Default"
            keys.append(HashKey(column, how["MaxPartitionCount"], how.get("Seed") or 1, mode))
        elif kind == "UniformRange":
            keys.append(RangeKey(column, how["RangeSize"], how["Reference"], bool(how.get("OverrideCreationTime"))))
        else:
            raise ValueError(f"unknown partition kind {kind!r}")
    return Partitioning(keys, policy.get("EffectiveDateTime") or None)


def update_policies(text: str, target: str) -> list[UpdatePolicy]:
    """An update policy document is a list: a table may have several sources."""
    return [
        UpdatePolicy(
            p["Source"], target, p["Query"], p.get("IsEnabled", True), p.get("IsTransactional", False),
            p.get("PropagateIngestionProperties", False),
        )
        for p in json.loads(text)
    ]


def is_enabled(text: str) -> bool:
    """A policy that is on or off and says no more: ingestion time, restricted access."""
    enabled = _document(text, "IsEnabled")["IsEnabled"]
    if not isinstance(enabled, bool):
        raise ValueError(f"IsEnabled is true or false, not {enabled!r}")
    return enabled


def row_security(text: str) -> RowSecurity:
    """Row-level security; the query is Spark SQL over ``{source}``."""
    return RowSecurity(_document(text, "Query")["Query"], is_enabled(text))


@dataclass(frozen=True)
class StreamingIngestion:
    enabled: bool
    gb_per_hour: float | None = None

    def max_bytes(self, every: str) -> int | None:
        """Bytes that a stream triggered so often may take each time; None without a rate."""
        return None if self.gb_per_hour is None else trigger_bytes(self.gb_per_hour, every)


def streaming_ingestion(text: str) -> StreamingIngestion:
    rate = _document(text).get("HintAllocatedRate")
    if rate is not None and not float(rate) > 0:
        raise ValueError(f"the rate is positive, not {rate!r}")
    return StreamingIngestion(is_enabled(text), None if rate is None else float(rate))


@dataclass(frozen=True)
class Classification:
    """`function` is a Spark SQL expression over a request that gives the name of its group."""

    enabled: bool
    function: str | None = None

    def apply(self, requests: DataFrame, groups: DataFrame, out: str = "workload_group") -> DataFrame:
        rules = [(F.lit(True), F.coalesce(F.expr(self.function), F.lit(DEFAULT_GROUP)))] if self.function else [(F.lit(False), DEFAULT_GROUP)]
        return classify(requests, rules, groups, enabled=self.enabled, out=out)


def classification(text: str) -> Classification:
    return Classification(is_enabled(text), _document(text).get("ClassificationFunction"))

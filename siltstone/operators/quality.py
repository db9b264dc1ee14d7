"""Data-quality checks on columns: violating rows and counts per rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import is_json, is_uuid


@dataclass(frozen=True)
class Check:
    """A named condition that holds for good rows; unknown counts as a violation."""

    name: str
    holds: Column


def length_between(c: str, low: int, high: int) -> Column:
    """Length in bytes, both ends included."""
    return F.octet_length(c).between(low, high)


def in_set(c: str, values: Sequence[str], ignore_case: bool = False) -> Column:
    if ignore_case:
        return F.lower(c).isin([v.lower() for v in values])
    return F.col(c).isin(list(values))


def not_empty(c: str) -> Column:
    return F.length(c) > 0


def matches(c: str, pattern: str) -> Column:
    return F.col(c).rlike(pattern)


def valid_json(c: str) -> Column:
    return is_json(F.col(c))


def uuid(c: str) -> Column:
    return is_uuid(F.col(c))


def system_or_uuid(c: str) -> Column:
    return (F.col(c) == "system") | is_uuid(F.col(c))


def required_if(condition: Column, c: str) -> Column:
    """Where the condition holds, the column must be given and not empty."""
    return ~F.coalesce(condition, F.lit(False)) | F.coalesce(F.col(c).cast("string") != "", F.lit(False))


def _given(columns: Sequence[str]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNotNull().cast("int")
    return total


def exactly_one_of(*columns: str) -> Column:
    return _given(columns) == 1


def at_least_one_of(*columns: str) -> Column:
    return _given(columns) >= 1


def _broken(check: Check) -> Column:
    return ~F.coalesce(check.holds, F.lit(False))


def violations(df: DataFrame, checks: Sequence[Check], keep: Sequence[str]) -> DataFrame:
    """One row per row and broken rule, in a single pass over the data."""
    broken = F.array_compact(F.array(*[F.when(_broken(c), F.lit(c.name)) for c in checks]))
    return df.select(*keep, F.explode(broken).alias("rule"))


def violation_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows and violations per rule; rules without violations are listed too."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(_broken(c)).alias(f"r{i}") for i, c in enumerate(checks)])
    pairs = F.array(*[F.struct(F.lit(c.name).alias("rule"), F.col(f"r{i}").alias("violations")) for i, c in enumerate(checks)])
    return counts.select("rows", F.inline(pairs)).select("rule", "rows", "violations")

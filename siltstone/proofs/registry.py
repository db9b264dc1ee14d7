"""The registered queries and, where SQL can say the same, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(run: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = wraps(run)(lambda spark, folder: run(configure(spark), folder))
        if sql is not None:
            SQL[name] = sql
        return run

    return keep


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def ranges(column: str, bounds: Sequence) -> list[Column]:
    """Conditions that split a whole table at `bounds`; the first and last are open, and the first takes the nulls."""
    at = F.col(column)
    parts = [(at >= low) & (at < high) for low, high in zip(bounds, bounds[1:])]
    return [(at < bounds[0]) | at.isNull(), *parts, at >= bounds[-1]]


def each(column: str, values: Sequence[str]) -> list[Column]:
    """Conditions that split a whole table by the listed values; the last takes all others and the nulls."""
    others = ~F.coalesce(F.col(column).isin(*values), F.lit(False))
    return [*(F.col(column) == v for v in values), others]


def spread(df: DataFrame) -> int:
    """How many files a query splits its input into: six, or one per million rows."""
    return max(6, df.count() // 1_000_000)

"""Desired against actual: which rows were added, removed or changed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small_side

Same = Callable[[Column, Column], Column]


def exact(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def diff(desired: DataFrame, actual: DataFrame, key: Sequence[str], compare: Mapping[str, Same] | None = None) -> DataFrame:
    """Key, `change` (added, removed, changed, unchanged) and the names of the
    changed columns. `key` is unique on both sides; `compare` names the test per
    column, null-safe equality of all shared columns by default."""
    if compare is None:
        compare = {c: exact for c in desired.columns if c in actual.columns and c not in key}
    d = desired.select(*key, *[F.col(c).alias(f"_d_{c}") for c in compare], F.lit(True).alias("_in_d"))
    a = actual.select(*key, *[F.col(c).alias(f"_a_{c}") for c in compare], F.lit(True).alias("_in_a"))
    both = d.join(a, list(key), "full_outer")
    changed = F.concat_ws(
        ",", *[F.when(~same(F.col(f"_d_{c}"), F.col(f"_a_{c}")), F.lit(c)) for c, same in compare.items()]
    )
    change = (
        F.when(F.col("_in_a").isNull(), "added")
        .when(F.col("_in_d").isNull(), "removed")
        .when(changed != "", "changed")
        .otherwise("unchanged")
    )
    return both.select(
        *key, change.alias("change"),
        F.when(F.col("_in_a") & F.col("_in_d"), changed).otherwise("").alias("changed_columns"),
    )


def schema_diff(desired, actual) -> list[tuple[str, str]]:
    """(column, change) for two StructTypes, names compared unquoted."""
    want = {f.name: f.dataType for f in desired.fields}
    have = {f.name: f.dataType for f in actual.fields}
    found = [(n, "added") for n in want if n not in have] + [(n, "removed") for n in have if n not in want]
    return found + [(n, "changed") for n in want if n in have and want[n] != have[n]]


def existing(dependents: DataFrame, entities: DataFrame, on: Sequence[str]) -> DataFrame:
    """Dependents whose entity exists."""
    return dependents.join(entities.select(*on), list(on), "left_semi")


def missing(dependents: DataFrame, entities: DataFrame, on: Sequence[str]) -> DataFrame:
    return dependents.join(entities.select(*on), list(on), "left_anti")


def lookup(df: DataFrame, names: DataFrame, on: str, value: str, default: str, out: str) -> DataFrame:
    """Value from `names`, unique by `on`; unknown, empty and null keys get the default."""
    table = names.select(F.col(on).alias("_key"), F.col(value).alias("_value"))
    return (
        df.join(small_side(table), F.col(on) == F.col("_key"), "left")  # a hot key is not shuffled as long as the names are few
        .withColumn(out, F.coalesce("_value", F.lit(default)))
        .drop("_key", "_value")
    )

"""Stored functions: named, parameterised queries used like tables.

A query is Spark SQL text, the name of a stored function, or a callable that
takes DataFrames and gives a DataFrame. Spark does all parsing and planning.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from ..functions.types import parse_schema

Query = str | Callable[..., DataFrame]


@dataclass(frozen=True)
class StoredFunction:
    name: str
    body: Query
    parameters: T.StructType


class Functions:
    """Registry of stored functions over a set of tables."""

    def __init__(self, spark: SparkSession, **tables: DataFrame):
        self.spark = spark
        self.tables = dict(tables)
        self._functions: dict[str, StoredFunction] = {}

    def register(self, name: str, body: Query, parameters: str = "()", *, skip_validation: bool = False,
                 expose: bool = False) -> "Functions":
        """`body` reads tables and earlier functions as ``{name}`` (SQL) or by
        argument name (callable) and parameters as ``:name`` or by argument name.
        Other braces in such SQL are doubled, as Spark asks for.
        Unless skipped, it is analysed now, with nulls for parameters of no
        known value. `expose` also makes a parameterless function a temp view."""
        function = StoredFunction(name, body, parse_schema(parameters))
        if not skip_validation:
            self._run(function, {f.name: _sample(f.dataType) for f in function.parameters.fields}).schema
        self._functions[name] = function
        if expose:
            self.call(name).createOrReplaceTempView(name)
        return self

    def call(self, name: str, **arguments) -> DataFrame:
        return self._run(self._functions[name], arguments)

    def resolve(self, query: Query, **inputs: DataFrame) -> DataFrame:
        """A registered name first, then SQL text or a callable."""
        if isinstance(query, str) and query in self._functions:
            return self._run(self._functions[query], {}, inputs)
        return self._run(StoredFunction("", query, T.StructType([])), {}, inputs)

    def _run(self, function: StoredFunction, arguments: dict, inputs: dict | None = None) -> DataFrame:
        wanted = set(function.parameters.fieldNames())
        if wanted != set(arguments):
            raise TypeError(f"{function.name} takes {sorted(wanted)}, got {sorted(arguments)}")
        sources = {**self.tables, **(inputs or {})}
        if callable(function.body):
            named = inspect.signature(function.body).parameters
            given = {**{k: v for k, v in sources.items() if k in named}, **arguments}
            given.update({n: self.call(n) for n in self._functions if n in named and n not in given})
            return function.body(**given)
        used = {n: df for n, df in sources.items() if "{" + n + "}" in function.body}
        used.update(
            {n: self.call(n) for n in self._functions if "{" + n + "}" in function.body and n not in used}
        )
        return self.spark.sql(function.body, args=arguments or None, **used)


def _sample(t: T.DataType):
    """A value to analyse a function with before it has been called."""
    return 1 if isinstance(t, (T.IntegerType, T.LongType)) else None


def run_query(spark: SparkSession, query: Query, functions: Functions | None = None, **inputs: DataFrame) -> DataFrame:
    return (functions or Functions(spark)).resolve(query, **inputs)

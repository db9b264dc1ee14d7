"""Ingestion mappings: which part of a raw record becomes which typed column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, types as T
from pyspark.sql import functions as F

from ..functions.scalars import parse_dynamic
from ..functions.types import spark_type
from ..session import materialise, small_side
from .tables import CSV_OPTIONS

# The accepted kinds of mapping.
KINDS = ("json", "csv", "parquet", "avro", "orc", "w3clogfile", "apacheavro")


@dataclass(frozen=True)
class Rule:
    """One target column. The value comes from `constvalue`, `path`, `field` or
    `ordinal`; `transform` is a Spark SQL expression over the extracted text
    `value`; `datatype` defaults to the type of the target column."""

    column: str
    path: str | None = None
    field: str | None = None
    ordinal: int | None = None
    constvalue: str | None = None
    datatype: str | None = None
    transform: str | None = None


@dataclass(frozen=True)
class Mapping:
    kind: str
    rules: Sequence[Rule]

    def __post_init__(self):
        if self.kind.lower() not in KINDS:
            raise ValueError(f"unknown mapping kind: {self.kind!r}")

    @property
    def format(self) -> str:
        kind = self.kind.lower()
        return "avro" if kind == "apacheavro" else kind


def _json_path(rule: Rule) -> str:
    path = rule.path or f"$.{rule.field}"
    return path if path.startswith("$") else f"$.{path}"


def _nested_column(path: str) -> Column:
    parts = path.removeprefix("$").strip(".").split(".")
    column = F.col(f"`{parts[0]}`")
    for part in parts[1:]:
        column = column.getField(part)
    return column


def _target_type(rule: Rule, target: T.StructType) -> T.DataType:
    if rule.datatype:
        return spark_type(rule.datatype)
    if rule.column in target.fieldNames():
        return target[rule.column].dataType
    return T.StringType()


def _project(
    raw: DataFrame, mapping: Mapping, target: T.StructType, extract, count_bad: bool, bad: Column | None = None
) -> DataFrame:
    """One select for the whole mapping. A value that does not fit its type
    becomes null; with `count_bad`, `_bad` says how many did not fit."""
    rules = {r.column: r for r in mapping.rules}
    unknown = set(rules) - set(target.fieldNames())
    if unknown:
        raise ValueError(f"mapping names columns the table does not have: {sorted(unknown)}")
    columns, bad = [], F.lit(0) if bad is None else bad
    for name in target.fieldNames():
        rule = rules.get(name)
        if rule is None:
            columns.append(F.lit(None).cast(target[name].dataType).alias(name))
            continue
        kind = _target_type(rule, target)
        if rule.constvalue is not None:
            value = F.lit(rule.constvalue)
        elif rule.path is None and rule.field is None and rule.ordinal is None:
            value = F.lit(None).cast("string")  # a rule without a source
        else:
            value = extract(rule)
        if rule.transform:
            # Inside the lambda `value` is the extracted value, whatever the
            # columns of the source are called.
            raw = raw.withColumn(f"_value_{name}", value)
            value = F.expr(f"transform(array(`_value_{name}`), value -> {rule.transform})[0]")
        typed = value.try_cast(kind)
        columns.append(typed.try_cast(target[name].dataType).alias(name))
        bad = bad + (value.isNotNull() & typed.isNull()).cast("int")
    return raw.select(*columns, bad.alias("_bad")) if count_bad else raw.select(*columns)


def map_json(lines: DataFrame, mapping: Mapping, target: T.StructType, count_bad: bool = False) -> DataFrame:
    """`lines` has one JSON record per row in `value`; it is parsed once per row.
    A broken record gives nulls."""
    raw = lines.withColumn("_record", parse_dynamic(F.col("value")))

    def extract(rule: Rule) -> Column:
        if (rule.datatype or "").lower() == "dynamic":
            return F.to_json(F.try_variant_get("_record", _json_path(rule), "variant"))
        return F.try_variant_get("_record", _json_path(rule), "string")

    return _project(raw, mapping, target, extract, count_bad)


def map_positional(rows: DataFrame, mapping: Mapping, target: T.StructType, ordinal_base: int = 0,
                   count_bad: bool = False) -> DataFrame:
    """`rows` has text columns named ``_c0``, ``_c1``, ... in file order."""

    def extract(rule: Rule) -> Column:
        if rule.ordinal is None:
            raise ValueError(f"column {rule.column!r} needs an ordinal")
        name = f"_c{int(rule.ordinal) - ordinal_base}"
        return F.col(name) if name in rows.columns else F.lit(None).cast("string")

    return _project(rows, mapping, target, extract, count_bad)


def map_columns(df: DataFrame, mapping: Mapping, target: T.StructType, count_bad: bool = False) -> DataFrame:
    """Parquet, ORC and Avro: by `path` or `field`, pruned down to the scan."""
    return _project(df, mapping, target, lambda r: _nested_column(r.path or r.field), count_bad)


def map_w3c(lines: DataFrame, mapping: Mapping, target: T.StructType, count_bad: bool = False) -> DataFrame:
    """`lines` has `value` and `path`, in the order of the file, and for a file read
    in several blocks where each begins, `block`. A ``#Fields:`` line names the
    fields of the records after it, up to the next one; ``-`` means no value. A
    record with no such line before it keeps its row: no fields, and one bad value.

    Only header lines are gathered, those that change something: each record looks
    at the ones of its own block, and else at the last one of an earlier block.
    """
    begins = F.col("block").cast("long") if "block" in lines.columns else F.lit(0).cast("long")
    numbered = lines.select("value", "path", begins.alias("_block"), F.monotonically_increasing_id().alias("_line"))
    named = F.split(F.trim(F.substring_index("value", "#Fields:", -1)), r"\s+")
    headers = numbered.where(F.startswith("value", F.lit("#Fields:"))).select("path", "_block", "_line", named.alias("_fields"))
    before = F.lag("_fields").over(Window.partitionBy("path", "_block").orderBy("_line"))
    headers = materialise(headers.withColumn("_before", before).where(~F.col("_fields").eqNullSafe(F.col("_before"))).drop("_before"), "headers")
    own = headers.groupBy("path", "_block").agg(F.sort_array(F.collect_list(F.struct("_line", "_fields"))).alias("_own"))
    last = headers.groupBy("path", "_block").agg(F.max_by("_fields", "_line").alias("_fields"))
    earlier = last.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("_block", "_fields"))).alias("_earlier"))

    records = numbered.where(~F.startswith("value", F.lit("#")) & (F.trim("value") != ""))
    raw = records.join(small_side(own), ["path", "_block"], "left").join(small_side(earlier), "path", "left")
    here = F.try_element_at(F.filter("_own", lambda h: h["_line"] < F.col("_line")), F.lit(-1))["_fields"]
    carried = F.try_element_at(F.filter("_earlier", lambda h: h["_block"] < F.col("_block")), F.lit(-1))["_fields"]
    raw = raw.select(F.split("value", r"\s+").alias("_parts"), F.coalesce(here, carried).alias("_fields"))

    def extract(rule: Rule) -> Column:
        at = F.array_position("_fields", F.lit(rule.field or rule.path))
        text = F.try_element_at("_parts", F.nullif(at, F.lit(0)).cast("int"))
        return F.when(text != "-", text)

    return _project(raw, mapping, target, extract, count_bad, F.col("_fields").isNull().cast("int"))


def read_mapped(
    spark: SparkSession,
    paths: str | Sequence[str],
    mapping: Mapping,
    target: T.StructType,
    *,
    ordinal_base: int = 0,
    count_bad: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read raw files of the mapping's kind as rows of the target table."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    options = options or {}
    kind = mapping.format
    if kind == "json":
        return map_json(spark.read.options(**options).text(paths), mapping, target, count_bad)
    if kind == "csv":
        used = [int(r.ordinal) - ordinal_base for r in mapping.rules if r.ordinal is not None]
        width = max(used, default=0) + 1
        schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
        rows = spark.read.options(**{**CSV_OPTIONS, **options}).schema(schema).csv(paths)
        return map_positional(rows, mapping, target, ordinal_base, count_bad)
    if kind == "w3clogfile":
        lines = spark.read.options(**options).text(paths).select(
            "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
        )
        return map_w3c(lines, mapping, target, count_bad)
    return map_columns(spark.read.options(**options).format(kind).load(paths), mapping, target, count_bad)

"""Schema evolution: exact alter, additive merge, and what is refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F


def _by_name(schema: T.StructType) -> dict[str, T.StructField]:
    return {f.name: f for f in schema.fields}


def _fits(have: T.DataType, wanted: T.DataType) -> bool:
    """The same type; of structs, the same types of the members both have."""
    if isinstance(have, T.StructType) and isinstance(wanted, T.StructType):
        known = _by_name(have)
        return all(_fits(known[f.name].dataType, f.dataType) for f in wanted.fields if f.name in known)
    return have.simpleString() == wanted.simpleString()


def refuse_type_change(current: T.StructType, wanted: T.StructType) -> None:
    have = _by_name(current)
    changed = [
        f"{f.name}: {have[f.name].dataType.simpleString()} -> {f.dataType.simpleString()}"
        for f in wanted.fields
        if f.name in have and not _fits(have[f.name].dataType, f.dataType)
    ]
    if changed:
        raise ValueError("a column's type cannot be altered: " + ", ".join(changed))


def refuse_extra_columns(current: T.StructType, wanted: T.StructType) -> None:
    extra = [n for n in wanted.fieldNames() if n not in current.fieldNames()]
    if extra:
        raise ValueError(f"columns not in the table (extend the schema to add them): {extra}")


def merged(current: T.StructType, wanted: T.StructType) -> T.StructType:
    """All current columns, then the new ones. Nothing is removed."""
    refuse_type_change(current, wanted)
    have, new = _by_name(current), _by_name(wanted)

    def joined(f: T.StructField) -> T.StructField:
        if isinstance(f.dataType, T.StructType) and f.name in new:
            return T.StructField(f.name, merged(f.dataType, new[f.name].dataType))
        return T.StructField(f.name, f.dataType)

    added = [T.StructField(f.name, f.dataType) for f in wanted.fields if f.name not in have]
    return T.StructType([joined(f) for f in current.fields] + added)


def _conformed(value: Column, have: T.DataType, wanted: T.DataType) -> Column:
    if not isinstance(wanted, T.StructType) or have.simpleString() == wanted.simpleString():
        return value
    known = _by_name(have)
    members = [
        (_conformed(value[f.name], known[f.name].dataType, f.dataType) if f.name in known
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in wanted.fields
    ]
    return F.when(value.isNotNull(), F.struct(*members))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of `schema`, in order; missing ones are null."""
    refuse_type_change(df.schema, schema)
    have = _by_name(df.schema)
    return df.select(
        *[
            (_conformed(F.col(f"`{f.name}`"), have[f.name].dataType, f.dataType) if f.name in have
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def alter_exact(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The listed columns and no others: unlisted ones are dropped with their data."""
    return conform(df, schema)


def alter_merge(df: DataFrame, schema: T.StructType) -> DataFrame:
    return conform(df, merged(df.schema, schema))


def union_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both under the merged schema."""
    target = merged(old.schema, new.schema)
    return conform(old, target).unionByName(conform(new, target))


def clone_empty(df: DataFrame) -> DataFrame:
    return df.limit(0)

"""Schema text and timespan literals."""

from __future__ import annotations

import re

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

# Type names of the schema text and the Spark type of each.
# `dynamic` is JSON text at rest; a timespan is a count of microseconds.
SPARK_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "real": T.DoubleType(),
    "double": T.DoubleType(),
    "decimal": T.DecimalType(38, 18),
    "bool": T.BooleanType(),
    "datetime": T.TimestampNTZType(),
    "dynamic": T.StringType(),
    "guid": T.StringType(),
    "timespan": T.LongType(),
}
_NAMES = {
    T.StringType(): "string",
    T.IntegerType(): "int",
    T.LongType(): "long",
    T.DoubleType(): "real",
    T.BooleanType(): "bool",
    T.TimestampNTZType(): "datetime",
    T.TimestampType(): "datetime",
}

# Microseconds per timespan unit.
UNIT_MICROS = {"d": 86_400_000_000, "h": 3_600_000_000, "m": 60_000_000, "s": 1_000_000}

_UNIT_FORM = r"^(\d+)([dhms])$"
_CLOCK_FORM = r"^(?:(\d+)\.)?([01]?\d|2[0-3]):([0-5]\d)(?::([0-5]\d))?$"


def spark_type(name: str) -> T.DataType:
    try:
        return SPARK_TYPES[name.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown column type: {name!r}") from None


def unquoted(name: str) -> str:
    found = re.match(r"^\['(.+)'\]$", name.strip())
    return found.group(1) if found else name.strip()


def parse_schema(text: str) -> T.StructType:
    """``"f1:string, ['version']:int"`` as a StructType, in the given order."""
    text = text.strip().removeprefix("(").removesuffix(")")
    fields = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        name, colon, kind = part.rpartition(":")
        if not colon or not name.strip():
            raise ValueError(f"expected name:type, got {part!r}")
        fields.append(T.StructField(unquoted(name), spark_type(kind)))
    seen = [f.name.lower() for f in fields]
    if len(set(seen)) != len(seen):
        raise ValueError(f"duplicate column in schema: {text!r}")
    return T.StructType(fields)


def schema_text(schema: T.StructType) -> str:
    def name_of(t: T.DataType) -> str:
        return "decimal" if isinstance(t, T.DecimalType) else _NAMES.get(t, "dynamic")

    return ",".join(f"{f.name}:{name_of(f.dataType)}" for f in schema.fields)


def parse_timespan(text: str) -> int:
    """``30d``, ``00:10:00``, ``2.00:00:00`` or ``14.00:00`` in microseconds."""
    if found := re.match(_UNIT_FORM, text.strip()):
        return int(found.group(1)) * UNIT_MICROS[found.group(2)]
    if found := re.match(_CLOCK_FORM, text.strip()):
        d, h, m, s = (int(g or 0) for g in found.groups())
        return d * UNIT_MICROS["d"] + h * UNIT_MICROS["h"] + m * UNIT_MICROS["m"] + s * UNIT_MICROS["s"]
    raise ValueError(f"not a timespan: {text!r}")


def timespan_micros(text: Column) -> Column:
    """Column form of :func:`parse_timespan`; null where the text is no timespan.
    Each form is matched once; its parts are then cut out without patterns."""
    text = F.trim(text)
    unit = F.right(text, F.lit(1))
    per_unit = F.lit(None).cast("bigint")
    for name, micros in UNIT_MICROS.items():
        per_unit = F.when(unit == name, F.lit(micros)).otherwise(per_unit)
    count = F.left(text, F.length(text) - 1).try_cast("bigint")

    days = F.when(F.contains(text, F.lit(".")), F.substring_index(text, ".", 1)).otherwise("0")
    parts = F.split(F.substring_index(text, ".", -1), ":")
    pieces = {"d": days, "h": F.get(parts, F.lit(0)), "m": F.get(parts, F.lit(1)),
              "s": F.coalesce(F.get(parts, F.lit(2)), F.lit("0"))}
    clock = F.lit(0).cast("bigint")
    for name, piece in pieces.items():
        clock = clock + piece.try_cast("bigint") * F.lit(UNIT_MICROS[name])
    return F.when(text.rlike(_UNIT_FORM), count * per_unit).when(text.rlike(_CLOCK_FORM), clock)


def in_units(micros: Column, unit: str) -> Column:
    """Whole units, as text: 36 h in days is ``1d``."""
    whole = (micros - micros % F.lit(UNIT_MICROS[unit])) / F.lit(UNIT_MICROS[unit])
    return F.concat(whole.cast("bigint").cast("string"), F.lit(unit))


def to_timespan_literal(text: Column, unit: str) -> Column:
    return in_units(timespan_micros(text), unit)

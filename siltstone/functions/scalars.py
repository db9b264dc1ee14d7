"""Scalar functions of stored queries, all JVM-side expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small_side


def to_string(c: Column) -> Column:
    return c.cast("string")


def to_lower(c: Column) -> Column:
    return F.lower(c.cast("string"))


def to_int(c: Column) -> Column:
    """Truncates towards zero; null where the value is no number or too big."""
    return c.try_cast("double").try_cast("int")


def iff(condition: Column, then: Column, otherwise: Column) -> Column:
    return F.when(condition, then).otherwise(otherwise)


def case(*pairs_and_default) -> Column:
    """``case(c1, v1, c2, v2, ..., default)``: first true condition wins."""
    *pairs, default = pairs_and_default
    if not pairs or len(pairs) % 2:
        raise ValueError("case needs condition/value pairs and a default")
    result = None
    for condition, value in zip(pairs[::2], pairs[1::2]):
        value = value if isinstance(value, Column) else F.lit(value)
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return result.otherwise(default if isinstance(default, Column) else F.lit(default))


def has_term(text: Column, term: str) -> Column:
    """Whole-term match, ignoring case. A boundary is asked for only where the
    term itself begins or ends with a letter or digit."""
    if not term:
        raise ValueError("empty term")
    before = r"(?<![\p{L}\p{N}])" if term[0].isalnum() else ""
    after = r"(?![\p{L}\p{N}])" if term[-1].isalnum() else ""
    return text.rlike(f"(?iu){before}{re.escape(term)}{after}")


# Spark's parser stops after the first value of a text. So a text is parsed once,
# as the first element of an array that goes on with END: text that closes the
# array early, or holds several values, does not leave END as the second and last.
END = "end of the text 5c1e7a"


def _enclosed(text: Column) -> Column:
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{END}"]')))


def _one(enclosed: Column) -> Column:
    is_end = F.try_variant_get(enclosed, "$[1]", "string") == END
    return F.coalesce(is_end, F.lit(False)) & F.try_variant_get(enclosed, "$[2]", "variant").isNull()


def _one_around_end(text: Column) -> Column:
    """The same for text that holds END: it must parse both in an array and in an object; whatever closes the one early breaks the other."""
    alone, named = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.try_variant_get(alone, "$[0]", "variant").isNotNull() & F.try_variant_get(alone, "$[1]", "variant").isNull() & named.isNotNull()


# The condition that comes first is the one that parses, so what follows can share its value.
def is_json(text: Column) -> Column:
    """Exactly one JSON value. Null text is none, as is one nested more than 999 deep."""
    return F.coalesce((_one(_enclosed(text)) & ~F.contains(text, F.lit(END))) | (F.contains(text, F.lit(END)) & _one_around_end(text)), F.lit(False))


def parse_dynamic(text: Column) -> Column:
    """JSON text as VARIANT; null where it is not exactly one JSON value.

    Of a key that occurs twice the last value counts if the session is set up by
    `session.configure`; without that, such text is null.
    """
    enclosed, alone = _enclosed(text), F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    holds_end = F.contains(text, F.lit(END))
    return (
        F.when(_one(enclosed) & ~holds_end, F.try_variant_get(enclosed, "$[0]", "variant"))
        .when(holds_end & _one_around_end(text), F.try_variant_get(alone, "$[0]", "variant"))
    )


def member(dynamic: Column, path: str, data_type: str = "string") -> Column:
    """``member(v, "a.b", "int")`` reads ``$.a.b``; null where absent or of another kind."""
    path = path if path.startswith("$") else f"$.{path}"
    return F.try_variant_get(dynamic, path, data_type)


def quote_name(name: Column) -> Column:
    """Quote only a name that has a hyphen and does not start with a bracket."""
    needs = F.contains(name, F.lit("-")) & ~F.startswith(name, F.lit("["))
    return F.when(needs, F.concat(F.lit("['"), name, F.lit("']"))).otherwise(name)


def unquote_name(name: Column) -> Column:
    inner = F.regexp_extract(name, r"^\['(.+)'\]$", 1)
    return F.when(inner != "", inner).otherwise(name)


def unquote_schema(schema: Column) -> Column:
    """Unquote every name inside a whole schema text."""
    return F.regexp_replace(schema, r"\['([^']*)'\]", "$1")


def fingerprint(*columns: Column) -> Column:
    """MD5 over several fields. A separator and a null mark keep ("a", "bc"),
    ("ab", "c") and (null, "abc") apart."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns]))


_UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def is_uuid(text: Column) -> Column:
    return text.rlike(_UUID)


def with_friendly_name(df: DataFrame, column: str, names: DataFrame, out: str) -> DataFrame:
    """Replace a UUID by its name from `names` (id, name); other values, unknown
    ids and empty names stay as they are. `names` must be unique by id."""
    known = names.select(F.lower("id").alias("_id"), F.col("name").alias("_name")).where("_name <> ''")
    key = F.when(is_uuid(F.col(column)), F.lower(column))
    return (
        df.withColumn("_key", key)
        .join(small_side(known), F.col("_key") == F.col("_id"), "left")
        .withColumn(out, F.coalesce("_name", F.col(column)))
        .drop("_key", "_id", "_name")
    )

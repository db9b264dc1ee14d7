"""When do two recorded values mean the same thing? One expression per kind."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .scalars import parse_dynamic, unquote_schema
from .types import to_timespan_literal


def _free(df: DataFrame, name: str) -> str:
    """`name`, or one like it that `df` has not."""
    while name in df.columns:
        name = f"_{name}"
    return name


def same_name(a: Column, b: Column) -> Column:
    """Equal once ``['x']`` is read as ``x``."""
    return unquote_schema(a).eqNullSafe(unquote_schema(b))


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\r\n\f\x0B]+", " "))


def same_text(a: Column, b: Column) -> Column:
    return collapse_space(a).eqNullSafe(collapse_space(b))


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """`f(value)`, with the value worked out once however often `f` asks for it."""
    return F.element_at(F.transform(F.array(value), f), 1)


_TOKEN = r'"[^"]*+":?+|[^"0-9-]++|-?[0-9][0-9.eE+-]*+'


def _tokens(plain: Column) -> Column:
    """The tokens of JSON text, each number written as the double it is: 100, 100.0 and 1e2 are one.

    Escaped quotes and backslashes are set aside, so a quote is always the end of
    a text, and every token is a run that the pattern takes without backtracking.
    """
    aside = F.replace(F.replace(plain, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    tokens = F.regexp_extract_all(aside, F.lit(_TOKEN), F.lit(0))
    return F.transform(tokens, lambda t: F.when(t.rlike("^-?[0-9]"), (t.cast("double") + 0.0).cast("string")).otherwise(t))


def _by_value(plain: Column) -> Column:
    return F.array_join(_tokens(plain), "")


def _count(text: Column, part: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))


def _in_range(plain: Column, text: Column) -> Column:
    """A number beyond a double becomes infinite, which is written like a text that says so."""
    return ~F.contains(plain, F.lit('Infinity"')) | (_count(plain, 'Infinity"') <= _count(text, 'Infinity"'))


def _suspect(text: Column) -> Column:
    """Whether a number may be beyond a double: it is long or has an exponent of three digits."""
    return text.rlike(r"[0-9]{300}|[0-9.][eE]\+?0*[0-9]{3}")


def same_json(a: Column, b: Column) -> Column:
    """Equal as JSON values, numbers by value; text that is not JSON compares as it is, and null equals null.

    Values are written with their members in the order of their names, so equal
    ones are equal texts. Numbers beyond a double are not JSON.
    """

    def compare(both: Column) -> Column:
        x, y = both["x"], both["y"]
        neither = x.isNull() & y.isNull() & a.eqNullSafe(b)
        return F.when(x == y, F.lit(True)).when(x.isNull() | y.isNull(), neither).otherwise(_by_value(x) == _by_value(y))

    def plain(text: Column) -> Column:
        return _let(F.to_json(parse_dynamic(text)), lambda p: F.when(_in_range(p, text), p))

    return _let(F.struct(plain(a).alias("x"), plain(b).alias("y")), compare)


# Fixed value: the text of a decimal number.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"


def same_number(a: Column, b: Column) -> Column:
    """Equal as numbers; anything else than the bare text of a number is unequal."""
    x, y = (F.when(c.rlike(_NUMBER), c.try_cast("double")) for c in (a, b))
    return F.coalesce((x == y) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))


def same_principal_kind(a: Column, b: Column) -> Column:
    """Equal ignoring case, or the same kind before ``=``; empty only equals empty."""
    a, b = F.coalesce(F.lower(a), F.lit("")), F.coalesce(F.lower(b), F.lit(""))
    both_typed = F.contains(a, F.lit("=")) & F.contains(b, F.lit("="))
    same_kind = both_typed & (F.substring_index(a, "=", 1) == F.substring_index(b, "=", 1))
    return F.when((a == "") | (b == ""), a == b).otherwise((a == b) | same_kind)


def same_timespan(a: Column, b: Column, unit: str) -> Column:
    """Equal when counted in whole units, so ``36h`` and ``1d`` agree in days."""
    return to_timespan_literal(a, unit).eqNullSafe(to_timespan_literal(b, unit))


def same_kind(a: Column, b: Column) -> Column:
    return F.lower(a).eqNullSafe(F.lower(b))


#: Levels of nesting that one pass goes down.
LEVELS = 8
_PAIRS = "array<struct<x: variant, y: variant>>"
_REFUTATION = "array(named_struct('x', CAST(NULL AS VARIANT), 'y', CAST(NULL AS VARIANT)))"


def _refutation() -> Column:
    return F.expr(_REFUTATION)


def _descend(pairs: str) -> str:
    """SQL text: one level down from the open pairs, those whose containment is still open.

    A pair without y is refuted and stays one. Objects give their members by name;
    a pair of anything else is equal, and left out, or refuted. As text, since
    levels are nested: a tree of columns would be built call by call.
    """

    def by_value(t: str) -> str:
        aside = f"replace(replace({t}, r'\\\\', char(1)), r'\\\"', char(2))"
        number = "CASE WHEN t RLIKE '^-?[0-9]' THEN CAST(CAST(t AS DOUBLE) + 0.0D AS STRING) ELSE t END"
        return f"array_join(transform(regexp_extract_all({aside}, r'{_TOKEN}', 0), t -> {number}), '')"

    texts = "array(named_struct('x', to_json(p.x), 'y', to_json(p.y)))"
    equal = f"element_at(transform({texts}, q -> q.x = q.y OR {by_value('q.x')} = {by_value('q.y')}), 1)"
    members = "try_variant_get(p.{0}, '$', 'map<string,variant>') AS m{0}"
    opened = f"transform({pairs}, p -> struct(p.x AS x, p.y AS y, {members.format('x')}, {members.format('y')}))"
    named = "map_values(map_zip_with(p.mx, p.my, (k, x, y) -> named_struct('x', x, 'y', y)))"
    return f"""flatten(transform({opened}, p -> CASE
        WHEN p.mx IS NOT NULL AND p.my IS NOT NULL THEN filter({named}, q -> q.x IS NOT NULL)
        WHEN p.mx IS NULL AND p.my IS NULL AND p.y IS NOT NULL AND {equal} THEN CAST(array() AS {_PAIRS})
        ELSE {_REFUTATION} END))"""


def _refuted(pairs: Column) -> Column:
    return F.exists(pairs, lambda p: p["y"].isNull())


def _equal_values(x: Column, y: Column) -> Column:
    both = _let(F.struct(F.to_json(x).alias("x"), F.to_json(y).alias("y")), lambda q: (q["x"] == q["y"]) | (_by_value(q["x"]) == _by_value(q["y"])))
    return F.coalesce(both, F.lit(False))


def _scalars(text: Column) -> Column:
    """The names, texts, numbers and words of a JSON text; null if it has escapes, as one text may then be written in several ways."""
    tokens = F.regexp_extract_all(text, F.lit(r'"[^"]*+"|-?[0-9][0-9.eE+-]*+|[a-z]++'), F.lit(0))
    by_value = F.transform(tokens, lambda t: F.when(t.rlike("^-?[0-9]"), (t.cast("double") + 0.0).cast("string")).otherwise(t))
    return F.when(~F.contains(text, F.lit("\\")), by_value)


def json_subset(df: DataFrame, old: str, new: str, out: str = "same") -> DataFrame:
    """True where one JSON value is contained in the other, either way.

    Objects compare by key, arrays and scalars as a whole, numbers by value. Text
    that is not JSON, or is null, is contained in nothing.

    Texts that each have a token which the other lacks need no parsing. The rest
    is parsed; equal values are settled, and other rows keep the pairs of members
    that are still open, by direction. A pass goes down LEVELS levels and writes
    what it finds; only rows with open pairs go into the next one. Pairs stay in
    their row, so nothing is shuffled. Documents nest 999 levels at most (the
    parser's bound), so the passes are bounded.
    """
    names = ("x", "y", "tx", "ty", "no_forth", "no_back", "forth", "back")
    at = dict(zip(names, (_free(df, f"_{c}") for c in names)))
    x, y, tx, ty, no_forth, no_back, forth, back = (F.col(at[c]) for c in names)
    a, b = F.col(old), F.col(new)

    def lacks(own: Column, others: Column) -> Column:
        return F.coalesce(F.size(F.array_except(own, others)) > 0, F.lit(False))

    def in_doubles(value: Column, text: Column) -> Column:
        return F.when(~_suspect(text), value).when(_in_range(F.to_json(value), text), value)

    def settled(rows: DataFrame, verdict: Column, *drop: str) -> tuple[DataFrame, DataFrame]:
        """Rows with a verdict, and those without."""
        passed = materialise(rows.withColumn(out, verdict), "json")
        return passed.where(F.col(out).isNotNull()).drop(*drop), passed.where(F.col(out).isNull()).drop(out)

    tokens = df.withColumns({at["tx"]: _scalars(a), at["ty"]: _scalars(b)})
    tokens = tokens.withColumns({at["no_forth"]: lacks(tx, ty), at["no_back"]: lacks(ty, tx)}).drop(at["tx"], at["ty"])
    found, left = settled(tokens, F.when(a.isNull() | b.isNull() | (no_forth & no_back), F.lit(False)), at["no_forth"], at["no_back"])

    parsed = left.withColumns({at["x"]: parse_dynamic(a), at["y"]: parse_dynamic(b)})
    parsed = parsed.withColumns({at["x"]: in_doubles(x, a), at["y"]: in_doubles(y, b)})
    some = F.array(F.struct(x.alias("x"), y.alias("y"))).cast(_PAIRS), F.array(F.struct(y.alias("x"), x.alias("y"))).cast(_PAIRS)
    parsed = parsed.withColumn(at["forth"], F.when(x.isNull() | y.isNull(), _refutation()).when(_equal_values(x, y), F.array().cast(_PAIRS)).when(no_forth, _refutation()).otherwise(some[0]))
    parsed = parsed.withColumn(at["back"], F.when(_refuted(forth) & (x.isNull() | y.isNull()), _refutation()).when((F.size(forth) == 0) | no_back, _refutation()).otherwise(some[1]))
    open_ = parsed.drop(*(at[c] for c in ("x", "y", "no_forth", "no_back")))
    verdict = F.when((F.size(forth) == 0) | (F.size(back) == 0), F.lit(True)).when(_refuted(forth) & _refuted(back), F.lit(False))
    while not left.isEmpty():
        open_ = open_.withColumns({at[c]: F.expr(reduce(lambda pairs, _: _descend(pairs), range(LEVELS), at[c])) for c in ("forth", "back")})
        decided, left = settled(open_, verdict, at["forth"], at["back"])
        found, open_ = found.unionByName(decided), left
    return found

"""Aggregates with a mergeable state, so a view can be kept current batch by batch.

Each measure says how to make state from rows, how to merge states, and how to
finish. All three are built-in aggregates with map-side partials, so a hot key
sends one row per map task through the shuffle.

A greatest row as such makes Spark sort all rows and columns, as a row has no
fixed width. So whole-row measures take two passes: a hash aggregate finds how far
a key of fixed width reaches in each group, from the grouping and ordering columns
alone; whole rows are compared only where they reach that far.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from ..session import materialise


@dataclass(frozen=True)
class Measure:
    name: str

    def partial(self, df: DataFrame, keys: Sequence[str]) -> list[Column]:
        raise NotImplementedError

    def merge(self, states: T.StructType) -> list[Column]:
        raise NotImplementedError

    def final(self, state: T.StructType) -> list[Column]:
        return [F.col(f"s_{self.name}").alias(self.name)]


@dataclass(frozen=True)
class Count(Measure):
    def partial(self, df, keys):
        return [F.count(F.lit(1)).alias(f"s_{self.name}")]

    def merge(self, states):
        return [F.sum(f"s_{self.name}").alias(f"s_{self.name}")]


@dataclass(frozen=True)
class Sum(Measure):
    """`as_type` fixes the type of the sum; use a decimal for repeatable totals.

    With a decimal, each value is brought to its scale before it is added. Without
    one, doubles are added as doubles, decimals and whole numbers exactly."""

    column: str
    as_type: str | None = None

    def _state(self, source: T.DataType) -> str:
        asked = T.DataType.fromDDL(self.as_type) if self.as_type else None
        for kind in (asked, source):
            if isinstance(kind, T.DecimalType):
                return f"decimal(38,{kind.scale})"
        return "decimal(38,0)" if isinstance(source, T.IntegralType) else "double"

    def partial(self, df, keys):
        state = self._state(df.select(F.col(self.column)).schema[0].dataType)
        return [F.sum(F.col(self.column).cast(state)).cast(state).alias(f"s_{self.name}")]

    def merge(self, states):
        return [F.sum(f"s_{self.name}").cast(states[f"s_{self.name}"].dataType).alias(f"s_{self.name}")]

    def final(self, state):
        total = F.col(f"s_{self.name}")
        return [(total.cast(self.as_type) if self.as_type else total).alias(self.name)]


@dataclass(frozen=True)
class Distinct(Measure):
    """Approximate distinct count; the state is an HLL sketch, not a number."""

    column: str
    log2_buckets: int = 14

    def partial(self, df, keys):
        return [F.hll_sketch_agg(self.column, self.log2_buckets).alias(f"s_{self.name}")]

    def merge(self, states):
        return [F.hll_union_agg(f"s_{self.name}").alias(f"s_{self.name}")]

    def final(self, state):
        return [F.hll_sketch_estimate(f"s_{self.name}").alias(self.name)]


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    return not isinstance(t, (T.MapType, T.VariantType, T.CalendarIntervalType))


@dataclass(frozen=True)
class Arg(Measure):
    """The whole row that holds the greatest (or least) `by` per key; `ties` go
    on with the order. Rows without `by` never win over rows with it.

    The state is the struct (order, row), so its greatest is the row asked for;
    rows that agree in the order are told apart by their other columns."""

    by: str
    ties: Sequence[str] = ()
    columns: Sequence[str] | None = None  # None: all columns
    least: bool = False

    def reach(self, df: DataFrame) -> Column:
        """A key of fixed width that ranks as `by` does, but for ties: the value
        itself, or the first bytes of a text. Other types give one key to all."""
        kind, by = df.schema[self.by].dataType, F.col(f"`{self.by}`")
        if isinstance(kind, (T.NumericType, T.DatetimeType, T.BooleanType)):
            return by
        if isinstance(kind, (T.StringType, T.BinaryType)) and kind in (T.StringType(), T.BinaryType()):  # other collations rank in their own way
            return F.conv(F.rpad(F.hex(F.substring(by.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
        return F.when(by.isNotNull(), F.lit(0))

    def _pick(self, state: Column, t: T.DataType) -> Column:
        if _orderable(t):
            best = (F.min if self.least else F.max)(state)
        else:  # a map or variant cannot be compared; the order alone decides
            best = (F.min_by if self.least else F.max_by)(state, state["order"])
        return best.alias(f"s_{self.name}")

    def partial(self, df, keys):
        kept = [c for c in (self.columns or df.columns) if c not in keys]
        order = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate([self.by, *self.ties])])
        if self.least:  # nulls are least in Spark; here they come last
            order = F.struct(F.col(f"`{self.by}`").isNull().alias("n"), order.alias("o"))
        row = F.struct(*[F.col(f"`{c}`") for c in kept])
        return [self._pick(F.struct(order.alias("order"), row.alias("row")), T.StructType([df.schema[c] for c in kept]))]

    def merge(self, states):
        return [self._pick(F.col(f"s_{self.name}"), states[f"s_{self.name}"].dataType)]

    def final(self, state):
        row = state[f"s_{self.name}"].dataType["row"].dataType
        return [F.col(f"s_{self.name}")["row"][f.name].alias(f.name) for f in row.fields]


@dataclass(frozen=True)
class TakeAny(Arg):
    """Any one row per key. Picking the least by `by` and `ties` makes it repeatable."""

    least: bool = True


@dataclass(frozen=True)
class Summary:
    """``summarize measures by keys``."""

    keys: Sequence[str]
    measures: Sequence[Measure] = field(default_factory=list)

    @property
    def follows_source(self) -> bool:
        """Only whole-row measures can take up new source columns."""
        return all(isinstance(m, Arg) and m.columns is None for m in self.measures)

    def _in_one_pass(self, df: DataFrame, *extra: Column) -> DataFrame:
        return df.groupBy(*self.keys).agg(*[c for m in self.measures for c in m.partial(df, self.keys)], *extra)

    def state_schema(self, df: DataFrame, *extra: Column) -> T.StructType:
        """The schema of `partial`, without running it."""
        return self._in_one_pass(df, *extra).schema

    def partial(self, df: DataFrame, *extra: Column) -> DataFrame:
        """State of the rows; `extra` aggregates ride along in the first pass. With
        whole-row measures that pass runs at once."""
        whole = [m for m in self.measures if isinstance(m, Arg)]
        if not whole or not self.keys or df.isStreaming:
            return self._in_one_pass(df, *extra)
        reach = {f"_reach{i}_": m for i, m in enumerate(whole)}
        ends = [(F.min if m.least else F.max)(m.reach(df)).alias(name) for name, m in reach.items()]
        others = [c for m in self.measures if m not in whole for c in m.partial(df, self.keys)]
        first = materialise(df.groupBy(*self.keys).agg(*ends, *others, *extra), "reach")

        asked = first.select(*[F.col(f"`{k}`").alias(f"_key{i}_") for i, k in enumerate(self.keys)], *reach)
        same = F.lit(True)
        for i, k in enumerate(self.keys):
            same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_key{i}_"))
        near = F.lit(False)
        for name, m in reach.items():
            near = near | m.reach(df).eqNullSafe(F.col(name))
        # One row per group, in files whose size Spark knows: a small table is broadcast, and then the rows are not shuffled.
        reached = df.join(asked, same & (near if len(whole) > 1 else m.reach(df).eqNullSafe(F.col(name))), "left_semi")
        state = reached.groupBy(*self.keys).agg(*[c for m in whole for c in m.partial(df, self.keys)])
        if others or extra:
            rest = first.drop(*reach).select(*[F.col(f"`{k}`").alias(f"_key{i}_") for i, k in enumerate(self.keys)], *[c for c in first.columns if c not in reach and c not in self.keys])
            state = state.join(rest, same, "inner").drop(*[f"_key{i}_" for i in range(len(self.keys))])
        measures = [f"s_{m.name}" for m in self.measures]
        return state.select(*self.keys, *measures, *[c for c in state.columns if c not in measures and c not in self.keys])

    def merge(self, states: DataFrame, *extra: Column) -> DataFrame:
        return states.groupBy(*self.keys).agg(*[c for m in self.measures for c in m.merge(states.schema)], *extra)

    def final(self, state: DataFrame) -> DataFrame:
        return state.select(*self.keys, *[c for m in self.measures for c in m.final(state.schema)])

    def run(self, df: DataFrame) -> DataFrame:
        return self.final(self.partial(df))


def arg_max(df: DataFrame, by: str, keys: Sequence[str], ties: Sequence[str]) -> DataFrame:
    return Summary(keys, [Arg("row", by, ties)]).run(df).select(*df.columns)


def arg_min(df: DataFrame, by: str, keys: Sequence[str], ties: Sequence[str]) -> DataFrame:
    return Summary(keys, [Arg("row", by, ties, least=True)]).run(df).select(*df.columns)


def take_any(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the least by `order` if given, else whichever Spark keeps."""
    if not order:
        return df.dropDuplicates(list(keys))
    return Summary(keys, [TakeAny("row", order[0], order[1:])]).run(df).select(*df.columns)


def count_by(df: DataFrame, keys: Sequence[str], name: str = "count_") -> DataFrame:
    return Summary(keys, [Count(name)]).run(df)


def dcount(df: DataFrame, column: str, keys: Sequence[str], name: str, exact: bool = False) -> DataFrame:
    if exact:
        return df.groupBy(*keys).agg(F.count_distinct(column).alias(name))
    return Summary(keys, [Distinct(name, column)]).run(df)

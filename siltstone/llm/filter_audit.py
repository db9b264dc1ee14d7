"""How filters of documents interact: what each removes in every order of application.

A document's failures are a set of filters. Applying filters one by one walks the
lattice of subsets, from none applied to all; an order of application is a path.
A filter f applied in state S removes the documents that fail f and nothing in S,
whichever way S was reached. So the work is one count per edge (S, f), not per
order. Counting paths forward (orders that reach S) and backward (orders that
leave S with f) tells how many orders use an edge: with these weights the removals
of a filter's edges sum to its removals over all orders, the Shapley value times
the number of orders. The steps of a single order are read from the same edges.

Documents are counted by part and set of failures before the lattice is met, so
what follows has a bounded number of rows for each part, whatever the documents.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.frames import materialise

#: Filters at most; all their orders are listed.
MOST_FILTERS = 6


def edges(n: int) -> list[tuple[int, int, int, int]]:
    """(state, filter, orders that reach the state, orders that leave it by the filter) for each edge, states as bit sets."""
    full = (1 << n) - 1
    reach, leave = [0] * (full + 1), [0] * (full + 1)
    reach[0] = leave[full] = 1
    for state in range(full + 1):  # a subset is a smaller number
        for f in range(n):
            if not state >> f & 1:
                reach[state | 1 << f] += reach[state]
    for state in range(full - 1, -1, -1):
        leave[state] = sum(leave[state | 1 << f] for f in range(n) if not state >> f & 1)
    return [(state, f, reach[state], leave[state | 1 << f]) for state in range(full + 1) for f in range(n) if not state >> f & 1]


def failing(failures: Sequence[Column]) -> Column:
    """The filters that a row fails, as a bit set; unknown is not a failure."""
    bits = [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(failures)]
    return sum(bits[1:], bits[0])


def standard_failures(text: Column) -> list[Column]:
    """Few words; repeated words; capitals; symbols. Words are runs of anything but space and 0x09 to 0x0D."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * capitals > 2 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def failure_sets(docs: DataFrame, labels: DataFrame, failures: Sequence[Column], key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, fails, docs, good, toxic): documents counted by part and set of failed filters.

    `failures` are conditions on a row; the filter after them fails if a smaller
    key has the same text, in any part. A null text is empty, a null part is the
    empty string. A null key is no smaller key and has none, and no label. Rows
    repeated with their key and text are not smaller than each other. A document
    is good or toxic if any label of its key says so.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("same"), failing(failures).alias("fails"),
    )
    rows = materialise(rows, "failures")  # texts are read once
    counted = rows.groupBy("same", "id", "part", "fails").agg(F.count(F.lit(1)).alias("docs"))
    # Joined on text and key: a text that very many rows have is spread by their keys.
    first = rows.groupBy("same").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    marks = labels.groupBy(F.col(key).alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    marked = counted.join(first, ["same", "id"], "left").join(marks, "id", "left")
    marked = marked.withColumn("fails", F.col("fails") + F.when(copy, 1 << len(failures)).otherwise(0))
    sums = [F.sum(F.col("docs") * F.coalesce(m, F.lit(0))).alias(m) for m in ("good", "toxic")]
    return marked.groupBy("part", "fails").agg(F.sum("docs").alias("docs"), *sums)


def audit(sets: DataFrame, names: str) -> DataFrame:
    """One row for each part, order of the filters and step, from the counts of `failure_sets`.

    `names` has one letter for each filter. Columns: part, filter_order, step, and
    as long counts kept, removed, redundant, unique_fails, good_lost, toxic_lost
    and shapley. An empty table has no parts and gives no rows.
    """
    n = len(names)
    if not 1 <= n <= MOST_FILTERS or len(set(names)) != n:
        raise ValueError(f"1 to {MOST_FILTERS} filters with a letter each, not {names!r}")
    spark, lattice = sets.sparkSession, edges(n)
    number = {(state, f): i for i, (state, f, _, _) in enumerate(lattice)}
    orders = []
    for order in itertools.permutations(range(n)):
        state = 0
        for step, f in enumerate(order, 1):
            orders.append(("".join(names[i] for i in order), step, number[state, f]))
            state |= 1 << f
    constants = [F.struct(F.lit(i).alias("edge"), *(F.lit(x).alias(y) for x, y in zip((state, f, reach * leave), ("state", "filter", "weight"))))
                 for i, (state, f, reach, leave) in enumerate(lattice)]

    here = sets.select("*", F.explode(F.array(*constants)).alias("e")).select("part", "fails", "docs", "good", "toxic", "e.*")
    bit = F.expr("shiftleft(1, filter)")
    fails = F.col("fails").bitwiseAND(bit) != 0
    before = F.col("fails").bitwiseAND(F.col("state")) != 0
    after = F.col("fails").bitwiseAND(F.col("state").bitwiseOR(bit)) != 0

    def total(condition: Column, name: str, column: str = "docs") -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0)).cast("long").alias(name)

    on_edges = here.groupBy("part", "edge", "filter", "weight").agg(
        total(~after, "kept"), total(fails & ~before, "removed"), total(fails & before, "redundant"), total(F.col("fails") == bit, "unique_fails"),
        total(fails & ~before, "good_lost", "good"), total(fails & ~before, "toxic_lost", "toxic"),
    )
    of_filter = Window.partitionBy("part", "filter")
    on_edges = on_edges.withColumn("shapley", F.sum(F.col("removed") * F.col("weight")).over(of_filter).cast("long"))
    # n! * n rows at most, whatever the documents
    steps = F.broadcast(spark.createDataFrame(orders, "filter_order string, step int, edge int"))
    return on_edges.join(steps, "edge").select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )

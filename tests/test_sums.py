"""Sums keep what the values hold."""

from decimal import Decimal

import pytest

from siltstone.operators.aggregates import Sum, Summary


def sums(rows, as_type=None):
    summary = Summary(["k"], [Sum("s", "v", as_type)])
    states = summary.partial(rows.where("id < 2")).unionByName(summary.partial(rows.where("id >= 2")))
    (merged,), (whole,) = summary.final(summary.merge(states)).collect(), summary.run(rows).collect()
    assert merged["s"] == pytest.approx(whole["s"]) and type(merged["s"]) is type(whole["s"])
    return merged["s"]


def table(spark, values, kind):
    return spark.createDataFrame([(i, "a", v) for i, v in enumerate(values)], f"id int, k string, v {kind}")


def test_small_and_large_doubles(spark):
    small, large = table(spark, [1e-7, None, 4e-7], "double"), table(spark, [1e22, 3e30, -5e35], "double")
    assert sums(small) == pytest.approx(5e-7) and sums(small, "double") == pytest.approx(5e-7)
    assert sums(small, "decimal(38,10)") == Decimal("5e-7")
    assert sums(large) == pytest.approx(1e22 + 3e30 - 5e35)
    assert sums(table(spark, [1e22, 2e22, 3e22], "double"), "decimal(38,2)") == Decimal("6e22")


def test_exact_types_stay_exact(spark):
    assert sums(table(spark, [Decimal("0.123456789"), Decimal("1e-9"), None], "decimal(20,9)")) == Decimal("0.123456790")
    assert sums(table(spark, [2**62, 2**62, 2**62], "long")) == 3 * 2**62

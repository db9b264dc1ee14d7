import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import requests as req
from siltstone.operators.ordered import running_totals
from siltstone.operators.segments import BatchingPolicy, Bounds, greedy_groups, seal_batches
from siltstone.streaming.ingest import StreamBatcher


def skewed(seed, n=2500):
    rng, rows, at = random.Random(seed), [], 0
    for i in range(n):
        at += rng.choice([0, 1, 1, 5, 40])
        rows.append(("hot" if rng.random() < 0.7 else rng.choice("abc"), i, at, rng.randint(0, 30)))
    return rows


SCHEMA = "k string, id long, at long, size long"


def brute_groups(rows, bounds):
    start, place, found = {}, {}, {}
    limit, span = bounds.sums.get("size"), bounds.span
    for k, i, t, size in rows:
        place[k] = place.get(k, 0) + 1
        g = start.get(k)
        if g is None:
            fresh = True
        elif bounds.closing:
            fresh = g["n"] >= bounds.max_items or g["s"] >= limit or t >= g["t"] + span
        else:
            fresh = g["n"] + 1 > bounds.max_items or g["s"] + size > limit or t - g["t"] > span
        if fresh:
            g = start[k] = {"at": place[k], "n": 0, "s": 0, "t": t}
        g["n"] += 1
        g["s"] += size
        found[i] = g["at"]
    return found


@pytest.mark.parametrize("closing", [True, False])
@pytest.mark.parametrize("n, size, span, block", [(7, 10**9, 10**9, 16), (20, 120, 60, 32), (10, 100, 50, 10), (5, 200, 1000, 10**6)])
def test_greedy_groups(spark, closing, n, size, span, block):
    rows = skewed(n)
    bounds = Bounds(n, {"size": size}, "at", span, closing)
    got = greedy_groups(spark.createDataFrame(rows, SCHEMA), ["k"], ["at", "id"], bounds, "g", block)
    assert {r["id"]: r["g"] for r in got.collect()} == brute_groups(rows, bounds)


@pytest.mark.parametrize("closing", [True, False])
def test_last_group_reaches_over_the_end_of_a_block(spark, closing):
    """No group starts in the second block, so no jump leads there."""
    rows = [("a", i, 0 if i < 8 else 100, 1) for i in range(14)] + [("b", i, 0, 1) for i in range(25)]
    bounds = Bounds(10, {"size": 100}, "at", 50, closing)
    got = greedy_groups(spark.createDataFrame(rows, SCHEMA).where("k = 'a'"), ["k"], ["at", "id"], bounds, "g", 10)
    assert {r["id"]: r["g"] for r in got.collect()} == brute_groups([r for r in rows if r[0] == "a"], bounds)
    got = greedy_groups(spark.createDataFrame(rows, SCHEMA), ["k"], ["at", "id"], bounds, "g", 10)
    assert {(r["k"], r["id"]): r["g"] for r in got.collect()} == {
        (k, i): g for k in "ab" for i, g in brute_groups([r for r in rows if r[0] == k], bounds).items()
    }


@pytest.mark.parametrize("seed", range(3))
def test_many_keys_around_the_block_size(spark, seed):
    rng, rows, i = random.Random(seed), [], 0
    for k in range(12):
        at = 0
        for _ in range(rng.randint(1, 45)):
            at += rng.choice([0, 1, 3, 60])
            rows.append((f"k{k}", i, at, rng.randint(0, 9)))
            i += 1
    bounds = Bounds(rng.choice([3, 8, 15]), {"size": rng.choice([10, 40])}, "at", rng.choice([5, 100]), seed % 2 == 0)
    got = greedy_groups(spark.createDataFrame(rows, SCHEMA), ["k"], ["at", "id"], bounds, "g", 15)
    assert {r["id"]: r["g"] for r in got.collect()} == brute_groups(rows, bounds)


def test_running_totals_of_a_hot_key(spark):
    rows = skewed(3)
    sums, want = {}, {}
    for k, i, _, size in rows:
        sums[k] = sums.get(k, 0) + size
        want[i] = sums[k]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for block in (100, 10**6):
        got = running_totals(df, ["k"], ["at", "id"], {"total": F.col("size")}, block)
        assert {r["id"]: r["total"] for r in got.collect()} == want
    whole = running_totals(df, [], ["at", "id"], {"n": F.lit(1)}, 100)
    assert sorted(r["n"] for r in whole.collect()) == list(range(1, len(rows) + 1))


def test_null_keys_are_kept(spark):
    df = spark.createDataFrame([(None, i) for i in range(50)] + [("a", i) for i in range(50)], "k string, id long")
    got = running_totals(df, ["k"], ["id"], {"n": F.lit(1)}, 10)
    assert got.count() == 100 and got.agg(F.max("n")).first()[0] == 50


def timed(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_seconds("at").cast("timestamp_ntz")).drop("at")


def test_batches_say_what_sealed_them(spark):
    rows = [("a", 1, 0, 1), ("a", 2, 1, 1), ("a", 3, 2, 1), ("a", 4, 3, 50), ("a", 5, 4, 1), ("a", 6, 100, 1)]
    got = seal_batches(timed(spark, rows), ["k"], "ts", ["id"], "size", BatchingPolicy(3, 50, 10_000_000))
    assert [(r["items"], r["bytes"], r["sealed_by"]) for r in got.orderBy("first_time").collect()] == [
        (3, 3, "items"), (1, 50, "bytes"), (1, 1, "age"), (1, 1, "open")
    ]


def test_stream_batcher_equals_one_pass(spark, folder):
    rows, policy = skewed(9, 600), BatchingPolicy(12, 150, 60_000_000)
    df = timed(spark, rows)
    batcher = StreamBatcher(spark, folder("batcher"), ["k"], "ts", ["id"], "size", policy, block_rows=50)
    for i in range(3):
        part = df.where((F.col("id") >= i * 200) & (F.col("id") < (i + 1) * 200))
        batcher.add(part, str(i))
        batcher.add(part, str(i))  # replayed
    names = ["k", "first_time", "last_time", "items", "bytes", "sealed_by"]
    want = seal_batches(df, ["k"], "ts", ["id"], "size", policy).where("sealed_by <> 'open'").select(*names)
    assert sorted(batcher.sealed.read().select(*names).collect()) == sorted(want.collect())
    batcher.add(df.limit(0), "clock", as_of="2100-01-01")
    assert batcher.open_items.read().isEmpty()
    assert batcher.sealed.read().agg(F.sum("items")).first()[0] == 600


def test_concurrency(spark):
    rows = [("g", 1, 0, 10), ("g", 2, 5, 5), ("g", 3, 5, 20), ("g", 4, 10, 11), ("h", 5, 0, None), ("h", 6, 90, 95)]
    df = spark.createDataFrame(rows, "g string, id long, s long, e long").select(
        "g", "id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("s"), F.timestamp_seconds("e").cast("timestamp_ntz").alias("e")
    )
    for block in (2, 1000):
        got = {r["id"]: r["c"] for r in req.concurrency(df, ["g"], "id", "s", "e", "c", block).collect()}
        assert got == {1: 1, 2: 2, 3: 2, 4: 2, 5: 1, 6: 2}


def test_throttled_without_queuing(spark):
    df = spark.range(3).select(
        "id", F.lit("g").alias("workload_group"), F.lit("p").alias("principal"),
        F.expr("timestamp_ntz'2024-01-01'").alias("s"), F.expr("timestamp_ntz'2024-01-02'").alias("e"),
    )
    limits = [req.RateLimit("WorkloadGroup", 2), req.RateLimit("Principal", 1, enabled=False)]
    got = req.decide(df, limits, "id", "s", "e")
    assert [r["verdict"] for r in got.orderBy("id").collect()] == ["admitted", "admitted", "throttled"]
    assert "concurrent_for_principal" not in got.columns

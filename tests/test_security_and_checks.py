import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import quality as q, requests as req, security as sec
from siltstone.operators.lifecycle import HashKey, Partitioning, RangeKey


def test_substring_lookups_against_brute_force(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcé ") for _ in range(n))
    hay = [(word(rng.randint(0, 12)), i, rng.choice("xy")) for i in range(200)]
    needles = list({(word(rng.randint(1, 6)), rng.choice("xy")) for _ in range(80)} | {("zzz", "x"), ("a", "x")})
    df = spark.createDataFrame(hay, "text string, entry_id int, w string")
    asked = spark.createDataFrame(needles, "needle string, w string")
    got = {(r["needle"], r["w"]): r["entry_id"] for r in sec.first_within(df, asked, ["w"]).collect()}
    want = {(n, w): min((i for h, i, x in hay if x == w and n in h), default=None) for n, w in needles}
    assert got == {k: v for k, v in want.items() if v is not None}
    small = [(n, i, w) for i, (n, w) in enumerate(needles)]
    got = sec.first_containing(df.select("text", "w"), spark.createDataFrame(small, "needle string, entry_id int, w string"), ["w"])
    want = {(h, x): min((i for n, i, w in small if w == x and n in h), default=None) for h, _, x in hay}
    assert {(r["text"], r["w"]): r["entry_id"] for r in got.collect()} == {k: v for k, v in want.items() if v is not None}


def test_only_substrings_that_may_be_needles_are_made(spark, monkeypatch):
    monkeypatch.setattr(sec, "HASHED", 64)
    hay = spark.range(3000).selectExpr("concat('é name #', id, ' ü of nobody at all') AS text", "id AS entry_id")
    asked = spark.createDataFrame([("é name #17 ü",), ("#29",), ("missing",), ("\u00fc of nobody at all!",)], "needle string")
    found = sec.first_within(hay, asked)
    assert {tuple(r) for r in found.collect()} == {("é name #17 ü", 17), ("#29", 29)}
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()


def test_details_match_once(spark, monkeypatch):
    looked = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            looked.add(batch.num_rows)
            yield batch

    matches = spark.createDataFrame([(1, 7), (2, None)], "k int, entry_id int").coalesce(1).mapInArrow(count, "k int, entry_id int")
    directory = spark.createDataFrame([(7, "f")], "entry_id int, fqn string")
    got = {(r["k"], r["fqn"]) for r in sec.with_principal_details(matches, directory, ["fqn"]).collect()}
    assert got == {(1, "f"), (2, None)} and looked.value == 2


def test_matching_picks_the_first_entry(spark):
    directory = spark.createDataFrame(
        [(1, "aaduser=guid1;t", "Ann (upn: ann@example.com)", "Table X Admin"), (2, "aaduser=guid2;t", "Bob", "Table X Ingestor"), (3, "AADUSER=GUID1;T", "Ann again", "Table X Admin"), (4, None, None, "Admin")],
        "entry_id int, fqn string, display_name string, role string",
    )
    asked = [("aaduser=ann@example.com", "admins", 1), ("aaduser=GUID1;T", "admins", 1), ("guid2", "ingestors", 2), ("guid2", "admins", None), ("", "admins", None), ("aaduser=guid1;t;more", "admins", 1), ("aadapp=", "admins", None)]
    got = sec.match_principals(spark.createDataFrame([a[:2] for a in asked], "principal string, role string"), directory)
    assert {(r["principal"], r["role"]): r["entry_id"] for r in got.collect()} == {a[:2]: a[2] for a in asked}


def test_drop_beats_add_at_the_same_time(spark):
    log = spark.createDataFrame([("t", "p", "admins", "add", 1), ("t", "p", "admins", "drop", 1), ("t", "q", "viewers", "add", 1)], "table_name string, principal string, role string, action string, at int")
    assert [tuple(r) for r in sec.effective_access(log).collect()] == [("t", "q", "viewers")]


def test_current_user_is_the_default_reader(spark):
    rows = sec.secured(spark.range(3), sec.RowSecurity("SELECT * FROM {source} WHERE _principal = current_user()"))
    assert rows.columns == ["id"] and rows.count() == 3


def test_partitioning_inputs():
    with pytest.raises(ValueError):
        Partitioning([])
    with pytest.raises(ValueError):
        Partitioning([HashKey("a"), HashKey("a")])
    with pytest.raises(ValueError):
        HashKey("a", mode="Random")


def test_hash_seed_is_an_int(spark):
    assert spark.range(1).select(HashKey("f", 64, 2).place(F.lit("f"))).first()[0] == 1


def test_partition_filters_reach_the_scan(spark, folder):
    rows = spark.range(1000).select("id", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, int(id))").alias("t"))
    keys, path = [HashKey("id", 4), RangeKey("t", "2d", "1990-01-01")], folder("layout")
    Partitioning(keys).write(rows, path)
    written = spark.read.parquet(path)
    for condition, want in ((keys[0].equals(17, "bigint"), 1), (keys[1].between("2024-01-05", "2024-01-06 12:00:00"), 36)):
        found = written.where(condition)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan and "PushedFilters: []" not in plan
        assert found.count() == want


def test_range_before_the_reference(spark):
    got = spark.range(1).select(RangeKey("t", "2d", "1990-01-01").place(F.expr("timestamp_ntz'1989-12-30 23:00:00'"))).first()[0]
    assert str(got) == "1989-12-30 00:00:00"


def test_unknown_counts_as_violation(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "")], "id int, t string")
    checks = [q.Check("given", q.not_empty("t")), q.Check("bytes", q.length_between("t", 1, 1))]
    assert sorted(map(tuple, q.violations(df, checks, ["id"]).collect())) == [(1, "bytes"), (1, "given"), (3, "bytes"), (3, "given")]
    assert sorted(map(tuple, q.violation_counts(df, checks).collect())) == [("bytes", 3, 2), ("given", 3, 2)]


def test_length_is_in_bytes(spark):
    assert spark.createDataFrame([("éé",)], "t string").where(q.length_between("t", 4, 4)).count() == 1


def test_unknown_groups_are_default(spark):
    requests = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "app string")
    groups = spark.createDataFrame([("A",), ("default",)], "group_name string")
    rules = [(F.col("app") == "a", "A"), (F.col("app") == "b", "gone"), (F.col("app") == "c", "")]
    got = {r["app"]: r["workload_group"] for r in req.classify(requests, rules, groups).collect()}
    assert got == {"a": "A", "b": "default", "c": "default", None: "default"}


def test_split_policies_of_broken_text(spark):
    df = spark.createDataFrame([(1, "{"), (2, '{"a":null,"b":[1, 2]}'), (3, "[1]"), (4, None), (5, "{}")], "id int, doc string")
    assert sorted(map(tuple, req.split_policies(df, ["id"], "doc").collect())) == [(2, "a", "null"), (2, "b", "[1,2]")]

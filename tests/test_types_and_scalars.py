import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from siltstone.functions import normalise, scalars, types
from siltstone.functions.types import parse_schema, parse_timespan, schema_text


def test_schema_text_round_trip():
    schema = parse_schema("f1:string, ['version']:long,f3:int,f4:datetime,f5:dynamic,f6:bool,f7:real")
    assert schema.fieldNames() == ["f1", "version", "f3", "f4", "f5", "f6", "f7"]
    assert schema["f4"].dataType == T.TimestampNTZType()
    assert parse_schema(schema_text(schema)).fieldNames() == schema.fieldNames()


@pytest.mark.parametrize("text", ["f1", "f1:blob", ":int", "a:int,A:long"])
def test_bad_schema_text(text):
    with pytest.raises(ValueError):
        parse_schema(text)


@pytest.mark.parametrize(
    "text, micros",
    [("30d", 30 * 86_400_000_000), ("00:10:00", 600_000_000), ("2.00:00:00", 2 * 86_400_000_000), ("14.00:00", 14 * 86_400_000_000), ("90s", 90_000_000)],
)
def test_timespans(spark, text, micros):
    assert parse_timespan(text) == micros
    assert spark.range(1).select(types.timespan_micros(F.lit(text))).first()[0] == micros


@pytest.mark.parametrize("text", ["", "x1d", "1dx", "1w", "100:10:005", "d", "00:99:99", "24:00:00", "1.00:60"])
def test_not_timespans(spark, text):
    with pytest.raises(ValueError):
        parse_timespan(text)
    assert spark.range(1).select(types.timespan_micros(F.lit(text))).first()[0] is None


def test_timespans_agree_on_columns(spark):
    texts = [f"{n}{u}" for n in (0, 7, 999, 364635) for u in "dhms"] + ["1.02:03:04", "23:59:59", "5.06:07"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", types.timespan_micros(F.col("t"))).collect()
    assert {r[0]: r[1] for r in rows} == {t: parse_timespan(t) for t in texts}


def test_to_timespan_literal(spark):
    got = spark.range(1).select(*[types.to_timespan_literal(F.lit(t), u) for t, u in (("1.12:00:00", "d"), ("1.12:00:00", "h"), ("90s", "m"))]).first()
    assert tuple(got) == ("1d", "36h", "1m")


def test_terms(spark):
    texts = ["aadapp=7", "xaadapp=7", "AADAPP=", "the end", "other", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(scalars.has_term(F.col("t"), "aadapp=")).collect()] == [True, False, True, False, False, False, None]
    assert [r[0] for r in df.select(scalars.has_term(F.col("t"), "the")).collect()][3:5] == [True, False]


JSON_CASES = {
    '{"a":1}': True, "[1,2]": True, "1": True, '"x"': True, "null": True, " true ": True,
    '{"a":1}}': False, "1,2": False, '1,"b":2': False, "": False, "1] , [2": False, "1} , {2": False, "{": False, "abc": False, "{'a':1}": False,
    '{"a":1,"a":2}': True, '1, "--end of record--"], [': False, "[1,]": False, "1]": False, '1}, "w": {"a":1': False, " ": False,
}


def test_last_of_equal_keys_counts(spark):
    row = spark.range(1).select(scalars.parse_dynamic(F.lit('{"a":1,"a":2}')).alias("v"))
    assert row.select(scalars.member(F.col("v"), "a", "int")).first()[0] == 2


@pytest.mark.parametrize("a, b, same", [
    ('{"a":100}', '{"a":1e2}', True), ('{"a":1,"a":2}', '{"a":2.0}', True), ('{"a":1}', '{"a":true}', False), ("[1,2]", "[1, 2]", True), ("[1,2]", "[2,1]", False),
    ("{", "{", True), ("{", "{ ", False), (None, None, True), (None, "null", False), ("1e400", "1e400", True), ("NaN", "NaN", True), ('{"a":null}', "{}", False),
])
def test_same_json(spark, a, b, same):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(normalise.same_json(F.col("a"), F.col("b"))).first()[0] is same


@pytest.mark.parametrize("a, b, same", [
    ("1", "1.0", True), ("1e2", "100", True), (" 1", "1", False), ("1d", "1", False), ("NaN", "NaN", False), ("1\n", "1", False), (".5", "0.50", True),
    ("", "", False), (None, None, False), ("1e400", "1e400", False), ("-0", "0", True),
])
def test_same_number(spark, a, b, same):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(normalise.same_number(F.col("a"), F.col("b"))).first()[0] is same


def test_deep_json(spark):
    deep = '{"a":' * 500 + "1" + "}" * 500
    df = spark.createDataFrame([(deep, deep.replace("1", "1.0")), (deep, deep.replace("1", "2"))], "a string, b string")
    assert {r["b"]: r["same"] for r in normalise.json_subset(df, "a", "b").collect()} == {deep.replace("1", "1.0"): True, deep.replace("1", "2"): False}


def test_json_validity(spark):
    df = spark.createDataFrame([(t,) for t in JSON_CASES], "t string")
    got = {r[0]: r[1] for r in df.select("t", scalars.is_json(F.col("t"))).collect()}
    assert got == JSON_CASES


def brute_subset(a, b):
    if isinstance(a, dict) and isinstance(b, dict):
        return all(k in b and brute_subset(v, b[k]) for k, v in a.items())
    return type(a) is type(b) and a == b


values = st.recursive(
    st.none() | st.booleans() | st.integers(-3, 3) | st.text("ab{}\"/\\", max_size=3),
    lambda inner: st.lists(inner, max_size=2) | st.dictionaries(st.text("ab/", max_size=2), inner, max_size=3),
    max_leaves=6,
)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(values, values), min_size=40, max_size=60))
def test_json_subset_against_brute_force(spark, pairs):
    import json

    pairs = pairs + [(a, a) for a, _ in pairs] + [(a, {**a, "zz": 1}) for a, _ in pairs if isinstance(a, dict)]
    rows = [(i, json.dumps(a), json.dumps(b)) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    got = {r["i"]: r["same"] for r in normalise.json_subset(df, "a", "b").collect()}
    assert got == {i: brute_subset(a, b) or brute_subset(b, a) for i, (a, b) in enumerate(pairs)}


def test_json_subset_of_broken_text(spark):
    df = spark.createDataFrame([("{", "{}"), ("{}", "{}"), (None, "{}")], "a string, b string")
    assert {r["a"]: r["same"] for r in normalise.json_subset(df, "a", "b").collect()} == {"{": False, "{}": True, None: False}


def test_json_subset_goes_down_and_stays_in_the_jvm(spark):
    def nested(inner, depth=30):
        return '{"a":' * depth + inner + "}" * depth

    rows = [(nested('{"x":1,"y":"\\u0041"}'), nested('{"y":"A","z":[1,2.0],"x":1e0}'), True), (nested('{"x":1,"y":1}'), nested('{"x":[1],"y":1}'), False),
            (nested('{"x":{}}'), nested('{"x":{"p":1},"q":2}'), True), (nested('{"x":{}}'), nested('{"x":[{"p":1}]}'), False),
            ('[{"b":1,"a":2}]', '[{"a":2.0,"b":1}]', True), ('{"a":"\\"1,2\\\\"}', '{"a":"\\"1,2\\\\","b":1}', True), ('{"a":1e999}', '{"a":1e999}', False),
            ('"Infinity"', '"Infinity"', True), ('{"a":1} 2', '{"a":1}', False), ('{"a":null}', "{}", True), ('{"a":null}', '{"a":0}', False)]
    df = spark.createDataFrame([(i, a, b, 0) for i, (a, b, _) in enumerate(rows)], "i int, a string, b string, _forth int")
    out = normalise.json_subset(df, "a", "b")
    assert out.columns == ["i", "a", "b", "_forth", "same"]
    assert {r["i"]: r["same"] for r in out.collect()} == {i: same for i, (_, _, same) in enumerate(rows)}
    for plan in (out, df.select(normalise.same_json(F.col("a"), F.col("b")))):
        assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_principal_kind(spark):
    cases = [("aaduser=x", "AADUSER=y", True), ("aaduser=x", "aadapp=x", False), ("", "", True), ("", "a=b", False), ("same", "SAME", True), ("x", "y", False), (None, None, True)]
    df = spark.createDataFrame([c[:2] for c in cases], "a string, b string")
    assert [r[0] for r in df.select(normalise.same_principal_kind(F.col("a"), F.col("b"))).collect()] == [c[2] for c in cases]


def test_names(spark):
    cases = [("my-db", "['my-db']"), ("plain", "plain"), ("['my-db']", "['my-db']"), ("[x-y", "[x-y")]
    df = spark.createDataFrame(cases, "a string, b string")
    assert all(r[0] == r[1] for r in df.select(scalars.quote_name(F.col("a")), "b").collect())
    schema = spark.range(1).select(scalars.unquote_schema(F.lit("f1:string,['version']:string,f4:string"))).first()[0]
    assert schema == "f1:string,version:string,f4:string"


def test_fingerprint_keeps_fields_apart(spark):
    rows = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "abc"), ("", "abc")], "a string, b string")
    assert rows.select(scalars.fingerprint(F.col("a"), F.col("b"))).distinct().count() == 4


def test_to_int(spark):
    texts = ["1.9", "-1.9", "x", "99999999999", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(scalars.to_int(F.col("t"))).collect()
    assert [r[0] for r in rows] == [1, -1, None, None, None]


def test_case_needs_pairs():
    with pytest.raises(ValueError):
        scalars.case("only a default")


def test_term_edges_are_those_of_any_script(spark):
    from siltstone.functions.scalars import has_term

    df = spark.createDataFrame([("wir ändern das",), ("ÄNDERN!",), ("ndern",)], "t string")
    assert [r[0] for r in df.select(has_term(df.t, "ndern")).collect()] == [False, False, True]
    assert [r[0] for r in df.select(has_term(df.t, "ändern")).collect()] == [True, True, False]

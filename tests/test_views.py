from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltstone.functions.types import parse_schema
from siltstone.operators.aggregates import Arg, Count, Distinct, Sum, Summary, TakeAny, arg_max, arg_min, take_any
from siltstone.operators.security import RowSecurity, secured
from siltstone.operators.views import MaterializedView, ViewSpec, chunk_bounds
from siltstone.plans.stored import Functions
from siltstone.sources.tables import Table, literal_table

# Results of six teams over two years.
TEAMS = [
    ("wildcats", "1996", 89), ("wildcats", "1997", 44), ("bears", "1996", 34), ("bears", "1997", 77),
    ("eagles", "1996", 65), ("eagles", "1997", 62), ("lizards", "1996", 96), ("lizards", "1997", 56),
    ("tigers", "1997", 20), ("tigers", "1996", 90), ("lions", "1996", 81), ("lions", "1997", 34),
]
BEST = [("bears", "1997", 77), ("eagles", "1996", 65), ("lions", "1996", 81), ("lizards", "1996", 96), ("tigers", "1996", 90), ("wildcats", "1996", 89)]


@pytest.fixture
def teams(spark, folder):
    rows = literal_table(spark, parse_schema("team:string, year:string, score:int"), TEAMS)
    return Table(spark, folder("teams")).create(rows).read()


def test_team_view_end_to_end(spark, folder, teams):
    spec = ViewSpec(Summary(["team"], [Arg("row", "score", ["year"])]), time="year", backfill=True, allow_without_rls=True)
    view = MaterializedView(spark, folder("best"), spec)
    view.create(teams)
    got = view.read().select("team", "year", "score")
    assert sorted(map(tuple, got.collect())) == BEST
    only_1996 = secured(got, RowSecurity("SELECT * FROM {source} WHERE year == '1996'"), "reader")
    assert only_1996.count() == 5


def events(spark, n=100):
    return spark.range(n).select(
        F.col("id"), (F.col("id") % 7).alias("k"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, int(id))").alias("t")
    )


def count_view(spark, folder, **more):
    return MaterializedView(spark, folder("view"), ViewSpec(Summary(["k"], [Count("n")]), time="t", **more))


def total(view, *source):
    return view.read(*source).agg(F.sum("n")).first()[0]


def test_consent_for_secured_sources(spark, folder):
    with pytest.raises(PermissionError):
        count_view(spark, folder, backfill=True).create(events(spark), source_secured=True)
    view = count_view(spark, folder, backfill=True, allow_without_rls=True).create(events(spark), source_secured=True)
    assert total(view) == 100


def test_view_inputs():
    summary = Summary(["k"], [Count("n")])
    with pytest.raises(ValueError, match="backfill"):
        ViewSpec(summary, effective=datetime(2024, 1, 1))
    with pytest.raises(ValueError, match="follow"):
        ViewSpec(summary, auto_update_schema=True)
    with pytest.raises(ValueError, match="group key"):
        ViewSpec(summary, created_by="day")


def test_view_exists(spark, folder):
    view = count_view(spark, folder, backfill=True).create(events(spark))
    with pytest.raises(ValueError, match="exists"):
        view.create(events(spark))


def test_from_now_on_then_refresh(spark, folder):
    rows = events(spark)
    view = count_view(spark, folder).create(rows)
    assert total(view) is None and view.materialized_to == datetime(2024, 1, 1, 1, 39)
    more = spark.range(100, 130).select("id", (F.col("id") % 7).alias("k"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, int(id))").alias("t"))
    assert total(view, rows.unionByName(more)) == 30
    view.refresh(more, "1").refresh(more, "1")
    assert total(view) == 30 and view.materialized_to == datetime(2024, 1, 1, 2, 9)


def test_compaction_keeps_view_and_replays(spark, folder):
    view, rows = count_view(spark, folder), events(spark)
    for i in range(4):
        view.refresh(rows.where(F.col("id") % 4 == i), str(i))
    view.compact()
    assert len(view.state.folders) == 1 and total(view) == 100
    view.refresh(rows, "3")
    assert total(view) == 100


def test_chunks_hold_at_most_the_bound(spark):
    rows = events(spark)
    bounds = chunk_bounds(rows, "t", 30)
    sizes = [rows.where((F.col("t") >= a) & (F.col("t") <= b)).count() for a, b in bounds]
    assert sum(sizes) == 100 and max(sizes) <= 30
    same_time = rows.withColumn("t", F.expr("timestamp_ntz'2024-01-01'"))
    assert len(chunk_bounds(same_time, "t", 30)) == 1


def test_rows_without_a_time_are_backfilled(spark, folder):
    rows = events(spark).unionByName(spark.range(3).select("id", F.lit(1).cast("long").alias("k"), F.lit(None).cast("timestamp_ntz").alias("t")))
    assert total(count_view(spark, folder, backfill=True).create(rows)) == 103
    assert total(count_view(spark, folder, backfill=True, max_records=40, concurrency=2).create(rows)) == 103


def test_status_of_an_empty_view(spark, folder):
    view = count_view(spark, folder).create(events(spark).limit(0))
    row = view.status(events(spark), as_of=datetime(2024, 1, 2), healthy_lag_micros=1).first()
    assert (row["materialized_to"], row["rows_pending"], row["is_healthy"]) == (None, 100, "false")


def test_query_that_drops_the_time(spark, folder):
    view = MaterializedView(spark, folder("view"), ViewSpec(Summary(["k"], [Count("n")]), "SELECT k FROM {source}", time="t", backfill=True))
    view.create(events(spark))
    assert view.materialized_to == datetime(2024, 1, 1, 1, 39)


def test_nulls_never_win(spark):
    rows = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 3, 3), ("b", None, 4)], "k string, x int, id int")
    assert sorted((r["k"], r["x"]) for r in arg_max(rows, "x", ["k"], ["id"]).collect()) == [("a", 5), ("b", None)]
    assert sorted((r["k"], r["x"]) for r in arg_min(rows, "x", ["k"], ["id"]).collect()) == [("a", 3), ("b", None)]


def test_ties_are_broken_by_the_given_columns(spark):
    rows = spark.createDataFrame([("a", 5, 1), ("a", 5, 2)], "k string, x int, id int")
    assert arg_max(rows, "x", ["k"], ["id"]).first()["id"] == 2
    assert arg_min(rows, "x", ["k"], ["id"]).first()["id"] == 1
    assert take_any(rows, ["k"]).count() == 1


def test_rows_with_maps(spark):
    rows = spark.createDataFrame([("a", 5, {"x": 1}), ("a", 7, {"x": 2}), ("b", 1, None)], "k string, x int, m map<string,int>")
    assert sorted((r["k"], r["m"]) for r in arg_max(rows, "x", ["k"], []).collect() if r["m"]) == [("a", {"x": 2})]
    assert arg_min(rows, "x", ["k"], []).where("k = 'a'").first()["m"] == {"x": 1}


def test_states_of_all_measures_merge(spark):
    summary = Summary(["k"], [Count("n"), Sum("s", "id"), Distinct("d", "id"), Arg("last", "t", ["id"], ["id"]), TakeAny("first", "t", ["id"], ["t"])])
    rows = events(spark)
    states = summary.partial(rows.where("id < 40")).unionByName(summary.partial(rows.where("id >= 40")))
    one, two = summary.run(rows), summary.final(summary.merge(states))
    assert sorted(one.collect()) == sorted(two.collect())


# -- stored functions ------------------------------------------------------
def test_functions_are_checked_unless_told(spark):
    f = Functions(spark, t=spark.range(5))
    with pytest.raises(Exception):
        f.register("broken", "SELECT nope FROM {t}")
    f.register("later", "SELECT nope FROM {t}", skip_validation=True)
    with pytest.raises(Exception):
        f.call("later")


def test_function_parameters(spark):
    f = Functions(spark, t=spark.range(5))
    f.register("top", "SELECT id FROM {t} WHERE id >= :low ORDER BY id LIMIT :n", "(low:long, n:int)")
    assert [r[0] for r in f.call("top", low=2, n=2).collect()] == [2, 3]
    with pytest.raises(TypeError):
        f.call("top", low=2)


def test_function_as_view_and_query(spark):
    f = Functions(spark, t=spark.range(5)).register("big_ids", "SELECT * FROM {t} WHERE id > 2", expose=True)
    assert spark.sql("SELECT count(*) FROM big_ids").first()[0] == 2
    assert f.resolve("big_ids").count() == 2
    assert f.resolve("SELECT * FROM {source}", source=spark.range(9)).count() == 9
    assert f.resolve(lambda source: source.limit(1), source=spark.range(9)).count() == 1


def late_rows(spark, times):
    return spark.createDataFrame([(0, t) for t in times], "k long, t timestamp_ntz")


def test_view_follows_batches_of_a_table(spark, folder):
    day = datetime(2024, 1, 2)
    source = Table(spark, folder("followed")).create(late_rows(spark, [day, None]))
    view = count_view(spark, folder, backfill=True).create(source)
    assert total(view) == 2
    # Late, at the time reached, and without a time.
    source.append(late_rows(spark, [datetime(2024, 1, 1), day, None]), batch="late")
    assert total(view) == 2 and total(view, source) == 5
    status = view.status(source, as_of=day, healthy_lag_micros=0).first()
    assert (status["rows_pending"], status["is_healthy"]) == (3, "true")
    view.catch_up(source).catch_up(source)
    assert total(view) == total(view, source) == 5
    assert view.status(source, as_of=day, healthy_lag_micros=0).first()["rows_pending"] == 0
    view.compact()
    source.append(late_rows(spark, [None]), batch="more")
    assert total(view.catch_up(source)) == 6


def test_view_from_now_on_follows_batches(spark, folder):
    source = Table(spark, folder("followed")).create(late_rows(spark, [None, None]))
    view = count_view(spark, folder).create(source)
    source.append(late_rows(spark, [None]))
    assert total(view, source) == 1


def test_view_refuses_half_seen_parts(spark, folder):
    source = Table(spark, folder("followed")).append(late_rows(spark, [None]), batch="a")
    view = count_view(spark, folder, backfill=True).create(source)
    source.append(late_rows(spark, [None]), batch="b")
    source.swap_parts(["a", "b"], source.read())
    with pytest.raises(ValueError):
        view.catch_up(source)


def test_undated_rows_are_backfilled(spark, folder):
    rows = late_rows(spark, [datetime(2024, 1, 1), None, datetime(2024, 1, 3)])
    assert total(count_view(spark, folder, backfill=True).create(rows, as_of=datetime(2024, 1, 2))) == 2
    assert total(count_view(spark, folder, backfill=True, effective=datetime(2024, 1, 2)).create(rows)) == 2


def test_whole_rows_are_compared_only_where_they_reach(spark, tmp_path):
    """No row is sorted that does not hold the end of its group; ties, nulls and texts with one beginning come out right."""
    import itertools

    values = [None, "", "a", "long text 1", "long text 2", "long text 2", "zz", "\U0001f600", "é"]
    rows = [(k, i % 5 if i % 7 else None, v, i) for i, (k, v) in enumerate(itertools.product([None, "hot", "k", ""], values * 3))] + [("none", None, None, 1), ("none", None, None, 0)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "k string, n int, v string, i int").write.parquet(path)
    df = spark.read.parquet(path)
    for by in ("v", "n"):
        most = {r["k"]: r["i"] for r in arg_max(df, by, ["k"], ["i"]).collect()}
        least = {r["k"]: r["i"] for r in arg_min(df, by, ["k"], ["i"]).collect()}
        at = {"v": 2, "n": 1}[by]
        for k in {r[0] for r in rows}:
            own = [r for r in rows if r[0] == k]
            known = [r for r in own if r[at] is not None] or own
            rank = {r: ((r[at].encode() if by == "v" else r[at]) if r[at] is not None else b"" if by == "v" else 0, r[3]) for r in known}
            assert most[k] == max(known, key=rank.get)[3] and least[k] == min(known, key=rank.get)[3]
    both = Summary(["k"], [Count("c"), Arg("last", "n", ["i"], ["i"]), Arg("first", "v", ["i"], ["v"], least=True)]).run(df).collect()
    assert {r["k"]: r["c"] for r in both} == {k: sum(r[0] == k for r in rows) for k in {r[0] for r in rows}}
    plan = arg_max(df, "n", ["k"], ["i"])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert below.index("LeftSemi") > below.index("Sort [") and "Sort [" not in below[below.index("LeftSemi"):]


def test_chunked_backfill_reads_the_source_once(spark, folder, tmp_path):
    rows = [(i % 7, datetime(2024, 1, 1) + timedelta(seconds=i // 3) if i % 50 else None, i) for i in range(600)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "k int, t timestamp_ntz, _chunk int").write.parquet(path)
    source = spark.read.parquet(path)
    summary = Summary(["k"], [Count("n"), Sum("s", "_chunk"), Arg("last", "t", ["_chunk"], ["_chunk"])])
    whole = MaterializedView(spark, folder("whole"), ViewSpec(summary, time="t", backfill=True)).create(source)
    view = MaterializedView(spark, folder("chunked"), ViewSpec(summary, time="t", backfill=True, max_records=40))
    seen = []
    stage = view.state.stage
    view.state.stage = lambda df, *more: seen.append(df) or stage(df, *more)
    view.create(source)
    assert len(seen) == 1 and len(view.state.batches) > 10 and "backfill-undated" in view.state.batches
    assert sorted(view.read().collect()) == sorted(whole.read().collect())
    dated = MaterializedView(spark, folder("query"), ViewSpec(Summary(["k"], [Count("n")]), "SELECT k, t FROM {source}", time="t", backfill=True, max_records=40)).create(source)
    assert {r["k"]: r["n"] for r in dated.read().collect()} == {k: sum(r[0] == k for r in rows) for k in range(7)}
    assert view.materialized_to == whole.materialized_to == dated.materialized_to

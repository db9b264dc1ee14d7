import json

import pytest
from pyspark.sql import functions as F

from siltstone import files
from siltstone.sources.external import ExternalTable
from siltstone.sources.tables import Table
from siltstone.streaming.export import ContinuousExport
from siltstone.streaming.ingest import read_stream, trigger_bytes
from siltstone.streaming.update_policy import Ingestion, UpdatePolicy


def rows(spark, low, high):
    return spark.range(low, high).select("id", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, int(id))").alias("_ingestion_time"))


BROKEN = "SELECT id, assert_true(id < 0) AS x FROM {source}"


def test_transactional_failure_changes_nothing(spark, folder):
    tables = Ingestion(spark, folder("tables"), [
        UpdatePolicy("a", "ok", "SELECT id FROM {source}"), UpdatePolicy("a", "bad", BROKEN, transactional=True)
    ])
    with pytest.raises(Exception):
        tables.ingest(spark.range(5), "a", "1")
    assert not any(tables.table(t).exists() for t in ("a", "ok", "bad"))


def test_other_failures_keep_the_source(spark, folder):
    tables = Ingestion(spark, folder("tables"), [
        UpdatePolicy("a", "bad", BROKEN), UpdatePolicy("bad", "after", "SELECT * FROM {source}"), UpdatePolicy("a", "ok", "SELECT id FROM {source}")
    ])
    assert tables.ingest(spark.range(5), "a", "1") == ["bad"]
    assert tables.table("a").read().count() == tables.table("ok").read().count() == 5
    assert not tables.table("bad").exists() and not tables.table("after").exists()


def test_replayed_batch_is_a_no_op(spark, folder):
    tables = Ingestion(spark, folder("tables"), [UpdatePolicy("a", "b", "SELECT id FROM {source}")])
    for batch in ("1", "1", "2"):
        tables.ingest(spark.range(5), "a", batch)
    assert tables.table("a").read().count() == tables.table("b").read().count() == 10


def test_cycles_are_refused(spark, folder):
    with pytest.raises(ValueError, match="cycle"):
        Ingestion(spark, folder("tables"), [UpdatePolicy("a", "b", "x"), UpdatePolicy("b", "a", "x")])


def test_properties_are_restamped_unless_propagated(spark, folder):
    policies = [UpdatePolicy("a", "same", "SELECT id FROM {source}", propagate=True), UpdatePolicy("a", "own", "SELECT id FROM {source}")]
    tables = Ingestion(spark, folder("tables"), policies)
    tables.ingest(spark.range(2), "a", "1", as_of="2020-01-01", tags=["x"])
    same, own = tables.table("same").read().first(), tables.table("own").read().first()
    assert (str(same["_ingestion_time"]), same["_tags"]) == ("2020-01-01 00:00:00", "x") and own["_tags"] == ""


def test_disabled_export_does_nothing(spark, folder):
    export = ContinuousExport("SELECT id FROM {source}", ExternalTable("id:long", "csv", folder("out")), disabled=True)
    assert export.run(spark, rows(spark, 0, 5), folder("state"), "2100-01-01") is False


def test_export_inputs(folder):
    external = ExternalTable("id:long", "csv", "x")
    for bad in ({"interval": "30s"}, {"size_limit": 5}):
        with pytest.raises(ValueError):
            ContinuousExport("q", external, **bad)
    with pytest.raises(ValueError, match="run"):
        ContinuousExport("q", external, forced_latency="5m").start(None, "x")


def test_run_that_died_is_repeated(spark, folder):
    external, state = ExternalTable("id:long", "parquet", folder("out")), folder("state")
    export = ContinuousExport("SELECT id FROM {source}", external)
    # The files of a run are there, its record is not.
    external.write(rows(spark, 0, 5), f"{external.path_list[0]}/run=000000000000")
    export.run(spark, rows(spark, 0, 60), state, "2024-01-01 00:29:00")
    export.run(spark, rows(spark, 0, 60), state, "2024-01-01 00:29:00")
    export.run(spark, rows(spark, 0, 60), state, "2024-01-02")
    assert sorted(r["id"] for r in external.read(spark).collect()) == list(range(60))
    assert len(files.names(spark, state)) == 3
    last = json.loads(files.read_text(spark, f"{state}/000000000002.json"))
    assert last["upto"].startswith("2024-01-02")


def test_export_follows_batches_of_a_table(spark, folder):
    external, state = ExternalTable("id:long", "parquet", folder("out")), folder("state")
    source = Table(spark, folder("source")).append(rows(spark, 0, 5), batch="a")
    export = ContinuousExport("SELECT id FROM {source}", external)
    export.run(spark, source, state, "2024-01-01 00:00:10")
    # Stamped before the last run but committed after it, and without a time.
    source.append(rows(spark, 2, 4).unionByName(rows(spark, 90, 91).withColumn("_ingestion_time", F.lit(None).cast("timestamp_ntz"))), batch="late")
    for _ in range(2):
        export.run(spark, source, state, "2024-01-01 00:00:20")
    assert sorted(r["id"] for r in external.read(spark).collect()) == [0, 1, 2, 2, 3, 3, 4, 90]


def test_forced_latency_holds_batches_back(spark, folder):
    external, state = ExternalTable("id:long", "parquet", folder("out")), folder("state")
    source = Table(spark, folder("source")).append(rows(spark, 0, 5), batch="a").append(rows(spark, 50, 52), batch="b")
    export = ContinuousExport("SELECT id FROM {source}", external, forced_latency="30s")
    export.run(spark, source, state, "2024-01-01 00:10:00")
    assert external.read(spark).count() == 5
    export.run(spark, source, state, "2024-01-01 01:00:00")
    assert external.read(spark).count() == 7


@pytest.mark.parametrize("table, how", [({"name_prefix": "p"}, {}), ({"include_headers": "FirstFile"}, {}), ({"encoding": "UTF8BOM"}, {}), ({}, {"size_limit": 200_000_000})])
def test_the_file_sink_refuses_what_it_lacks(spark, folder, table, how):
    export = ContinuousExport("SELECT id FROM {source}", ExternalTable("id:long", "csv", folder("out"), **table), **how)
    stream = spark.readStream.format("rate").load().selectExpr("value AS id")
    with pytest.raises(ValueError, match="run"):
        export.start(stream, folder("check"))


def test_export_never_goes_back(spark, folder):
    external, state = ExternalTable("id:long", "parquet", folder("out")), folder("state")
    export = ContinuousExport("SELECT id FROM {source}", external)
    for as_of in ("2024-01-01 00:30:00", "2024-01-01 00:10:00", "2024-01-01 00:40:00"):
        export.run(spark, rows(spark, 0, 60), state, as_of)
    assert sorted(r["id"] for r in external.read(spark).collect()) == list(range(41))


def test_rate_hint():
    assert trigger_bytes(3.6, "10s") == 10 * 1024**3 // 1000
    assert trigger_bytes(0, "10s") == 1


def test_streaming_can_be_off(spark, folder):
    with pytest.raises(ValueError, match="off"):
        read_stream(spark, folder(), rows(spark, 0, 1).schema, enabled=False)


def test_export_into_a_custom_layout(spark, folder):
    external = ExternalTable("id:long, a:int", "csv", folder("out"), partitions=("a",), path_format="part/{a}")
    export, state = ContinuousExport("SELECT id, cast(id % 3 AS int) AS a FROM {source}", external), folder("state")
    for as_of in ("2024-01-01 00:30:00", "2024-01-02"):
        export.run(spark, rows(spark, 0, 60), state, as_of)
    assert sorted(r["id"] for r in external.read(spark).collect()) == list(range(60))
    assert external.read(spark, a=1).count() == 20


def test_two_sources_of_a_new_target_must_agree(spark, folder):
    policies = [UpdatePolicy("a", "t", "SELECT id FROM {source}"), UpdatePolicy("a", "u", "SELECT id, 1 AS x FROM {source}"),
                UpdatePolicy("u", "t", "SELECT id, x FROM {source}")]
    tables = Ingestion(spark, folder("tables"), policies)
    assert tables.ingest(spark.range(3), "a", "1") == ["t"]
    assert tables.table("t").read().count() == 3 and "x" not in tables.table("t").read().columns


def test_streaming_view_over_restarts_and_compaction(spark, folder):
    from siltstone.operators.aggregates import Arg, Count, Distinct, Summary
    from siltstone.operators.views import MaterializedView, ViewSpec
    from siltstone.streaming.ingest import start_view

    summary = Summary(["k"], [Count("n"), Distinct("d", "id"), Arg("last", "_ingestion_time", ["id"], ["id"])])
    view = MaterializedView(spark, folder("view"), ViewSpec(summary))
    source, checkpoint = folder("source"), folder("checkpoint")
    for i in range(4):
        new = rows(spark, i * 100, i * 100 + 100).withColumn("k", F.col("id") % 5)
        new.write.mode("append").parquet(source)
        running = start_view(view, read_stream(spark, source, new.schema), checkpoint)
        running.awaitTermination()
        assert running.exception() is None
        if i == 1:
            view.compact()
    found = view.read().orderBy("k").collect()
    assert [(r["n"], r["d"], r["id"]) for r in found] == [(80, 80, 395 + k) for k in range(5)]
    assert len(view.state.folders) == 3

import gzip
import glob
import json

import pytest
from pyspark.sql import functions as F

from siltstone import files
from siltstone.functions.types import parse_schema
from siltstone.operators import drift, schema as schemas
from siltstone.operators.lifecycle import MergePolicy, run_merges
from siltstone.sources.external import ExternalTable
from siltstone.sources.mapping import Mapping, Rule, map_w3c, read_mapped
from siltstone.sources.tables import SNAPSHOT_EVERY, Table, TableExists, commit_together


def local(path):
    return path.removeprefix("file:")


def test_create_fails_if_the_table_exists(spark, folder):
    table = Table(spark, folder()).create(spark.range(3))
    with pytest.raises(TableExists):
        table.create(spark.range(3))
    assert table.read().count() == 3


def test_type_change_is_refused(spark, folder):
    table = Table(spark, folder()).create(spark.range(3).select(F.col("id").alias("a")))
    with pytest.raises(ValueError, match="cannot be altered"):
        table.alter(parse_schema("a:string"), merge=True)
    with pytest.raises(ValueError, match="cannot be altered"):
        table.append(spark.range(1).select(F.col("id").cast("string").alias("a")))


def test_extra_columns_need_extension(spark, folder):
    table = Table(spark, folder()).create(spark.range(3))
    wider = spark.range(2).withColumn("x", F.lit(1))
    with pytest.raises(ValueError, match="extend"):
        table.append(wider)
    assert table.append(wider, extend_schema=True).read().where("x IS NULL").count() == 3


def test_dropped_column_does_not_come_back(spark, folder):
    table = Table(spark, folder()).create(spark.range(3).withColumn("x", F.lit(1)))
    table.alter(parse_schema("id:long"), merge=False)
    assert table.read().columns == ["id"]
    with pytest.raises(ValueError, match="come back"):
        table.alter(parse_schema("x:int"), merge=True)
    with pytest.raises(ValueError, match="come back"):
        table.append(spark.range(3).withColumn("x", F.lit(1)), extend_schema=True)
    assert table.replace(spark.range(1).withColumn("x", F.lit(2)), recreate_schema=True).read().columns == ["id", "x"]


def test_replace_keeps_the_schema_unless_told(spark, folder):
    table = Table(spark, folder()).create(spark.range(3).withColumn("x", F.lit(1)))
    assert table.replace(spark.range(2)).read().columns == ["id", "x"]
    assert table.replace(spark.range(2), recreate_schema=True).read().columns == ["id"]


def test_replayed_batch_is_known_after_compaction(spark, folder):
    table = Table(spark, folder())
    for i in range(5):
        table.append(spark.range(i * 10, i * 10 + 10), batch=str(i))
    assert run_merges(table, MergePolicy(lookback="All"), "2100-01-01") == 5
    table.append(spark.range(10), batch="0")
    assert table.read().count() == 50 and len(table.folders) == 1


def test_old_batches_stay_known(spark, folder):
    table = Table(spark, folder())
    for i in range(5):
        table.append(spark.range(10), batch=str(i))
    run_merges(table, MergePolicy(lookback="All"), "2100-01-01")
    assert len(table.batches) == 5
    for i in range(5):
        table.append(spark.range(10), batch=str(i))
    assert table.read().count() == 50


def test_merge_bounds_are_kept(spark, folder):
    table = Table(spark, folder())
    for i in range(6):
        table.append(spark.range(10), batch=str(i))
    run_merges(table, MergePolicy(lookback="All", max_rows=25), "2100-01-01")
    assert len(table.folders) == 3
    counts = table.read().groupBy("_metadata.file_path").count().collect()
    assert sorted(r["count"] for r in counts) == [20, 20, 20]
    assert run_merges(table, MergePolicy(lookback="All", max_rows=40), "2100-01-01") == 2
    assert len(table.folders) == 2 and table.read().distinct().count() == 10 and table.read().count() == 60


def test_a_large_group_is_not_one_task(spark, folder):
    table = Table(spark, folder())
    for i in range(3):
        table.append(spark.range(i * 40_000, (i + 1) * 40_000).withColumn("x", F.sha2(F.col("id").cast("string"), 256)), batch=str(i))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "1m")
    try:
        assert run_merges(table, MergePolicy(lookback="All"), "2100-01-01") == 3
    finally:
        spark.conf.unset(size)
    counts = [r["count"] for r in table.read().groupBy("_metadata.file_path").count().collect()]
    assert sum(counts) == 120_000 and max(counts) < 60_000 and len(table.folders) == 1
    assert table.read().distinct().count() == 120_000


def test_merging_can_be_off(spark, folder):
    table = Table(spark, folder())
    for i in range(3):
        table.append(spark.range(10), batch=str(i))
    assert run_merges(table, MergePolicy(lookback="All", allow_rebuild=False), "2100-01-01") == 0
    assert run_merges(table, MergePolicy(lookback="All", allow_merge=False), "2100-01-01") == 0


def test_merge_policy_inputs():
    with pytest.raises(ValueError):
        MergePolicy(lookback="Custom")
    with pytest.raises(ValueError):
        MergePolicy(lookback="Sometimes")


def test_schema_operators():
    a, b = parse_schema("x:int,y:string"), parse_schema("y:string,z:long")
    assert schemas.merged(a, b).fieldNames() == ["x", "y", "z"]
    with pytest.raises(ValueError):
        schemas.merged(a, parse_schema("x:long"))
    assert sorted(drift.schema_diff(a, b)) == [("x", "added"), ("z", "removed")]


# -- external tables -------------------------------------------------------
SCHEMA = "id:long, name:string, day:datetime"


def people(spark, n=20):
    return spark.range(n).select(
        "id", F.concat(F.lit(" näme, \"x\" \\ "), F.col("id").cast("string"), F.lit("\\ ")).alias("name"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00.123456'").alias("day"),
    )


@pytest.mark.parametrize("fmt", ["csv", "tsv", "json", "parquet"])
@pytest.mark.parametrize("compressed", [False, True])
def test_round_trip(spark, folder, fmt, compressed):
    table = ExternalTable(SCHEMA, fmt, folder(), compressed=compressed)
    table.write(people(spark))
    assert sorted(table.read(spark).collect()) == sorted(people(spark).collect())


@pytest.mark.parametrize("how", [
    {"include_headers": "FirstFile"}, {"include_headers": "None"}, {"encoding": "UTF8BOM"},
    {"include_headers": "FirstFile", "encoding": "UTF8BOM"}, {"include_headers": "FirstFile", "compressed": True},
    {"name_prefix": "p-", "file_extension": ".txt"}, {"name_prefix": "p-", "file_extension": ".txt", "compressed": True},
])
def test_header_modes(spark, folder, how):
    table = ExternalTable(SCHEMA, "csv", folder(), **how)
    table.write(people(spark).repartition(4))
    assert sorted(table.read(spark).collect()) == sorted(people(spark).collect())


def test_header_per_folder_of_a_custom_layout(spark, folder):
    table = ExternalTable("id:long, a:string", "csv", folder(), partitions=("a",), path_format="k-{a}", include_headers="FirstFile", file_extension=".txt")
    rows = spark.range(30).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), (F.col("id") % 3).cast("string"))).alias("a"))
    for low in (0, 10, 20):  # written in three goes
        table.write(rows.where((F.col("id") >= low) & (F.col("id") < low + 10)))
    assert sorted((r["id"], r["a"] or "") for r in table.read(spark).collect()) == sorted((r["id"], r["a"] or "") for r in rows.collect())
    assert table.read(spark, a="v1").count() == 10


def test_other_endings_are_not_read(spark, folder):
    table = ExternalTable("id:long", "csv", folder(), file_extension=".txt", include_headers="None")
    path = table.write(spark.range(5))
    for name in ("old.txt.bak", "x.csv"):
        with open(f"{local(path)}/{name}", "w") as f:
            f.write("99\n")
    with gzip.open(f"{local(path)}/more.txt.gz", "wt") as f:
        f.write("5\n")
    table.write(spark.range(6, 8))
    assert sorted(r["id"] for r in table.read(spark).collect()) == list(range(8))


def test_byte_order_mark_is_written(spark, folder):
    table = ExternalTable(SCHEMA, "csv", folder(), encoding="UTF8BOM")
    path = table.write(people(spark))
    files = glob.glob(local(path) + "/*.csv")
    assert files and all(open(f, "rb").read(3) == b"\xef\xbb\xbf" for f in files)


def test_first_file_only_has_the_header(spark, folder):
    path = ExternalTable(SCHEMA, "csv", folder(), include_headers="FirstFile", compressed=True).write(people(spark).repartition(4))
    texts = [gzip.open(f, "rt").read() for f in sorted(glob.glob(local(path) + "/*.gz"))]
    assert texts[0].startswith("id,name,day") and not any("id,name" in t for t in texts[1:])


def test_names_of_files(spark, folder):
    path = ExternalTable(SCHEMA, "csv", folder(), name_prefix="p-", file_extension=".txt").write(people(spark))
    names = [f.rsplit("/", 1)[1] for f in glob.glob(local(path) + "/*") if "_SUCCESS" not in f]
    assert names and all(n.startswith("p-") and n.endswith(".txt") for n in names)


def test_path_format_reads_only_wanted_folders(spark, folder):
    table = ExternalTable("id:long, a:int, b:string", "parquet", folder(), partitions=("a", "b"), path_format="x{a}/{b}")
    rows = spark.range(30).select("id", (F.col("id") % 3).cast("int").alias("a"), F.when(F.col("id") < 15, "lo").otherwise("h i:+50%").alias("b"))
    table.write(rows)
    assert sorted(table.read(spark).collect()) == sorted(rows.collect())
    one = table.read(spark, a=1)
    assert one.count() == 10 and all("/x1/" in f for f in one.inputFiles())
    assert table.read(spark, b="h i:+50%").count() == 15
    uris = {r[0].removeprefix(table.path_list[0]) for r in table.sample_uris(spark).collect()}
    assert "/x0/lo" in uris and len(uris) == 6


def test_hive_partitions_prune(spark, folder):
    table = ExternalTable("id:long, a:int", "parquet", folder(), partitions=("a",))
    table.write(spark.range(30).select("id", (F.col("id") % 3).cast("int").alias("a")))
    plan = table.read(spark).where("a = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(a" in plan
    assert table.files_preview(spark).count() >= 3


def test_external_inputs(spark, folder):
    for bad in ({"data_format": "xls"}, {"include_headers": "Some"}, {"encoding": "UTF16"}):
        with pytest.raises(ValueError):
            ExternalTable(**{"schema": SCHEMA, "data_format": "csv", "paths": "x", **bad})
    with pytest.raises(ValueError, match="not written"):
        ExternalTable(SCHEMA, "orc", folder()).write(people(spark))
    empty = ExternalTable(SCHEMA, "parquet", folder())
    empty.write(people(spark).limit(0))
    with pytest.raises(ValueError, match="no rows"):
        empty.check_not_empty(spark)
    assert empty.dry_run(spark) == parse_schema(SCHEMA)


# -- mappings --------------------------------------------------------------
def test_mapping_inputs(spark, folder):
    with pytest.raises(ValueError):
        Mapping("xml", [])
    path = folder()
    spark.range(1).select(F.lit("{}")).write.text(path)
    with pytest.raises(ValueError, match="does not have"):
        read_mapped(spark, path, Mapping("json", [Rule("nope", path="$.a")]), parse_schema("f1:string"))


def test_json_paths_into_arrays(spark, folder):
    """Elements of arrays, one that is missing, and a constant over a typed column."""
    lines = folder()
    texts = ['{"samples":[{"ph":6.5},{"ph":7}],"when":"2024-02-29"}', '{"samples":[{"ph":"acid"}],"when":"soon"}', "[1]", "not json"]
    spark.createDataFrame([(t,) for t in texts], "v string").coalesce(1).write.text(lines)
    rules = [Rule("second_ph", path="$.samples[1].ph"), Rule("first_ph", path="$.samples[0].ph"), Rule("taken", path="$.when"), Rule("run", constvalue="17")]
    target = parse_schema("run:int,first_ph:real,second_ph:real,taken:datetime,remark:string")
    got = read_mapped(spark, lines, Mapping("json", rules), target, count_bad=True)
    assert sorted((r["run"], r["first_ph"] or 0, r["second_ph"] or 0, str(r["taken"]), r["remark"], r["_bad"]) for r in got.collect()) == [
        (17, 0, 0, "None", None, 0), (17, 0, 0, "None", None, 0), (17, 0, 0, "None", None, 2), (17, 6.5, 7.0, "2024-02-29 00:00:00", None, 0)]


@pytest.mark.parametrize("base", [0, 1])
def test_positions_beyond_the_row(spark, folder, base):
    rows = folder()
    spark.createDataFrame([("9,north,0.5",), ("10,south",), ("x",)], "v string").coalesce(1).write.text(rows)
    rules = [Rule("plot", ordinal=base), Rule("yield_t", ordinal=base + 2), Rule("never", ordinal=base + 7), Rule("season", constvalue="2023-10-01")]
    got = read_mapped(spark, rows, Mapping("csv", rules), parse_schema("plot:long,yield_t:decimal,never:string,season:datetime"), ordinal_base=base, count_bad=True)
    assert sorted((r["plot"] or 0, float(r["yield_t"] or 0), r["never"], r["season"].year, r["_bad"]) for r in got.collect()) == [
        (0, 0.0, None, 2023, 1), (9, 0.5, None, 2023, 0), (10, 0.0, None, 2023, 0)]


@pytest.mark.parametrize("kind", ["json", "csv", "w3clogfile"])
def test_rule_without_a_source_gives_null(spark, folder, kind):
    path = folder()
    spark.createDataFrame([("#Fields: f1",), ('{"f1":1,"None":2}',)], "v string").coalesce(1).write.text(path)
    got = read_mapped(spark, path, Mapping(kind, [Rule("f1")]), parse_schema("f1:string")).distinct().collect()
    assert [tuple(r) for r in got] == [(None,)]


def test_quotes_are_doubled(spark, folder):
    path = folder()
    spark.createDataFrame([('1,"a ""b"", c",x',)], "v string").write.text(path)
    got = read_mapped(spark, path, Mapping("csv", [Rule("f2", ordinal=1)]), parse_schema("f2:string")).first()[0]
    assert got == 'a "b", c'


def test_dynamic_and_transform(spark, folder):
    path = folder()
    spark.createDataFrame([('{"a":{"x":[1]},"value":"v"}',)], "v string").write.text(path)
    rules = [Rule("a", path="$.a", datatype="dynamic"), Rule("b", path="$.value", datatype="dynamic"),
             Rule("c", path="$.value", transform="concat(value, 'value', upper(value))")]
    got = read_mapped(spark, path, Mapping("json", rules), parse_schema("a:dynamic,b:dynamic,c:string")).first()
    assert tuple(got) == ('{"x":[1]}', '"v"', "vvalueV")


def test_w3c_header_per_file(spark):
    lines = spark.createDataFrame(
        [("#Version: 1.0", "a"), ("#Fields: x y", "a"), ("1 two+words", "a"), ("#Fields: y x", "b"), ("three 4", "b"), ("- 5", "b"), ("", "b"), ("8 nameless", "c")],
        "value string, path string",
    )
    rules = [Rule("x", field="x"), Rule("y", field="y"), Rule("z", field="none")]
    got = map_w3c(lines, Mapping("w3clogfile", rules), parse_schema("x:int,y:string,z:string"), count_bad=True)
    rows = sorted((r["x"] or 0, r["y"] or "", r["z"], r["_bad"]) for r in got.collect())
    assert rows == [(0, "", None, 1), (1, "two+words", None, 0), (4, "three", None, 0), (5, "", None, 0)]


def test_w3c_header_in_force(spark, tmp_path):
    """The fields change within a file, also where it is read in many blocks; no line is lost."""
    wanted, logs = [], {"plain": False, "nameless": True}
    for log, nameless in logs.items():
        out = []
        for i in range(4000):
            if i % 97 == 50 or (i == 0 and not nameless):
                out.append("#Date: today" if i % 2 else "")
                out.append("#Fields: id who" if i // 97 % 3 else "#Fields: who id")
            swapped = any(o.startswith("#Fields: who") for o in [x for x in out if x.startswith("#Fields")][-1:])
            known = any(x.startswith("#Fields") for x in out)
            out.append(f"u{i} {i}" if swapped else f"{i} u{i}")
            wanted.append((i, f"u{i}") if known else (None, None))
        (tmp_path / f"{log}.log").write_text("\n".join(out))
    mapping, target = Mapping("w3clogfile", [Rule("id", field="id"), Rule("who", field="who")]), parse_schema("id:long,who:string")
    small = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "1"}
    kept = {k: spark.conf.get(k) for k in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        got = read_mapped(spark, str(tmp_path), mapping, target)
        rows = [(r["id"], r["who"]) for r in got.collect()]
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    assert sorted(rows, key=str) == sorted(wanted, key=str)


def test_commits_do_not_grow_with_the_table(spark, folder):
    table = Table(spark, folder())
    schema = parse_schema("a:int")
    for i in range(3 * SNAPSHOT_EVERY + 5):
        base = table._commit()
        table._publish(base, {**(base["parts"] if base else {}), f"batch-{i:05d}": f"part-{i:05d}"}, schema, listed={"seen": [i]}, last=i)
    state = table._commit()
    assert list(state["parts"]) == [f"batch-{i:05d}" for i in range(3 * SNAPSHOT_EVERY + 5)]
    assert state["notes"] == {"seen": list(range(3 * SNAPSHOT_EVERY + 5)), "last": 3 * SNAPSHOT_EVERY + 4}
    sizes = {len(json.dumps(table._read_commit(v))) for v in table._versions() if v > 1}
    assert max(sizes) - min(sizes) < 8 and len(table._versions(".snapshot")) == 3
    assert not [n for n in files.names(spark, f"{table.path}/_commits") if n.endswith(".tmp")]
    with pytest.raises(FileExistsError):
        files.write_new_text(spark, f"{table.path}/_commits/{1:012d}.json", "again")


def test_tables_commit_together_or_not_at_all(spark, folder):
    root = folder()
    a, b = Table(spark, f"{root}/a"), Table(spark, f"{root}/b").create(spark.range(2))
    parts = [(a, {"1": a.stage(spark.range(3))}, spark.range(1).schema), (b, {"1": b.stage(spark.range(5))}, spark.range(1).schema)]

    class Dies(Table):
        def add_staged(self, *args, **more):
            raise OSError("died")

    with pytest.raises(OSError):
        commit_together(spark, root, [parts[0], (Dies(spark, b.path), *parts[1][1:])])
    assert not a.exists() and b.read().count() == 2
    commit_together(spark, root, parts)
    assert a.read().count() == 3 and b.read().count() == 7 and a.batches == ["1"]
    a.append(spark.range(1), batch="2")
    assert a.read().count() == 4


@pytest.mark.parametrize("kind", ["avro", "ApacheAvro"])
def test_avro_where_its_module_is_installed(spark, folder, kind):
    path = folder()
    try:
        spark.range(3).select("id", F.struct(F.col("id").cast("string").alias("b")).alias("a")).write.format("avro").save(path)
    except Exception as error:
        if "avro" not in str(error).lower():
            raise
        pytest.skip("the Avro module is not installed")
    rules = [Rule("f1", field="id"), Rule("f2", path="$.a.b")]
    got = read_mapped(spark, path, Mapping(kind, rules), parse_schema("f1:long,f2:string"))
    assert sorted(map(tuple, got.collect())) == [(0, "0"), (1, "1"), (2, "2")]


def test_nested_columns(spark, folder):
    path = folder()
    spark.range(2).select("id", F.struct(F.struct(F.col("id").cast("string").alias("c")).alias("b")).alias("a")).write.parquet(path)
    got = read_mapped(spark, path, Mapping("Parquet", [Rule("f1", path="$.a.b.c", transform="value || '!'")]), parse_schema("f1:string,f2:int"))
    assert sorted(map(tuple, got.collect())) == [("0!", None), ("1!", None)]


def test_pruned_reads_compare_values(spark, folder):
    path = folder("padded")
    for month, low, high in (("m-01", 0, 3), ("m-1", 3, 6), ("m-02", 6, 8), ("m-11", 8, 9), ("other", 9, 10)):
        spark.range(low, high).write.parquet(f"{path}/{month}")
    table = ExternalTable("id:long, month:int", "parquet", path, partitions=("month",), path_format="m-{month}")
    assert sorted(r["id"] for r in table.read(spark, month=1).collect()) == [0, 1, 2, 3, 4, 5]
    assert table.read(spark, month=11).count() == 1
    assert table.read(spark, month=7).count() == 0
    assert table.read(spark).where("month = 1").count() == 6


def test_pruned_reads_of_odd_names(spark, folder):
    names = ["a b", "a+b", "x[1]", "50%", "{z}", "v*"]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id long, a string")
    table = ExternalTable("id:long, a:string", "parquet", folder("odd"), partitions=("a",), path_format="k-{a}")
    table.write(rows)
    assert sorted(r["a"] for r in table.read(spark).collect()) == sorted(names)
    for i, name in enumerate(names):
        assert [tuple(r) for r in table.read(spark, a=name).collect()] == [(i, name)]


def test_file_size_of_wide_text(spark, folder):
    text = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(40)), lambda x: F.sha2((F.col("id") * 100 + x).cast("string"), 512)))
    table = Table(spark, folder("wide")).create(spark.range(2000).withColumn("text", text).coalesce(1), size_limit=1_000_000)
    sizes = table.read().select("_metadata.file_path", "_metadata.file_size").distinct().collect()
    assert len(sizes) >= 10 and max(r["file_size"] for r in sizes) <= 1_000_000


@pytest.mark.parametrize("layout", [None, "{year}/m-{month}"])
def test_previews_open_no_file(spark, folder, layout):
    schema = "year:int,month:string,n:long"
    table = ExternalTable(schema, "json", folder("preview"), partitions=("year", "month"), path_format=layout)
    rows = [(2023, "a b", 1), (2023, "a b", 2), (2024, "c+d", 3), (2024, "é", 4)]
    table.write(spark.createDataFrame(rows, "year int, month string, n long").coalesce(1))
    base, make = table.path_list[0], (lambda y, m: f"{y}/m-{m}") if layout else (lambda y, m: f"year={y}/month={m}")
    assert sorted(r["uri"] for r in table.sample_uris(spark).collect()) == sorted({f"{base}/{make(y, m)}" for y, m, _ in rows})
    seen = table.files_preview(spark)
    assert seen.count() == 3 and seen.where("file_size > 0").count() == 3
    assert {r[0] for r in seen.select("file_path").collect()} == {r[0] for r in table.read(spark).select("_metadata.file_path").distinct().collect()} if layout is None else True
    for preview in (seen, table.sample_uris(spark)):
        plan = preview._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<>" in plan and "json" not in plan.split("Location")[0].lower()

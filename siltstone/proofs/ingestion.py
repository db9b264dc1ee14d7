"""Mappings, external tables, tables from queries and schema evolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.types import parse_schema, schema_text
from ..operators import schema as schemas
from ..operators.aggregates import Arg, Summary
from ..operators.views import MaterializedView, ViewSpec
from ..session import fresh_dir
from ..sources.external import ExternalTable
from ..sources.mapping import Mapping, Rule, read_mapped
from ..sources.tables import Table, literal_table
from .registry import each, load, query, spread

EVENT_SCHEMA = "event_id:long, ts:datetime, user_id:long, event_type:string, value:real, k:int, origin:string"


def _event_lines(spark, sf):
    """Events as nested JSON lines; those of type error are cut short."""
    record = F.struct(
        "event_id", F.col("ts").cast("string").alias("ts"), "user_id",
        F.struct(F.col("event_type").alias("type"), "value", F.get_json_object("props", "$.k").cast("int").alias("k")).alias("body"),
    )
    text = F.to_json(record)
    broken = F.substring(text, F.lit(1), F.length(text) - 2)
    path = fresh_dir(spark, "events-json")
    load(spark, sf, "events").select(F.when(F.col("event_type") == "error", broken).otherwise(text)).write.text(path)
    return path


@query(
    "mapping_json",
    """SELECT CASE WHEN ok THEN event_id END AS event_id, CASE WHEN ok THEN ts END AS ts,
              CASE WHEN ok THEN user_id END AS user_id, CASE WHEN ok THEN event_type END AS event_type,
              CASE WHEN ok THEN value END AS value,
              CASE WHEN ok THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
              CAST(NULL AS VARCHAR) AS origin
       FROM (SELECT *, event_type <> 'error' AS ok FROM events)""",
)
def mapping_json(spark, sf):
    rules = [
        Rule("event_id", path="$.event_id"), Rule("ts", path="$.ts"), Rule("user_id", path="$.user_id", datatype="long"),
        Rule("event_type", path="$.body.type", datatype="string"), Rule("value", path="$.body.value"),
        Rule("k", path="$.body.k", datatype="int"),
    ]
    return read_mapped(spark, _event_lines(spark, sf), Mapping("json", rules), parse_schema(EVENT_SCHEMA))


@query(
    "mapping_constant_and_transform",
    """SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
              CASE WHEN event_type <> 'error' THEN upper(event_type) END AS event_type, 'import' AS origin
       FROM events""",
)
def mapping_constant_and_transform(spark, sf):
    rules = [
        Rule("event_id", path="$.event_id"),
        Rule("event_type", path="$.body.type", transform="upper(value)"),
        Rule("origin", constvalue="import"),
    ]
    target = parse_schema("event_id:long, event_type:string, origin:string")
    return read_mapped(spark, _event_lines(spark, sf), Mapping("JSON", rules), target)


@query(
    "mapping_bad_values",
    """SELECT event_type, count(*) AS rows, CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS BIGINT) AS bad
       FROM events GROUP BY event_type""",
)
def mapping_bad_values(spark, sf):
    """A text mapped to a whole number does not fit; the row stays and is counted."""
    rules = [Rule("event_type", path="$.body.type"), Rule("k", path="$.body.type", datatype="int")]
    target = parse_schema("event_type:string, k:int")
    mapped = read_mapped(spark, _event_lines(spark, sf), Mapping("json", rules), target, count_bad=True)
    return (
        mapped.groupBy(F.coalesce("event_type", F.lit("error")).alias("event_type"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("_bad").alias("bad"))
    )


@query(
    "mapping_csv",
    "SELECT c_custkey, c_name, c_acctbal, c_mktsegment, 'branch ledger' AS origin FROM customer",
)
def mapping_csv(spark, sf):
    path = fresh_dir(spark, "customer-csv")
    load(spark, sf, "customer").write.csv(path)
    rules = [
        Rule("c_custkey", ordinal=0, datatype="long"), Rule("c_name", ordinal=1), Rule("c_acctbal", ordinal=3),
        Rule("c_mktsegment", ordinal=4, datatype="string"), Rule("origin", constvalue="branch ledger"),
    ]
    target = parse_schema("c_custkey:long, c_name:string, c_acctbal:real, c_mktsegment:string, origin:string")
    return read_mapped(spark, path, Mapping("csv", rules), target)


LINE_RULES = [
    Rule("order_id", path="$.l_orderkey"), Rule("line", field="l_linenumber", datatype="string"),
    Rule("quantity", path="l_quantity", datatype="int"), Rule("shipped", field="l_shipdate"),
]
LINE_SQL = """SELECT l_orderkey AS order_id, CAST(l_linenumber AS VARCHAR) AS line,
                     CAST(trunc(l_quantity) AS INTEGER) AS quantity, l_shipdate AS shipped FROM lineitem"""
LINE_SCHEMA = "order_id:long, line:string, quantity:int, shipped:datetime"


@query("mapping_parquet", LINE_SQL)
def mapping_parquet(spark, sf):
    return read_mapped(spark, f"{sf}/lineitem.parquet", Mapping("parquet", LINE_RULES), parse_schema(LINE_SCHEMA))


@query("mapping_orc", LINE_SQL)
def mapping_orc(spark, sf):
    path = fresh_dir(spark, "lineitem-orc")
    load(spark, sf, "lineitem").write.orc(path)
    return read_mapped(spark, path, Mapping("orc", LINE_RULES), parse_schema(LINE_SCHEMA))


@query("mapping_w3c_log", "SELECT event_id, ts, user_id, event_type AS kind, value FROM events")
def mapping_w3c_log(spark, sf):
    """Log files of an event type and up to 20000 ids each; two types name their
    fields in another order."""
    events = load(spark, sf, "events")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    other = F.col("event_type").isin("click", "view")
    numbers = [F.col(c).cast("string") for c in ("event_id", "user_id", "value")]
    line = F.when(other, F.concat_ws(" ", numbers[2], "event_type", stamp, numbers[0], numbers[1])).otherwise(
        F.concat_ws(" ", numbers[0], stamp, numbers[1], "event_type", numbers[2])
    )
    header = F.when(other, "#Fields: amount cs-kind date-time id user").otherwise("#Fields: id date-time user cs-kind amount")
    lines = events.select(F.concat_ws("-", F.floor(F.col("event_id") / 20000).cast("string"), "event_type").alias("log"), header.alias("header"), line.alias("value"))
    headers = lines.select("log", F.col("header").alias("value")).distinct().withColumn("place", F.lit(0))
    path = fresh_dir(spark, "w3c")
    (
        lines.select("log", "value", F.lit(1).alias("place"))
        .unionByName(headers)
        .repartition("log")
        .sortWithinPartitions("log", "place")
        .select("log", "value")
        .write.partitionBy("log")
        .text(path)
    )
    rules = [
        Rule("event_id", field="id"), Rule("ts", field="date-time"), Rule("user_id", field="user"),
        Rule("kind", field="cs-kind"), Rule("value", field="amount"),
    ]
    target = parse_schema("event_id:long, ts:datetime, user_id:long, kind:string, value:real")
    return read_mapped(spark, path, Mapping("w3clogfile", rules), target)


@query(
    "literal_table_named_subquery",
    """WITH weights(kind, weight) AS (VALUES ('click', 1), ('view', 2), ('purchase', 10), ('signup', 5))
       SELECT event_type, CAST(sum(weight) AS BIGINT) AS total FROM events JOIN weights ON event_type = kind GROUP BY event_type""",
)
def literal_table_named_subquery(spark, sf):
    weights = literal_table(spark, parse_schema("kind:string, weight:int"), [("click", 1), ("view", 2), ("purchase", 10), ("signup", 5)])
    return spark.sql(
        """WITH weighted AS (SELECT event_type, weight FROM {events} JOIN {weights} ON event_type = kind)
           SELECT event_type, sum(weight) AS total FROM weighted GROUP BY event_type""",
        events=load(spark, sf, "events"), weights=weights,
    )


# -- external tables -------------------------------------------------------
ORDER_SCHEMA = "o_orderkey:long, o_custkey:long, o_orderstatus:string, o_totalprice:real, o_orderdate:datetime, o_orderpriority:string"
ORDER_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


def _external(spark, sf, fmt, **more):
    table = ExternalTable(ORDER_SCHEMA, fmt, fresh_dir(spark, f"orders-{fmt}"), **more)
    table.write(load(spark, sf, "orders"))
    return table


@query("external_csv", ORDER_SQL)
def external_csv(spark, sf):
    return _external(spark, sf, "csv", compressed=True).read(spark)


@query("external_tsv", ORDER_SQL)
def external_tsv(spark, sf):
    return _external(spark, sf, "tsv", include_headers="None").read(spark)


@query("external_json", ORDER_SQL)
def external_json(spark, sf):
    return _external(spark, sf, "json").read(spark)


@query("external_parquet", ORDER_SQL)
def external_parquet(spark, sf):
    return _external(spark, sf, "parquet").read(spark)


@query("external_text", "SELECT o_orderkey || ',' || o_orderstatus AS line FROM orders")
def external_text(spark, sf):
    path = fresh_dir(spark, "orders-text")
    load(spark, sf, "orders").select(F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus")).write.text(path)
    return ExternalTable("line:string", "text", path).read(spark)


@query("external_several_paths", "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY o_orderstatus")
def external_several_paths(spark, sf):
    orders, paths = load(spark, sf, "orders"), []
    one = ExternalTable(ORDER_SCHEMA, "csv", "unset")
    for i, part in enumerate(each("o_orderstatus", ("F", "O"))):
        paths.append(one.write(orders.where(part), fresh_dir(spark, f"orders-{i}")))
    table = ExternalTable(ORDER_SCHEMA, "csv", ",".join(paths))
    return table.read(spark).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


MONTH_SCHEMA = ORDER_SCHEMA + ", year:int, month:int"
MONTH_SQL = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
                      count(*) AS orders, min(o_orderkey) AS first_order, max(o_totalprice) AS dearest
               FROM orders {where} GROUP BY ALL"""


def _by_month(spark, sf, **more):
    table = ExternalTable(MONTH_SCHEMA, "csv", fresh_dir(spark, "orders-months"), partitions=("year", "month"), **more)
    orders = load(spark, sf, "orders").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    table.write(orders)
    return table


def _month_counts(df):
    return df.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("orders"), F.min("o_orderkey").alias("first_order"), F.max("o_totalprice").alias("dearest")
    )


@query("external_hive_partitions", MONTH_SQL.format(where="WHERE year(o_orderdate) >= 1997"))
def external_hive_partitions(spark, sf):
    return _month_counts(_by_month(spark, sf).read(spark).where("year >= 1997"))


@query("external_path_format", MONTH_SQL.format(where=""))
def external_path_format(spark, sf):
    return _month_counts(_by_month(spark, sf, path_format="{year}/m-{month}").read(spark))


@query("external_path_format_pruned", MONTH_SQL.format(where="WHERE year(o_orderdate) = 1996"))
def external_path_format_pruned(spark, sf):
    return _month_counts(_by_month(spark, sf, path_format="{year}/m-{month}").read(spark, year=1996))


@query("external_file_selection", "SELECT o_orderstatus, count(*) AS orders FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY o_orderstatus")
def external_file_selection(spark, sf):
    """Three kinds of file in one folder; prefix and extension pick two."""
    folder, orders = fresh_dir(spark, "orders-mixed"), load(spark, sf, "orders")
    kinds = (("F", "done-", ".txt"), ("O", "done-", ".txt"), ("others", "open-", ".txt"))
    for (kind, prefix, ending), part in zip(kinds, each("o_orderstatus", ["F", "O"])):
        ExternalTable(ORDER_SCHEMA, "csv", folder, name_prefix=prefix, file_extension=ending).write(orders.where(part), f"{folder}/state={kind}")
    table = ExternalTable(ORDER_SCHEMA, "csv", folder, name_prefix="done-", file_extension=".txt")
    return table.read(spark).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "external_headers_and_encoding",
    """SELECT mode, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders,
       (VALUES ('All'), ('All gzip'), ('All mark'), ('FirstFile'), ('FirstFile mark'), ('None')) m(mode) GROUP BY mode""",
)
def external_headers_and_encoding(spark, sf):
    orders = load(spark, sf, "orders")
    orders = orders.repartition(spread(orders))
    modes = {
        "All": {}, "All gzip": {"compressed": True}, "All mark": {"encoding": "UTF8BOM"},
        "FirstFile": {"include_headers": "FirstFile"},
        "FirstFile mark": {"include_headers": "FirstFile", "encoding": "UTF8BOM"}, "None": {"include_headers": "None"},
    }
    found = None
    for mode, how in modes.items():
        table = ExternalTable(ORDER_SCHEMA, "csv", fresh_dir(spark, "orders-headers"), **how)
        table.write(orders)
        rows = table.read(spark).agg(F.count(F.lit(1)).alias("orders"), F.sum("o_orderkey").alias("keys")).select(F.lit(mode).alias("mode"), "orders", "keys")
        found = rows if found is None else found.unionByName(rows)
    return found


@query("external_sample_uris", "SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) || '/m-' || CAST(month(o_orderdate) AS VARCHAR) AS uri FROM orders")
def external_sample_uris(spark, sf):
    table = _by_month(spark, sf, path_format="{year}/m-{month}")
    return table.sample_uris(spark).select(F.replace("uri", F.lit(table.path_list[0] + "/"), F.lit("")).alias("uri"))


@query("external_files_preview", "SELECT count(DISTINCT (year(o_orderdate), month(o_orderdate))) AS folders, true AS sized FROM orders")
def external_files_preview(spark, sf):
    table = _by_month(spark, sf)
    table.check_not_empty(spark)
    preview = table.files_preview(spark)
    folder = F.regexp_extract("file_path", "^(.*)/[^/]+$", 1)
    return preview.agg(F.count_distinct(folder).alias("folders"), F.min(F.col("file_size") > 0).alias("sized"))


# -- tables from queries ---------------------------------------------------
def _new_table(spark, label):
    return Table(spark, fresh_dir(spark, label))


@query("table_from_query", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def table_from_query(spark, sf):
    orders = load(spark, sf, "orders")
    return _new_table(spark, "created").create(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")).read()


@query("table_append", "SELECT o_orderkey, o_orderstatus FROM orders")
def table_append(spark, sf):
    orders, table = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), _new_table(spark, "appended")
    closed, open_, others = each("o_orderstatus", ["F", "O"])
    for batch, part in (("F", closed), ("O", open_), ("O", open_), ("others", others)):  # the repeated batch is a no-op
        table.append(orders.where(part), batch=batch)
    return table.read()


@query("table_replace", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def table_replace(spark, sf):
    table = _new_table(spark, "replaced").create(load(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"))
    return table.replace(table.read().where("o_totalprice > 100000")).read()


@query("table_writers", "SELECT mode, count(*) AS rows, mode = 'single' AS one_file FROM lineitem, (VALUES ('single'), ('distributed')) m(mode) GROUP BY mode")
def table_writers(spark, sf):
    lines, found = load(spark, sf, "lineitem"), None
    lines = lines.repartition(spread(lines))
    for mode in ("single", "distributed"):
        table = _new_table(spark, mode).create(lines, distributed=mode == "distributed")
        rows = table.read().select("_metadata.file_path").agg(
            F.count(F.lit(1)).alias("rows"), (F.count_distinct("file_path") == 1).alias("one_file")
        ).select(F.lit(mode).alias("mode"), "rows", "one_file")
        found = rows if found is None else found.unionByName(rows)
    return found


@query(
    "table_sized_files",
    """SELECT 'lineitem' AS source, count(*) AS rows, true AS within_limit FROM lineitem
       UNION ALL SELECT 'documents', count(*), true FROM documents""",
)
def table_sized_files(spark, sf):
    """Files of 1 MB at most, of narrow rows and of long texts."""
    found = []
    for source in ("lineitem", "documents"):
        table = _new_table(spark, "sized").create(load(spark, sf, source), size_limit=1_048_576, row_group_rows=1000)
        sizes = table.read().agg(F.count(F.lit(1)).alias("rows"), (F.max("_metadata.file_size") <= 1_048_576).alias("within_limit"))
        found.append(sizes.select(F.lit(source).alias("source"), "rows", "within_limit"))
    return found[0].union(found[1])


# -- schema evolution ------------------------------------------------------
@query("schema_from_text", "SELECT n_nationkey, n_name AS \"version\", CAST(n_regionkey AS BIGINT) AS region, c_custkey FROM nation JOIN customer ON c_nationkey = n_nationkey")
def schema_from_text(spark, sf):
    """The declared schema is applied to data and survives the way back to text."""
    declared = parse_schema(schema_text(parse_schema("n_nationkey:int, ['version']:string, region:long, c_custkey:long")))
    rows = load(spark, sf, "nation").join(load(spark, sf, "customer"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(*[
        F.col(source).cast(f.dataType).alias(f.name)
        for source, f in zip(("n_nationkey", "n_name", "n_regionkey", "c_custkey"), declared.fields)
    ])


@query("schema_alter_exact", "SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS INTEGER) AS rank FROM orders")
def schema_alter_exact(spark, sf):
    return schemas.alter_exact(load(spark, sf, "orders"), parse_schema("o_orderkey:long, o_orderstatus:string, note:string, rank:int"))


@query(
    "schema_alter_merge",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 'closed' END AS note FROM orders""",
)
def schema_alter_merge(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    closed, others = each("o_orderstatus", ["F"])
    return schemas.union_merge(orders.where(others), orders.where(closed).withColumn("note", F.lit("closed")))


@query("table_alter", "SELECT o_orderkey, o_orderstatus, CAST(NULL AS INTEGER) AS rank FROM orders")
def table_alter(spark, sf):
    """A column is added, then another dropped, without rewriting the rows."""
    table = _new_table(spark, "altered").create(load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"))
    table.alter(parse_schema("rank:int"), merge=True)
    return table.alter(parse_schema("o_orderkey:long, o_orderstatus:string, rank:int"), merge=False).read()


@query(
    "table_extend_schema",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus IS DISTINCT FROM 'F' THEN o_totalprice END AS o_totalprice FROM orders""",
)
def table_extend_schema(spark, sf):
    orders, table = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), _new_table(spark, "extended")
    closed, others = each("o_orderstatus", ["F"])
    table.create(orders.where(closed).drop("o_totalprice"))
    return table.append(orders.where(others), extend_schema=True).read()


@query("table_recreate_schema", "SELECT c_custkey, c_name FROM customer")
def table_recreate_schema(spark, sf):
    table = _new_table(spark, "recreated").create(load(spark, sf, "orders").select("o_orderkey", "o_orderstatus"))
    return table.replace(load(spark, sf, "customer").select("c_custkey", "c_name"), recreate_schema=True).read()


@query("schema_clone", "SELECT * FROM lineitem LIMIT 0")
def schema_clone(spark, sf):
    return schemas.clone_empty(load(spark, sf, "lineitem"))


@query(
    "view_follows_source_schema",
    """SELECT user_id, event_id, event_type, CASE WHEN event_type IN ('click', 'view') THEN NULL ELSE value END AS value
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
             FROM events) WHERE r = 1""",
)
def view_follows_source_schema(spark, sf):
    """The first batch has no value column; the second brings it."""
    events = load(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    spec = ViewSpec(Summary(["user_id"], [Arg("row", "ts", ["event_id"])]), time="ts", backfill=True, auto_update_schema=True)
    view = MaterializedView(spark, fresh_dir(spark, "following-view"), spec)
    clicks, views, others = each("event_type", ["click", "view"])
    view.create(events.where(clicks | views).drop("value"))
    view.refresh(events.where(others), "1")
    return view.read().select("user_id", "event_id", "event_type", "value")

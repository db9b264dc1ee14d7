"""Query vocabulary, stored functions, scalar functions, joins and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import normalise, scalars, types
from ..operators import drift, security
from ..plans.stored import Functions
from .registry import load, query

# -- projections, filters, scalar control ----------------------------------


@query("filter_and_project", "SELECT o_orderkey AS order_id, o_totalprice AS price FROM orders WHERE year(o_orderdate) = 1996")
def filter_and_project(spark, sf):
    # A range on the raw column instead of year(): it reaches the scan.
    return (
        load(spark, sf, "orders")
        .where("o_orderdate >= TIMESTAMP_NTZ'1996-01-01' AND o_orderdate < TIMESTAMP_NTZ'1997-01-01'")
        .select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"))
    )


@query("extend_columns", "SELECT event_id, user_id, upper(event_type) AS event_type, true AS hi, CAST(value AS VARCHAR) AS shown FROM events")
def extend_columns(spark, sf):
    return load(spark, sf, "events").withColumns(
        {"hi": F.lit(True), "event_type": F.upper("event_type"), "shown": scalars.to_string(F.col("value"))}
    ).select("event_id", "user_id", "event_type", "hi", "shown")


@query(
    "print_scalar",
    """SELECT CAST(CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS BIGINT) // 86400000000 AS VARCHAR) || 'd' AS days,
              CAST(CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS BIGINT) // 3600000000 AS VARCHAR) || 'h' AS hours FROM events""",
)
def print_scalar(spark, sf):
    """One row: the time the events span, in whole units."""
    span = F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))
    return load(spark, sf, "events").select(types.in_units(span, "d").alias("days"), types.in_units(span, "h").alias("hours"))


@query(
    "conditionals",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'large' ELSE 'small' END AS size,
              CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderpriority = '1-URGENT' THEN 'rush'
                   WHEN o_totalprice < 10000 THEN 'minor' ELSE 'normal' END AS lane FROM orders""",
)
def conditionals(spark, sf):
    lane = scalars.case(
        F.col("o_orderstatus") == "F", "done", F.col("o_orderpriority") == "1-URGENT", "rush",
        F.col("o_totalprice") < 10000, "minor", "normal",
    )
    size = scalars.iff(F.col("o_totalprice") > 250000, F.lit("large"), F.lit("small"))
    return load(spark, sf, "orders").select("o_orderkey", size.alias("size"), lane.alias("lane"))


@query(
    "term_match",
    r"""SELECT doc_id, regexp_matches(text, '(?i)(^|[^\p{L}\p{N}])the([^\p{L}\p{N}]|$)') AS has_the,
               regexp_matches(text, '(?i)of,') AS has_of_comma
        FROM documents WHERE regexp_matches(text, '(?i)(^|[^\p{L}\p{N}])and([^\p{L}\p{N}]|$)')""",
)
def term_match(spark, sf):
    docs = load(spark, sf, "documents").where(scalars.has_term(F.col("text"), "AND"))
    return docs.select(
        "doc_id",
        scalars.has_term(F.col("text"), "the").alias("has_the"),
        F.col("text").rlike("(?i)of,").alias("has_of_comma"),
    )


@query(
    "dynamic_member",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              json_extract_string(props, '$.absent') AS absent FROM events""",
)
def dynamic_member(spark, sf):
    doc = load(spark, sf, "events").withColumn("doc", scalars.parse_dynamic(F.col("props")))
    return doc.select("event_id", scalars.member(F.col("doc"), "k", "int").alias("k"), scalars.member(F.col("doc"), "absent").alias("absent"))


# -- stored functions ------------------------------------------------------
def _functions(spark, sf):
    f = Functions(spark, orders=load(spark, sf, "orders"), customer=load(spark, sf, "customer"))
    f.register("urgent_orders", "SELECT * FROM {orders} WHERE o_orderpriority = '1-URGENT'")
    f.register(
        "orders_of_status",
        "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = :param1 ORDER BY o_totalprice DESC, o_orderkey LIMIT :limit_size",
        "(param1:string, limit_size:int)",
    )
    f.register("urgent_by_segment", lambda urgent_orders, customer: (
        urgent_orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("orders"))
    ))
    return f


@query("stored_function", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'")
def stored_function(spark, sf):
    return _functions(spark, sf).call("urgent_orders")


@query("stored_function_with_parameters", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def stored_function_with_parameters(spark, sf):
    return _functions(spark, sf).call("orders_of_status", param1="F", limit_size=10)


@query(
    "stored_function_over_function",
    """SELECT c_mktsegment, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_orderpriority = '1-URGENT' GROUP BY c_mktsegment""",
)
def stored_function_over_function(spark, sf):
    return _functions(spark, sf).call("urgent_by_segment")


# -- scalar functions ------------------------------------------------------
SPAN_SQL = """(SELECT event_id, CAST(k AS VARCHAR) || CASE event_type WHEN 'click' THEN 'd' WHEN 'view' THEN 'h' WHEN 'error' THEN 'm' ELSE 's' END AS unit_form,
                      CAST(k AS VARCHAR) || '.' || strftime(ts, '%H:%M:%S') AS clock_form, strftime(ts, '%H:%M:%S') AS short_form,
                      CAST(k AS VARCHAR) || '.' || strftime(ts, '%H:%M') AS minute_form, k, event_type, ts
               FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""


def _spans(spark, sf):
    k = F.get_json_object("props", "$.k").cast("string")
    unit = F.when(F.col("event_type") == "click", "d").when(F.col("event_type") == "view", "h").when(F.col("event_type") == "error", "m").otherwise("s")
    clock = F.date_format("ts", "HH:mm:ss")
    return load(spark, sf, "events").select(
        "event_id", F.concat(k, unit).alias("unit_form"), F.concat_ws(".", k, clock).alias("clock_form"),
        clock.alias("short_form"), F.concat_ws(".", k, F.date_format("ts", "HH:mm")).alias("minute_form"),
    )


@query(
    "timespan_literals",
    f"""WITH s AS {SPAN_SQL}
        SELECT event_id, k * CASE event_type WHEN 'click' THEN 86400000000 WHEN 'view' THEN 3600000000 WHEN 'error' THEN 60000000 ELSE 1000000 END AS unit_form,
               k * 86400000000 + (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) * 1000000 AS clock_form,
               (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) * 1000000 AS short_form,
               k * 86400000000 + (hour(ts) * 3600 + minute(ts) * 60) * 1000000 AS minute_form, CAST(NULL AS BIGINT) AS not_one FROM s""",
)
def timespan_literals(spark, sf):
    spans = _spans(spark, sf)
    forms = [types.timespan_micros(F.col(c)).alias(c) for c in ("unit_form", "clock_form", "short_form", "minute_form")]
    return spans.select("event_id", *forms, types.timespan_micros(F.concat(F.lit("x"), "unit_form")).alias("not_one"))


@query(
    "timespan_in_units",
    f"""WITH s AS {SPAN_SQL}
        SELECT event_id, CAST((k * CASE event_type WHEN 'click' THEN 86400 WHEN 'view' THEN 3600 WHEN 'error' THEN 60 ELSE 1 END) // 3600 AS VARCHAR) || 'h' AS hours,
               CAST(k AS VARCHAR) || 'd' AS days FROM s""",
)
def timespan_in_units(spark, sf):
    return _spans(spark, sf).select(
        "event_id", types.to_timespan_literal(F.col("unit_form"), "h").alias("hours"),
        types.to_timespan_literal(F.col("clock_form"), "d").alias("days"),
    )


@query(
    "casts_and_case",
    """SELECT event_id, CAST(trunc(value) AS INTEGER) AS whole, lower(CAST(value > 50 AS VARCHAR)) AS large,
              CAST(NULL AS INTEGER) AS not_a_number FROM events""",
)
def casts_and_case(spark, sf):
    return load(spark, sf, "events").select(
        "event_id", scalars.to_int(F.col("value")).alias("whole"), scalars.to_lower(F.col("value") > 50).alias("large"),
        scalars.to_int(F.col("event_type")).alias("not_a_number"),
    )


@query(
    "parse_json_text",
    """SELECT doc_id, json_valid(text) AS is_json, CAST(json_extract_string(j, '$.chars') AS BIGINT) AS chars
       FROM (SELECT *, '{"chars":' || CAST(n_chars AS VARCHAR) || ',"lang":"' || lang || '"}' AS j FROM documents)""",
)
def parse_json_text(spark, sf):
    j = F.concat(F.lit('{"chars":'), F.col("n_chars").cast("string"), F.lit(',"lang":"'), "lang", F.lit('"}'))
    docs = load(spark, sf, "documents").withColumn("doc", scalars.parse_dynamic(j))
    return docs.select(
        "doc_id", scalars.parse_dynamic(F.col("text")).isNotNull().alias("is_json"),
        scalars.member(F.col("doc"), "chars", "bigint").alias("chars"),
    )


NAMES_SQL = """SELECT c_custkey, c_name, replace(c_name, '#', '-') AS hyphened, '[''' || c_name || ''']' AS quoted,
                      'k:long,[''' || c_name || ''']:string,[''version'']:int' AS declared FROM customer"""


@query(
    "quote_names",
    f"""SELECT c_custkey, c_name AS plain, '[''' || hyphened || ''']' AS hyphened, '[' || hyphened AS bracketed, c_name AS unquoted,
               'k:long,' || c_name || ':string,version:int' AS declared FROM ({NAMES_SQL})""",
)
def quote_names(spark, sf):
    name = F.col("c_name")
    hyphened = F.replace(name, F.lit("#"), F.lit("-"))
    quoted = F.concat(F.lit("['"), name, F.lit("']"))
    declared = F.concat(F.lit("k:long,"), quoted, F.lit(":string,['version']:int"))
    return load(spark, sf, "customer").select(
        "c_custkey", scalars.quote_name(name).alias("plain"), scalars.quote_name(hyphened).alias("hyphened"),
        scalars.quote_name(F.concat(F.lit("["), hyphened)).alias("bracketed"),
        scalars.unquote_name(quoted).alias("unquoted"), scalars.unquote_schema(declared).alias("declared"),
    )


@query("fingerprints", "SELECT c_custkey, md5(c_name || chr(31) || c_mktsegment || chr(31) || CAST(c_nationkey AS VARCHAR)) AS print FROM customer")
def fingerprints(spark, sf):
    return load(spark, sf, "customer").select(
        "c_custkey", scalars.fingerprint(F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey")).alias("print")
    )


def _as_uuid(column):
    """A UUID made from the digits of an MD5."""
    h = F.md5(column.cast("string"))
    return F.concat_ws("-", *[F.substring(h, F.lit(a), F.lit(n)) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


UUID_SQL = "(md5({c})[1:8] || '-' || md5({c})[9:12] || '-' || md5({c})[13:16] || '-' || md5({c})[17:20] || '-' || md5({c})[21:32])"


@query(
    "friendly_names",
    f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN c_name
                                WHEN c_mktsegment = 'BUILDING' THEN {UUID_SQL.format(c='CAST(o_custkey AS VARCHAR)')} ELSE c_name END AS buyer
        FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def friendly_names(spark, sf):
    """Buyers known by id get their name; open orders carry the name already and
    customers in building have none on record."""
    customer = load(spark, sf, "customer")
    raw = load(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "O", F.col("c_name")).otherwise(F.upper(_as_uuid(F.col("o_custkey")))).alias("buyer_id")
    )
    names = customer.select(
        _as_uuid(F.col("c_custkey")).alias("id"), F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_name")).alias("name")
    )
    named = scalars.with_friendly_name(raw, "buyer_id", names, "buyer")
    return named.select("o_orderkey", F.when(scalars.is_uuid(F.col("buyer")), F.lower("buyer")).otherwise(F.col("buyer")).alias("buyer"))


# -- joins of the lifecycle ------------------------------------------------
@query("existing_references", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def existing_references(spark, sf):
    return drift.existing(load(spark, sf, "documents").select("doc_id", "lang"), load(spark, sf, "labels"), ["doc_id"])


@query("missing_references", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_references(spark, sf):
    return drift.missing(load(spark, sf, "documents").select("doc_id", "lang"), load(spark, sf, "labels"), ["doc_id"])


PRINCIPAL_SQL = """WITH directory AS (
         SELECT c_custkey AS entry_id,
                CASE WHEN c_mktsegment = 'BUILDING' THEN 'User=' || c_name WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE 'user=' || md5(c_name) || ';tenant' END AS fqn,
                c_name || ' (upn: U' || CAST(c_custkey AS VARCHAR) || '@example.com)' AS display_name,
                CASE WHEN c_nationkey < 12 THEN 'Table Admin' ELSE 'Table Ingestor' END AS role FROM customer),
       requests AS (
         SELECT s_suppkey, CASE WHEN s_nationkey < 8 THEN 'user=u' || CAST(s_suppkey AS VARCHAR) || '@example.com'
                                WHEN s_nationkey < 12 THEN 'USER=Customer#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0')
                                WHEN s_nationkey < 16 THEN md5('Customer#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0'))
                                WHEN s_nationkey < 20 THEN 'group:user=customer#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || ';more'
                                WHEN s_nationkey < 22 THEN ''
                                ELSE 'app=nobody' END AS principal,
                CASE WHEN s_suppkey < 50 THEN 'admins' ELSE 'ingestors' END AS role FROM supplier)
       SELECT s_suppkey, min(entry_id) AS entry_id FROM requests LEFT JOIN directory ON requests.principal <> ''
          AND directory.role LIKE '%' || CASE requests.role WHEN 'admins' THEN 'Admin' ELSE 'Ingestor' END
          AND (contains(lower(fqn), lower(principal)) OR (fqn <> '' AND contains(lower(principal), lower(fqn)))
               OR (contains(principal, '=') AND principal[instr(principal, '=') + 1:] <> ''
                   AND contains(lower(display_name), lower(principal[instr(principal, '=') + 1:]))))
       GROUP BY s_suppkey"""


def _principals(spark, sf):
    digits = F.lpad(F.col("s_suppkey").cast("string"), 9, "0")
    nation = F.col("s_nationkey")
    requests = load(spark, sf, "supplier").select(
        "s_suppkey",
        F.when(nation < 8, F.concat(F.lit("user=u"), F.col("s_suppkey").cast("string"), F.lit("@example.com")))
        .when(nation < 12, F.concat(F.lit("USER=Customer#"), digits))
        .when(nation < 16, F.md5(F.concat(F.lit("Customer#"), digits)))
        .when(nation < 20, F.concat(F.lit("group:user=customer#"), digits, F.lit(";more")))
        .when(nation < 22, "")
        .otherwise("app=nobody")
        .alias("principal"),
        F.when(F.col("s_suppkey") < 50, "admins").otherwise("ingestors").alias("role"),
    )
    segment = F.col("c_mktsegment")
    directory = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("entry_id"),
        F.when(segment == "BUILDING", F.concat(F.lit("User="), "c_name"))
        .when(segment == "MACHINERY", "")
        .otherwise(F.concat(F.lit("user="), F.md5("c_name"), F.lit(";tenant")))
        .alias("fqn"),
        F.concat("c_name", F.lit(" (upn: U"), F.col("c_custkey").cast("string"), F.lit("@example.com)")).alias("display_name"),
        F.when(F.col("c_nationkey") < 12, "Table Admin").otherwise("Table Ingestor").alias("role"),
    )
    return requests, directory


@query("principal_match", PRINCIPAL_SQL)
def principal_match(spark, sf):
    return security.match_principals(*_principals(spark, sf)).select("s_suppkey", "entry_id")


@query(
    "principal_details",
    f"""SELECT s_suppkey, CASE WHEN c_custkey IS NULL THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 'User=' || c_name WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE 'user=' || md5(c_name) || ';tenant' END AS fqn,
           CASE WHEN c_custkey IS NULL THEN NULL WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Application' ELSE 'User' END AS principal_type,
           c_name || ' (upn: U' || CAST(c_custkey AS VARCHAR) || '@example.com)' AS display_name, 'in ' || c_mktsegment AS notes
        FROM ({PRINCIPAL_SQL}) m LEFT JOIN customer ON c_custkey = entry_id""",
)
def principal_details(spark, sf):
    """The same matches with the type, the names and the notes of the entry."""
    requests, directory = _principals(spark, sf)
    customers = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("entry_id"), F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Application").otherwise("User").alias("principal_type"),
        F.concat(F.lit("in "), "c_mktsegment").alias("notes"),
    )
    matches = security.match_principals(requests, directory).select("s_suppkey", "entry_id")
    detailed = security.with_principal_details(matches, directory.join(customers, "entry_id"))
    return detailed.select("s_suppkey", "fqn", "principal_type", "display_name", "notes")


@query(
    "group_members",
    """SELECT event_id, user_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def group_members(spark, sf):
    members = load(spark, sf, "customer").select(F.col("c_mktsegment").alias("group_name"), F.col("c_custkey").alias("principal"))
    return security.is_member(load(spark, sf, "events").select("event_id", "user_id"), members, "user_id", "BUILDING")


@query("lookup_with_default", "SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'default') AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def lookup_with_default(spark, sf):
    names = load(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    return drift.lookup(load(spark, sf, "documents").select("doc_id"), names, "doc_id", "quality", "default", "quality")


# -- drift -----------------------------------------------------------------
DRIFT_SQL = """WITH d AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'),
     a AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus,
                  CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
                  replace(o_orderpriority, 'NOT', 'NOT  ') AS o_orderpriority
           FROM orders WHERE o_orderpriority <> '1-URGENT')
     SELECT coalesce(d.o_orderkey, a.o_orderkey) AS o_orderkey,
            CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN d.o_orderkey IS NULL THEN 'removed'
                 WHEN a.o_orderstatus <> d.o_orderstatus OR a.o_totalprice <> d.o_totalprice THEN 'changed' ELSE 'unchanged' END AS change,
            CASE WHEN a.o_orderkey IS NULL OR d.o_orderkey IS NULL THEN ''
                 ELSE concat_ws(',', CASE WHEN a.o_orderstatus <> d.o_orderstatus THEN 'o_orderstatus' END,
                                CASE WHEN a.o_totalprice <> d.o_totalprice THEN 'o_totalprice' END) END AS changed_columns
     FROM d FULL OUTER JOIN a ON d.o_orderkey = a.o_orderkey"""


@query("drift", DRIFT_SQL)
def drift_of_orders(spark, sf):
    """Orders against a copy with rows missing, added and changed; runs of spaces
    in the priority are no change."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    priority = F.col("o_orderpriority")
    actual = orders.where(priority != "1-URGENT").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "O").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(priority == "2-HIGH", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.replace(priority, F.lit("NOT"), F.lit("NOT  ")).alias("o_orderpriority"),
    )
    compare = {"o_orderstatus": drift.exact, "o_totalprice": drift.exact, "o_orderpriority": normalise.same_text}
    return drift.diff(orders.where(priority != "5-LOW"), actual, ["o_orderkey"], compare)


@query(
    "normalised_values",
    """SELECT c_custkey, true AS name, c_mktsegment <> 'BUILDING' AS text_, c_nationkey < 10 AS json_,
              c_acctbal < 5000 AS number_, false AS no_number, false AS spaced_number, c_nationkey < 10 AS number_in_json, c_nationkey >= 5 AS principal, c_mktsegment <> 'FURNITURE' AS timespan, true AS kind
       FROM customer""",
)
def normalised_values(spark, sf):
    c, name, nation = load(spark, sf, "customer"), F.col("c_name"), F.col("c_nationkey")
    quoted = F.concat(F.lit("['"), name, F.lit("']:int"))
    spaced = F.concat(F.lit("  "), name, F.lit(" \n\t "), F.when(F.col("c_mktsegment") == "BUILDING", "other").otherwise(F.col("c_mktsegment")))
    one = F.concat(F.lit('{"b": [1, 2], "a": '), nation.cast("string"), F.lit("}"))
    two = F.concat(F.lit('{"a":'), F.when(nation < 10, nation).otherwise(nation + 1).cast("string"), F.lit(',"b":[1,2]}'))
    balance = F.when(F.col("c_acctbal") < 5000, F.col("c_acctbal")).otherwise(F.col("c_acctbal") + 1)
    hours = F.when(F.col("c_mktsegment") == "FURNITURE", "49h").otherwise("1.23:59:59")
    return c.select(
        "c_custkey",
        normalise.same_name(quoted, F.concat(name, F.lit(":int"))).alias("name"),
        normalise.same_text(spaced, F.concat_ws(" ", name, "c_mktsegment")).alias("text_"),
        normalise.same_json(one, two).alias("json_"),
        normalise.same_number(F.col("c_acctbal").cast("string"), F.concat(balance.cast("string"), F.lit("e0"))).alias("number_"),
        normalise.same_number(name, name).alias("no_number"),
        normalise.same_number(F.col("c_acctbal").cast("string"), F.concat(F.lit(" "), F.col("c_acctbal").cast("string"))).alias("spaced_number"),
        normalise.same_json(one, F.replace(two, F.lit(",\"b\""), F.lit("e0,\"b\""))).alias("number_in_json"),
        normalise.same_principal_kind(
            F.concat(F.lit("USER="), name), F.when(nation >= 5, F.concat(F.lit("user="), F.md5("c_name"))).otherwise("app=x")
        ).alias("principal"),
        normalise.same_timespan(F.lit("1d"), hours, "d").alias("timespan"),
        normalise.same_kind(F.lit("ORC"), F.lit("orc")).alias("kind"),
    )


@query(
    "json_subset",
    """SELECT o_orderkey, o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_orderpriority <> '2-HIGH') AS same,
              o_orderstatus = 'F' OR o_orderkey = 0 AS same_deep FROM orders""",
)
def json_subset(spark, sf):
    """Old and new policy text per order: F adds members on one side, O on the
    other (2-HIGH with a changed array), P changes a nested value. Deep documents
    write the key as an exponent number, after another value of the same name."""
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    old = F.when(
        status == "F", F.concat(F.lit('{"a":{"x":'), key, F.lit('},"b":[1,2]}'))
    ).when(status == "O", F.concat(F.lit('{ "b":[1,2], "a":{"y":{"z":"{"}, "x":'), key, F.lit('}}'))).otherwise(
        F.concat(F.lit('{"a":{"x":'), key, F.lit('}}'))
    )
    new = F.when(
        status == "F", F.concat(F.lit('{"b":[1,2],"c":null,"a":{"x":'), key, F.lit(',"w":{}}}'))
    ).when(
        status == "O",
        F.concat(F.lit('{"a":{"x":'), key, F.lit('},"b":'), F.when(F.col("o_orderpriority") == "2-HIGH", "[2,1]").otherwise("[1,2]"), F.lit("}")),
    ).otherwise(F.concat(F.lit('{"a":{"x":'), key, F.lit('.5,"w":1}}')))
    orders = load(spark, sf, "orders").repartition(spark.sparkContext.defaultParallelism)  # one file
    pairs = orders.select("o_orderkey", "o_orderstatus", old.alias("old"), new.alias("new"))
    deep = [F.concat(F.lit('{"a":' * 60), inner, F.lit("}" * 60)) for inner in (
        F.concat(F.lit('{"k":'), key, F.lit(".0}")), F.concat(F.lit('{"k":null,"k":'), key, F.when(status == "F", "e0}").otherwise("e1}")),
    )]
    pairs = pairs.withColumns({"deep_old": deep[0], "deep_new": deep[1]})
    both = normalise.json_subset(normalise.json_subset(pairs, "old", "new"), "deep_old", "deep_new", "same_deep")
    return both.select("o_orderkey", "same", "same_deep")

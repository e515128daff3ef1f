"""P1-P4, R1, K6-K8."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from changeflow import fixtures as X
from changeflow.functions.parsing import declared_json
from changeflow.operators import shaping as P
from changeflow.operators.routing import route_by_field as route
from changeflow.registry import query
from changeflow.registry.decoding import EVENTS_SQL, MONEY_SQL, order_changes
from changeflow.session import materialize, tasks_by_rows
from changeflow.sinks import search
from changeflow.sources.declared import USER_TRANSACTION

WIDE_SQL = """
    msg AS (SELECT 'id-' || o_orderkey AS uuid, c_custkey AS "customerId",
        CAST(trunc(o_totalprice) AS BIGINT) AS "transactionAmount", '10.0.0.' || (c_custkey % 256) AS "sourceIp",
        o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "transactionTime", c_name AS user_name,
        '+1' || c_custkey AS phone_number, CAST(o_orderkey % 1000 AS INTEGER) AS product_id,
        'p' || (o_orderkey % 1000) AS product_name, o_orderpriority AS product_type,
        CAST(20200101 + o_orderkey % 28 AS INTEGER) AS manufacturing_date, o_totalprice AS price,
        CAST(o_orderkey % 10 AS DOUBLE) AS unit, 'u' || c_custkey || '@example.com' AS email,
        c_custkey || ' Main St' AS address, 'city' || c_nationkey AS city, CAST(c_nationkey AS VARCHAR) AS country,
        '10.1.0.' || (c_custkey % 256) AS ip_address, 'https://example.com' AS website, 'ACME' AS company_name,
        c_mktsegment AS department, c_acctbal AS salary, CAST(18 + c_custkey % 60 AS INTEGER) AS age,
        CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, '2024-01-01' AS created_date,
        CASE WHEN c_custkey % 5 <> 0 THEN '2024-02-02' END AS last_login, CAST(c_custkey % 100 AS INTEGER) AS score,
        'id-' || o_orderkey || '_' || CAST(epoch(o_orderdate) * 1000 AS BIGINT) AS rowkey
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0)"""


def messages(spark, sf_dir):
    """Wide messages read leniently: a broken text is an all-null row."""
    return declared_json(X.wide_messages(spark, sf_dir), USER_TRANSACTION, on_error="null")


def event_time():
    return F.to_timestamp_ntz("transactionTime", F.lit("yyyy-MM-dd HH:mm:ss"))


@query("positional_project", """
    SELECT user_id AS customer, value AS amount, event_type AS state, ts AS "PtransactionTime" FROM events""")
def positional_project(spark, sf_dir):
    """Columns enter a sink by position."""
    rows = X.read(spark, sf_dir, "events").select("user_id", "value", "event_type", F.col("ts").alias("transactionTime"))
    sink = T.StructType.fromDDL("customer BIGINT, amount DOUBLE, state STRING, PtransactionTime TIMESTAMP_NTZ")
    return P.positional_project(rows, sink)


@query("drop_unparsed", f"WITH {WIDE_SQL} SELECT * EXCLUDE (rowkey) FROM msg")
def drop_unparsed(spark, sf_dir):
    """Rows without a key, among them broken texts, are dropped."""
    return messages(spark, sf_dir).where("uuid IS NOT NULL")


@query("row_key", f"WITH {WIDE_SQL} SELECT uuid, rowkey FROM msg")
def row_key(spark, sf_dir):
    """Key and event time."""
    return messages(spark, sf_dir).where("uuid IS NOT NULL").select("uuid", P.row_key("uuid", event_time()).alias("rowkey"))


@query("column_families", f"WITH {WIDE_SQL} SELECT rowkey, " + ", ".join(
    f'"{m}" AS "{family}_{m}"' for family, members in P.FAMILIES.items() for m in members) + " FROM msg")
def column_families(spark, sf_dir):
    """27 columns in four families, flattened for comparison."""
    rows = P.column_families(messages(spark, sf_dir), "uuid", event_time())
    return rows.select("rowkey", *[
        F.col(f"{family}.{m}").alias(f"{family}_{m}") for family, members in P.FAMILIES.items() for m in members])


@query("wide_column_cells", f"WITH {WIDE_SQL}, cells AS (" + " UNION ALL ".join(
    f"SELECT rowkey, '{family}' AS family, '{m}' AS qualifier, CAST(\"{m}\" AS VARCHAR) AS value FROM msg"
    for family, members in P.FAMILIES.items() for m in members) + """)
    SELECT family, qualifier, count(*) AS n, count(DISTINCT value) AS n_values, min(value) AS low, max(value) AS high
    FROM cells WHERE value IS NOT NULL GROUP BY ALL""")
def wide_column_cells(spark, sf_dir):
    """K8: a digest of all cells. A message is 27 cells, which are sorted in the tasks."""
    with tasks_by_rows(spark, X.read(spark, sf_dir, "orders").count()):
        cells = P.wide_column_cells(P.column_families(messages(spark, sf_dir), "uuid", event_time()))
        return materialize(cells.groupBy("family", "qualifier").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("value").alias("n_values"),
            F.min("value").alias("low"), F.max("value").alias("high")), "cells")


@query("route_by_field", """
    SELECT CASE event_id % 10 WHEN 0 THEN 'other' WHEN 1 THEN 'other' WHEN 2 THEN 'other' WHEN 4 THEN 'other'
                ELSE event_type END AS table_name,
           count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY 1""")
def route_by_field(spark, sf_dir):
    """Blank, numeric, null or missing routing values take the fixed table."""
    i = F.col("event_id") % 10
    name = (F.when(i == 0, F.lit('"  "')).when(i == 1, F.col("user_id").cast("string")).when(i == 2, F.lit("null"))
            .when(i == 3, F.concat(F.lit('"  '), "event_type", F.lit(' "')))
            .otherwise(F.concat(F.lit('"'), "event_type", F.lit('"'))))
    field = F.when(i == 4, F.lit("")).otherwise(F.concat(F.lit(',"event_type":'), name))
    rows = X.read(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), field, F.lit("}")).alias("value"))
    return route(rows, "event_type", "other").groupBy(F.col("_table").alias("table_name")).agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


ACTIONS_SQL = f"""{EVENTS_SQL},
    last AS (SELECT *, k % 7 = 0 AS gone, CASE WHEN k % 3 = 0 THEN 'U' ELSE s END AS s1,
                    {MONEY_SQL.format('CASE WHEN k % 3 = 0 THEN c + 100 ELSE c END')} AS p1 FROM o),
    act AS (SELECT k, CASE WHEN gone THEN 'delete' ELSE 'index' END AS op, CAST(k AS VARCHAR) AS id,
                   CASE WHEN NOT gone THEN '{{"o_orderkey":' || k || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || s1
                        || '","o_totalprice":' || p1 || ',"o_orderdate":"' || strftime(d, '%Y-%m-%dT%H:%M:%S.000000') || '"}}' END AS doc
            FROM last)"""


@query("bulk_actions", f"""
    WITH {ACTIONS_SQL}
    SELECT op, id, doc FROM act
    UNION ALL SELECT 'create', NULL, '{{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","user_id":' || user_id
        || ',"event_type":"' || event_type || '","value":' || value || ',"props":"' || replace(props, '"', '\\"') || '"}}' FROM events""")
def bulk_actions(spark, sf_dir):
    """Keyed changes as index/delete, key-less rows as create."""
    keyed = search.bulk_actions(order_changes(spark, sf_dir), ["o_orderkey"])
    plain = search.bulk_actions(X.read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props"), None)
    return keyed.unionByName(plain).select(F.col("_op").alias("op"), F.col("_id").alias("id"), "doc")


@query("bulk_batches", f"""
    WITH {ACTIONS_SQL},
    lines AS (SELECT k, k // 4000 AS shard, '{{"' || op || '":{{"_index":"orders","_id":"' || id || '"}}}}' || chr(10)
                     || coalesce(doc || chr(10), '') AS line FROM act),
    run AS (SELECT *, octet_length(encode(line)) AS b, row_number() OVER w - 1 AS rn,
                   coalesce(sum(octet_length(encode(line))) OVER (PARTITION BY shard ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS size
            FROM lines WINDOW w AS (PARTITION BY shard ORDER BY k))
    SELECT shard, rn // 1000 AS row_band, CAST(size // 60000 AS BIGINT) AS size_band, count(*) AS n_actions,
           CAST(sum(b) AS BIGINT) AS n_bytes, md5(string_agg(line, '' ORDER BY k)) AS body_md5 FROM run GROUP BY ALL""")
def bulk_batches(spark, sf_dir):
    """K6: request bodies of at most 1000 actions, cut at 60 kB."""
    actions = search.bulk_actions(order_changes(spark, sf_dir), ["o_orderkey"]) \
        .withColumn("_k", F.col("_id").cast("bigint"))
    batches = search.bulk_batches(search.bulk_lines(actions, "orders"), F.call_function("div", "_k", F.lit(4000)), ["_k"], max_bytes=60000)
    return batches.select("shard", "row_band", "size_band", "n_actions", "n_bytes", F.md5("body").alias("body_md5"))


@query("packed_requests", f"""
    WITH {ACTIONS_SQL}
    SELECT op, id, octet_length(encode(coalesce(doc, ''))) AS n_bytes, md5(doc) AS doc_md5, true AS within_limits FROM act""")
def packed_requests(spark, sf_dir):
    """K6: actions packed into requests in the tasks that have them, and taken out of the requests again."""
    actions = search.bulk_actions(order_changes(spark, sf_dir), ["o_orderkey"])
    requests = search.pack_requests(search.bulk_lines(actions, "orders"), max_actions=100, max_bytes=20000)
    within = (F.col("n_actions") <= 100) & (F.col("n_bytes") <= 20000) & (F.octet_length("body") == F.col("n_bytes"))
    # An action begins with its head; a document line follows unless it is a delete.
    head = r'(?m)^(?=\{"(?:index|create|delete)":\{"_index")'
    each = requests.select(within.alias("within_limits"), F.explode(F.filter(F.split("body", head), lambda a: a != "")).alias("action"))
    line = F.split("action", "\n", 2)
    doc = F.nullif(F.rtrim(F.regexp_replace(line[1], "\n$", "")), F.lit(""))
    name = F.get_json_object(line[0], "$.index._id")
    return each.select(
        F.regexp_extract(line[0], '^\\{"(\\w+)"', 1).alias("op"), F.coalesce(name, F.get_json_object(line[0], "$.delete._id")).alias("id"),
        F.octet_length(F.coalesce(doc, F.lit(""))).cast("long").alias("n_bytes"), F.md5(doc).alias("doc_md5"), "within_limits")

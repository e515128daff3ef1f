"""C1-C8."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow import fixtures as X
from changeflow.functions.parsing import open_envelope
from changeflow.operators import changelog as C, schemas as S
from changeflow.registry import query


def two_tables(spark, sf_dir):
    both = X.order_events(spark, sf_dir).select("value").unionByName(X.customer_events(spark, sf_dir).select("value"))
    return C.data_events(open_envelope(both, with_schema=True))


@query("schema_from_events", """
    SELECT * FROM (VALUES
      ('orders', 0, 'o_orderkey', 'bigint', false), ('orders', 1, 'o_custkey', 'bigint', true),
      ('orders', 2, 'o_orderstatus', 'string', true), ('orders', 3, 'o_totalprice', 'decimal(15,2)', true),
      ('orders', 4, 'o_orderdate', 'timestamp_ntz', true),
      ('customer', 0, 'c_custkey', 'bigint', false), ('customer', 1, 'c_name', 'string', true),
      ('customer', 2, 'c_acctbal', 'decimal(12,2)', true)) AS t(table_name, pos, column_name, data_type, nullable)""")
def schema_from_events(spark, sf_dir):
    """The columns declared by the schema blocks of all events."""
    return S.schema_from_events(two_tables(spark, sf_dir)).select(
        F.col("_table").alias("table_name"), "pos", "column_name", "data_type", "nullable")


@query("key_from_not_null", """
    SELECT * FROM (VALUES ('orders', 'o_orderkey'), ('customer', 'c_custkey')) AS t(table_name, column_name)""")
def key_from_not_null(spark, sf_dir):
    """The NOT NULL columns of each table."""
    return S.key_report(two_tables(spark, sf_dir)).select(F.col("_table").alias("table_name"), "column_name")


@query("infer_schema", """
    WITH f(column_name, data_type) AS (VALUES
      ('event_type', 'string'), ('user_id', 'int'), ('value', 'double'), ('props', 'string'), ('big', 'bigint'),
      ('flag', 'boolean'), ('tm', 'string'), ('nothing', 'string'), ('extra', 'int'))
    SELECT event_type AS table_name, column_name, data_type,
           count(*) FILTER (WHERE column_name <> 'extra' OR event_id % 2 = 1) AS n_values
    FROM events, f GROUP BY ALL""")
def infer_schema(spark, sf_dir):
    """Types per routed table, from all values."""
    from changeflow.operators.routing import route_by_field
    routed = route_by_field(X.game_events(spark, sf_dir), "event_type", "other")
    return S.infer_schema(routed).withColumnRenamed("_table", "table_name")


DECLARED = ("event_type:string, user_id:INT, value:decimal(10,2), big:long, flag:boolean, tm:timestamp, "
            "props:unknown, absent:date")


@query("declared_schema_string", """
    SELECT event_type, CAST(user_id AS INTEGER) AS user_id,
           CAST(CASE WHEN event_id % 3 = 0 THEN floor(value) ELSE value END AS DECIMAL(10,2)) AS value,
           event_id + 3000000000 AS big, event_id % 2 = 0 AS flag, date_trunc('second', ts) AS tm,
           replace(props, ' ', '') AS props, CAST(NULL AS DATE) AS absent FROM events""")
def declared_schema_string(spark, sf_dir):
    """C4: schema-less JSON read by a compact schema string."""
    return S.read_json_rows(X.game_events(spark, sf_dir), S.parse_schema_string(DECLARED))


@query("schema_evolution_add_column", """
    SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 THEN 'u' || user_id || '@example.com' END AS email FROM events""")
def schema_evolution_add_column(spark, sf_dir):
    """Rows written before a column existed read NULL there."""
    e = X.read(spark, sf_dir, "events")
    old = e.where(F.col("event_id") % 2 == 0).select("event_id", "user_id")
    new = e.where(F.col("event_id") % 2 == 1).select(
        "event_id", "user_id", F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email"))
    merged = S.evolve(old.schema, new.schema)
    return S.conform(old, merged).unionByName(S.conform(new, merged))


@query("schema_evolution_widen", """
    SELECT event_id, CAST(CASE WHEN event_id % 2 = 0 THEN user_id ELSE user_id + 3000000000 END AS BIGINT) AS user_id,
           CASE WHEN event_id % 2 = 0 THEN CAST(CAST(value AS FLOAT) AS DOUBLE) ELSE value END AS value FROM events""")
def schema_evolution_widen(spark, sf_dir):
    """Int -> bigint and float -> double."""
    e = X.read(spark, sf_dir, "events")
    old = e.where(F.col("event_id") % 2 == 0).select(
        "event_id", F.col("user_id").cast("int").alias("user_id"), F.col("value").cast("float").alias("value"))
    new = e.where(F.col("event_id") % 2 == 1).select("event_id", (F.col("user_id") + 3000000000).alias("user_id"), "value")
    merged = S.evolve(old.schema, new.schema)
    return S.conform(old, merged).unionByName(S.conform(new, merged))


@query("schema_versions", """
    WITH r AS (SELECT o_orderpriority AS table_name, o_orderdate, o_orderkey,
                      CASE WHEN month(o_orderdate) <= 6 THEN 'A' ELSE 'B' END AS schema FROM orders),
    l AS (SELECT *, lag(schema) OVER (PARTITION BY table_name ORDER BY o_orderdate, o_orderkey) AS prev FROM r)
    SELECT table_name, o_orderkey, schema FROM l WHERE prev IS NULL OR prev <> schema""")
def schema_versions(spark, sf_dir):
    """Every change of a table's schema text."""
    rows = X.read(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("_table"), F.struct("o_orderdate", "o_orderkey").alias("_order"),
        F.when(F.month("o_orderdate") <= 6, "A").otherwise("B").alias("schema"))
    return S.schema_versions(rows).select(F.col("_table").alias("table_name"), "_order.o_orderkey", "schema")


@query("partition_by_hour", """
    SELECT date_trunc('hour', ts) AS tm_hour, count(*) AS n FROM events GROUP BY 1""")
def partition_by_hour(spark, sf_dir):
    """The hour column of tables that declare ``tm`` as a timestamp."""
    schema = S.parse_schema_string(DECLARED)
    rows = S.with_hour(S.read_json_rows(X.game_events(spark, sf_dir), schema), S.partition_column(schema))
    return rows.groupBy("tm_hour").agg(F.count(F.lit(1)).alias("n"))

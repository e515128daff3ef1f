"""S13, S14, R3, K1, K3-K5."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from changeflow import fixtures as X
from changeflow.config import JobConfig
from changeflow.functions.accesslog import parse_access_log, split_access_log
from changeflow.operators import changelog as C
from changeflow.operators.schemas import table_specs
from changeflow.plans.tables import append_by_schema, json_to_tables, read_appended, table_path
from changeflow.registry import query
from changeflow.registry.decoding import EVENTS_SQL
from changeflow.registry.schemas import two_tables
from changeflow.session import materialize, scratch_dir
from changeflow.sinks import files, tables
from changeflow.sources.streams import as_kafka_rows, kafka_values, replay_stream
from changeflow.sources.tables import catalog_scan, time_slice
from changeflow.streaming.runner import finish


@query("catalog_scan_limit", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20")
def catalog_scan_limit(spark, sf_dir):
    """The first rows of a catalog table."""
    X.read(spark, sf_dir, "orders").createOrReplaceTempView("scanned_orders")
    return catalog_scan(spark, "scanned_orders", 20, order=["o_orderkey"])


def hourly_logs(spark, sf_dir):
    path = scratch_dir(spark, "logs")
    good, _ = split_access_log(parse_access_log(X.log_lines(spark, sf_dir)))
    files.write_hourly(good, path, "log_time")
    return spark.read.parquet(path)


LOGS_SQL = """
    SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
           CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n,
           CAST(sum(CASE WHEN event_id % 7 = 0 THEN 0 ELSE event_id END) AS BIGINT) AS bytes
    FROM events WHERE event_id % 103 <> 0 {} GROUP BY ALL"""


def log_summary(logs):
    return logs.groupBy("year", "month", "day", "hour").agg(
        F.count(F.lit(1)).alias("n"), F.sum("scbytes").alias("bytes"))


@query("hourly_partitions", LOGS_SQL.format(""))
def hourly_partitions(spark, sf_dir):
    """K3: parsed logs in hourly folders."""
    return log_summary(hourly_logs(spark, sf_dir))


@query("partitioned_log_scan", LOGS_SQL.format(
    "AND ts >= timestamp '2024-01-05 06:00:00' AND ts < timestamp '2024-01-12 18:00:00'"))
def partitioned_log_scan(spark, sf_dir):
    """A time range of hourly folders."""
    return log_summary(time_slice(hourly_logs(spark, sf_dir), "2024-01-05 06", "2024-01-12 18"))


@query("append_copy", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def append_copy(spark, sf_dir):
    """K1, K4: a table created by the first append and extended by the second."""
    events = X.read(spark, sf_dir, "events")
    table = f"copy_{uuid.uuid4().hex}"
    location = scratch_dir(spark, "copy")
    middle = events.agg(F.expr("div(max(event_id), 2)")).first()[0]
    for part in (events.where(F.col("event_id") <= middle), events.where(F.col("event_id") > middle)):
        files.append_table(part, table, location=location)
    return spark.table(table)


@query("rolled_files", "SELECT count(*) AS n_rows, true AS within_limit FROM events")
def rolled_files(spark, sf_dir):
    """K5: no file holds more than 2000 records."""
    path = scratch_dir(spark, "rolled")
    files.rolled_writer(X.read(spark, sf_dir, "events")).parquet(path)
    per_file = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 2000).alias("within_limit"))


EVOLVED_SQL = """
    SELECT CAST(event_id AS INTEGER) AS id, CASE WHEN event_id % 3 = 0 THEN user_id WHEN event_id % 6 = 1 THEN event_id + 3000000000
                                WHEN event_id % 3 = 1 THEN floor(value * 4) / 4 END::DOUBLE AS amount,
           CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS VARCHAR) WHEN event_id % 3 = 2 THEN event_type END AS tag,
           CASE WHEN event_id % 3 = 2 THEN CAST(event_id AS INTEGER) END AS "ID_2",
           CASE WHEN event_id % 3 = 2 THEN event_id % 2 = 0 END AS flag FROM events"""


@query("json_tables_evolving", EVOLVED_SQL)
def json_tables_evolving(spark, sf_dir):
    """The job on three runs of messages: integers; then long and fractional numbers; then new
    fields, one of them a name in other case, and text where numbers were."""
    e, i = X.read_spread(spark, sf_dir, "events"), F.col("event_id")
    quarter = F.when(i % 2 == 1, F.to_json(F.struct(i.alias("id"), (i + 3000000000).alias("amount")))).otherwise(
        F.to_json(F.struct(i.alias("id"), (F.floor(F.col("value") * 4) / 4).alias("amount"))))
    runs = (F.to_json(F.struct(i.alias("id"), F.col("user_id").alias("amount"), F.col("user_id").alias("tag"))), quarter,
            F.to_json(F.struct(i.alias("id"), i.alias("ID_"), F.col("event_type").alias("tag"), (i % 2 == 0).alias("flag"))))
    messages, state, root = (scratch_dir(spark, name) for name in ("messages", "messages-state", "warehouse"))
    config = JobConfig({"iceberg.warehouse": root, "iceberg.table": "evolving"})
    for step, text in enumerate(runs):
        text = F.replace(text, F.lit('"ID_"'), F.lit('"ID"'))
        as_kafka_rows(e.where(i % 3 == step).select(text.alias("value"))).write.mode("append").parquet(messages)
        finish(json_to_tables(kafka_values(replay_stream(spark, messages)), config, state))
    return read_appended(spark, table_path(config, "evolving")).drop("_batch")


@query("evolved_column_filter", f"SELECT id, tag, flag FROM ({EVOLVED_SQL}) WHERE flag IS NOT NULL")
def evolved_column_filter(spark, sf_dir):
    """The rows that have a value in a column which came with a later batch."""
    return json_tables_evolving(spark, sf_dir).where("flag IS NOT NULL").select("id", "tag", "flag")


@query("tables_by_layout", f"""
    WITH {EVENTS_SQL}
    SELECT 'orders' || k % 5 AS table_name, o_custkey AS key, count(*) AS n_rows, CAST(sum(CAST(CAST(c AS DECIMAL(17,0)) / 100 AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS amount
    FROM ev GROUP BY ALL
    UNION ALL SELECT 'customer', c_custkey, count(*), CAST(sum(CAST(CAST(round(c_acctbal * 100) AS DECIMAL(17,0)) / 100 AS DECIMAL(12,2))) AS DECIMAL(25,2))
    FROM customer GROUP BY ALL""")
def tables_by_layout(spark, sf_dir):
    """Six tables of two layouts, written by two writes."""
    events = two_tables(spark, sf_dir)
    key = F.get_json_object("_image", "$.o_orderkey").cast("bigint")
    spread = C.slim_events(events).withColumn("_table", F.when(F.col("_table") == "orders", F.concat(F.lit("orders"), (key % 5).cast("string"))).otherwise(F.col("_table")))
    paths = append_by_schema(materialize(spread, "events"), scratch_dir(spark, "layouts"), upsert=True)
    parts = []
    for name, path in paths.items():
        rows = spark.read.parquet(path)
        owner, amount = ("c_custkey", "c_acctbal") if name == "customer" else ("o_custkey", "o_totalprice")
        parts.append(rows.groupBy(F.col(owner).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(amount).cast("decimal(25,2)").alias("amount"))
                     .select(F.lit(name).alias("table_name"), "key", "n_rows", "amount"))
    return reduce(DataFrame.unionByName, parts)


@query("multi_table_counts", f"""
    WITH {EVENTS_SQL}
    SELECT 'orders' AS table_name, count(*) AS n_rows, CAST(5 AS INTEGER) AS n_columns,
           CAST(sum(CAST(CAST(c AS DECIMAL(17,0)) / 100 AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS amount FROM ev
    UNION ALL SELECT 'customer', count(*), 3,
           CAST(sum(CAST(CAST(round(c_acctbal * 100) AS DECIMAL(17,0)) / 100 AS DECIMAL(12,2))) AS DECIMAL(25,2)) FROM customer""")
def multi_table_counts(spark, sf_dir):
    """One mixed stream of events into a table each, with its own schema."""
    events = two_tables(spark, sf_dir)
    root = scratch_dir(spark, "many")

    def write(name, rows):
        C.project_images(C.changelog(rows), table_specs(rows)[name]).write.parquet(f"{root}/{name}")

    names = tables.per_table(C.slim_events(events), write)
    amounts = {"orders": "o_totalprice", "customer": "c_acctbal"}
    parts = []
    for name in names:
        rows = spark.read.parquet(f"{root}/{name}")
        columns = [c for c in rows.columns if not c.startswith("_")]
        parts.append(rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(amounts[name]).cast("decimal(25,2)").alias("amount"))
                     .select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(columns)).alias("n_columns"), "amount"))
    return parts[0].unionByName(parts[1])

"""S1, S5-S7, F1-F16, P5, P6."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow import fixtures as X
from changeflow.functions import accesslog, decode as D, parsing
from changeflow.operators import changelog as C
from changeflow.operators.routing import route_by_field
from changeflow.registry import query
from changeflow.session import scratch_dir
from changeflow.sources.streams import as_kafka_rows, kafka_values, replay_stream
from changeflow.streaming.runner import finish, run_files

# All change events of X4 with their decoded row images, in SQL over orders.
EVENTS_SQL = """
    o AS (SELECT o_orderkey AS k, o_custkey, o_orderstatus AS s, CAST(round(o_totalprice * 100) AS BIGINT) AS c,
                 o_orderdate AS d, epoch_ms(o_orderdate) AS t FROM orders),
    ev AS (
        SELECT k, 1 AS seq, CASE WHEN k % 5 = 0 THEN 'r' ELSE 'c' END AS op, o_custkey, s, c, d, t AS ts_ms,
               s AS old_s, c AS old_c FROM o
        UNION ALL SELECT k, 2, 'u', o_custkey, 'U', c + 100, d, t + 1000, s, c FROM o WHERE k % 3 = 0
        UNION ALL SELECT k, 3, 'd', o_custkey, CASE WHEN k % 3 = 0 THEN 'U' ELSE s END,
               CASE WHEN k % 3 = 0 THEN c + 100 ELSE c END, d, t + 2000, NULL, NULL FROM o WHERE k % 7 = 0)"""
KIND_SQL = "CASE op WHEN 'u' THEN '+U' WHEN 'd' THEN '-D' ELSE '+I' END"
MONEY_SQL = "CAST(CAST({} AS DECIMAL(17,0)) / 100 AS DECIMAL(15,2))"


@query("kafka_replay_values", "SELECT event_id || '|' || event_type AS value FROM events")
def kafka_replay_values(spark, sf_dir):
    """Recorded messages replayed as a text stream."""
    events = X.read(spark, sf_dir, "events")
    text = events.select(F.concat(F.col("event_id").cast("string"), F.lit("|"), "event_type").alias("value"))
    messages, out = scratch_dir(spark, "messages"), scratch_dir(spark, "values")
    as_kafka_rows(text).write.parquet(messages)
    stream = kafka_values(replay_stream(spark, messages)).select("value")
    finish(run_files(stream, out, scratch_dir(spark, "values-state")))
    return spark.read.parquet(out)


@query("json_declared_scan", """
    SELECT date_trunc('milliseconds', ts) AS ts, 'id-' || event_id AS uuid, event_type AS product_name,
           CAST(value AS FLOAT) AS price, CAST(event_id % 10 AS INTEGER) AS unit FROM events""")
def json_declared_scan(spark, sf_dir):
    """JSON of a declared schema with SQL-style timestamps."""
    row = F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"),
        F.concat(F.lit("id-"), F.col("event_id").cast("string")).alias("uuid"), F.col("event_type").alias("product_name"),
        F.col("value").cast("float").alias("price"), (F.col("event_id") % 10).alias("unit"), F.col("props").alias("unread"))
    text = X.read(spark, sf_dir, "events").select(F.to_json(row).alias("value"))
    return parsing.declared_json(
        text, "ts TIMESTAMP_NTZ, uuid STRING, product_name STRING, price FLOAT, unit INT",
        timestamp_format="yyyy-MM-dd HH:mm:ss[.SSS]")


def order_changes(spark, sf_dir, upsert=True):
    """The decoded changelog of the order events."""
    from changeflow.operators.schemas import ColumnSpec
    events = C.data_events(parsing.open_envelope(X.order_events(spark, sf_dir).select("value")))
    specs = [ColumnSpec(c["field"], c["type"], c.get("name"), c["optional"], c.get("parameters", {}))
             for c in X.ORDER_COLUMNS]
    return C.project_images(C.changelog(events, upsert), specs)


@query("debezium_scan", f"""
    WITH {EVENTS_SQL}
    SELECT {KIND_SQL} AS kind, ts_ms, k AS o_orderkey, o_custkey, s AS o_orderstatus,
           {MONEY_SQL.format('c')} AS o_totalprice, d AS o_orderdate FROM ev""")
def debezium_scan(spark, sf_dir):
    """Change events decoded to typed changelog rows."""
    return order_changes(spark, sf_dir).select(
        F.col("_kind").alias("kind"), F.col("_ts_ms").alias("ts_ms"), "o_orderkey", "o_custkey", "o_orderstatus",
        "o_totalprice", "o_orderdate")


@query("cdc_envelope_columns", f"""
    WITH {EVENTS_SQL}
    SELECT k, op, ts_ms, CAST(NULL AS VARCHAR) AS transaction, op IN ('c', 'r') AS no_before, op = 'd' AS no_after,
           '{{"db":"shop","table":"orders","ts_ms":' || ts_ms || ',"file":"log.000001","pos":' || seq || ',"row":0}}' AS source
    FROM ev""")
def cdc_envelope_columns(spark, sf_dir):
    """The raw event as six columns, objects as JSON text."""
    bare = parsing.unwrap(X.order_events(spark, sf_dir))
    cols = parsing.envelope_columns(bare)
    key = F.coalesce("after", "before")
    return cols.select(F.get_json_object(key, "$.o_orderkey").cast("bigint").alias("k"), "op", "ts_ms", "transaction",
                       F.col("before").isNull().alias("no_before"), F.col("after").isNull().alias("no_after"), "source")


@query("cdc_envelope_json_text", f"""
    WITH {EVENTS_SQL}
    SELECT '"' || op || '"' AS op, CAST(ts_ms AS VARCHAR) AS ts_ms, 'null' AS transaction,
           op IN ('c', 'r') AS no_before, op = 'd' AS no_after, count(*) AS n
    FROM ev GROUP BY ALL""")
def cdc_envelope_json_text(spark, sf_dir):
    """the same with every attribute as JSON text."""
    cols = parsing.envelope_columns(parsing.unwrap(X.order_events(spark, sf_dir)), flavour="json")
    return cols.groupBy("op", "ts_ms", "transaction", (F.col("before") == "null").alias("no_before"),
                        (F.col("after") == "null").alias("no_after")).agg(F.count(F.lit(1)).alias("n"))


@query("debezium_unwrap", f"""
    WITH {EVENTS_SQL} SELECT k, CAST(seq AS BIGINT) AS pos, op, ts_ms, 'orders' AS table_name FROM ev""")
def debezium_unwrap(spark, sf_dir):
    """wrapped and bare events opened alike."""
    opened = parsing.open_envelope(X.order_events(spark, sf_dir).select("k", "value"))
    return opened.select("k", "source.pos", "op", "ts_ms", F.col("source.table").alias("table_name"))


@query("non_data_events_dropped", f"""
    WITH {EVENTS_SQL} SELECT op, count(*) AS n FROM ev GROUP BY op""")
def non_data_events_dropped(spark, sf_dir):
    """P5: heartbeats, image-less events and broken texts leave no rows."""
    events = C.data_events(parsing.open_envelope(X.noisy_events(spark, sf_dir)))
    return events.groupBy("op").agg(F.count(F.lit(1)).alias("n"))


@query("non_object_dropped", f"""
    WITH {EVENTS_SQL},
    noise AS (SELECT CASE k % 4 WHEN 0 THEN 'none' ELSE 't' END AS op FROM o WHERE k % 4 < 2)
    SELECT op, count(*) AS n FROM (SELECT op FROM ev UNION ALL SELECT op FROM noise) GROUP BY op""")
def non_object_dropped(spark, sf_dir):
    """Arrays and broken texts are not records."""
    rows = route_by_field(X.noisy_events(spark, sf_dir), None, "all")
    opened = parsing.open_envelope(rows)
    return opened.groupBy(F.coalesce("op", F.lit("none")).alias("op")).agg(F.count(F.lit(1)).alias("n"))


@query("dead_letter_split", f"""
    WITH {EVENTS_SQL}
    SELECT 'good' AS outcome, (SELECT count(*) FROM ev) + (SELECT count(*) FROM o WHERE k % 4 < 2) AS n
    UNION ALL SELECT 'not an object', count(*) FROM o WHERE k % 4 = 2
    UNION ALL SELECT 'malformed', count(*) FROM o WHERE k % 4 = 3""")
def dead_letter_split(spark, sf_dir):
    """F16: parseable objects and dead letters with their reason, judged in one pass."""
    judged = parsing.with_error(X.noisy_events(spark, sf_dir))
    return judged.groupBy(F.coalesce("error", F.lit("good")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("base64_decode", "SELECT event_id, props AS decoded FROM events")
def base64_decode(spark, sf_dir):
    """base64 texts decoded, others kept."""
    e = X.read(spark, sf_dir, "events")
    coded = F.when(F.col("event_id") % 101 == 0, F.col("props")).otherwise(F.base64(F.col("props").cast("binary")))
    return e.select("event_id", accesslog.base64_or_self(coded).alias("decoded"))


NUMERIC_SQL = {
    "timestamp": "CAST(printf('%d.%03d', epoch_us(ts) // 1000000, epoch_us(ts) // 1000 % 1000) AS DOUBLE)",
    "timetofirstbyte": "CAST(CASE WHEN dash THEN 0 ELSE value END AS FLOAT)",
    "scstatus": "CAST(CASE WHEN dash THEN 0 ELSE 200 + event_id % 5 END AS INTEGER)",
    "scbytes": "CAST(CASE WHEN dash THEN 0 ELSE event_id END AS BIGINT)",
    "csbytes": "CAST(CASE WHEN dash THEN 0 ELSE user_id END AS BIGINT)",
    "timetaken": "CAST(CASE WHEN dash THEN 0 ELSE value END AS FLOAT)",
    "sccontentlen": "CAST(CASE WHEN dash THEN 0 ELSE event_id % 1000 END AS BIGINT)",
    "scrangestart": "CAST(0 AS BIGINT)",
    "scrangeend": "CAST(CASE WHEN dash THEN 0 ELSE event_id % 77 END AS BIGINT)",
    "cport": "CAST(CASE WHEN dash THEN 0 ELSE 1024 + event_id % 6000 END AS INTEGER)",
    "csheaderscount": "CAST(CASE WHEN dash THEN 0 ELSE event_id % 31 END AS INTEGER)",
    "csmethod": "upper(event_type)",
    "csurl": "'/item/' || user_id",
}
LOG_COLUMNS_SQL = ", ".join(
    NUMERIC_SQL.get(name, f"'f{i}-' || event_id") + f" AS {name}" for i, name in enumerate(accesslog.LOG_FIELDS))


@query("access_log_parse", f"""
    WITH e AS (SELECT *, event_id % 7 = 0 AS dash FROM events WHERE event_id % 103 <> 0)
    SELECT {LOG_COLUMNS_SQL}, date_trunc('milliseconds', ts) AS log_time FROM e""")
def access_log_parse(spark, sf_dir):
    """Log lines to typed records, all 41 columns; short lines become dead letters."""
    good, _ = accesslog.split_access_log(accesslog.parse_access_log(X.log_lines(spark, sf_dir)))
    return good


@query("access_log_dead_letters", """
    SELECT 'short line' AS error, count(*) AS n FROM events WHERE event_id % 103 = 0""")
def access_log_dead_letters(spark, sf_dir):
    """F16 for logs."""
    _, bad = accesslog.split_access_log(accesslog.parse_access_log(X.log_lines(spark, sf_dir)))
    return bad.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query("decode_decimal", """
    WITH c AS (SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer)
    SELECT c_custkey, CAST(CAST(cents AS DECIMAL(17,0)) / 100 AS DECIMAL(12,2)) AS from_bytes,
           CAST(CAST(cents AS DECIMAL(17,0)) / 100 AS DECIMAL(12,2)) AS from_text,
           CAST(CAST(cents AS DECIMAL(17,0)) / 1000 AS DECIMAL(12,3)) AS from_nested,
           CAST(round(CAST(cents AS DECIMAL(17,0)) / 100, 1) AS DECIMAL(12,1)) AS rounded,
           CASE WHEN abs(cents) < 100000 THEN CAST(CAST(cents AS DECIMAL(17,0)) / 100 AS DECIMAL(5,2)) END AS fitted
    FROM c""")
def decode_decimal(spark, sf_dir):
    """bytes, text and self-scaled decimals, rounded and fitted."""
    cents = X.cents("c_acctbal")
    coded = X.unscaled(cents)
    text = (cents.cast("decimal(17,0)") / 100).cast("decimal(17,2)").cast("string")
    nested = F.concat(F.lit('{"scale":3,"value":"'), coded, F.lit('"}'))
    return X.read(spark, sf_dir, "customer").select(
        "c_custkey", D.decode_decimal(coded, 12, 2, "base64").alias("from_bytes"),
        D.decode_decimal(text, 12, 2).alias("from_text"), D.decode_decimal(nested, 12, 3).alias("from_nested"),
        D.decode_decimal(text, 12, 1).alias("rounded"), D.decode_decimal(text, 5, 2).alias("fitted"))


@query("decode_timestamps", """
    SELECT event_id, date_trunc('milliseconds', ts) AS ms, ts AS us, ts AS ns, date_trunc('milliseconds', ts) AS unknown_ms,
           ts AS unknown_us, date_trunc('milliseconds', ts) AS iso_instant, date_trunc('milliseconds', ts) AS zoned,
           ts AS json_iso, date_trunc('second', ts) AS json_sql, date_trunc('milliseconds', ts) AS json_digits,
           (epoch_us(ts) // 1000 * 1000) % 86400000000 AS time_ms, epoch_us(ts) % 86400000000 AS time_us,
           epoch_us(ts) % 86400000000 AS time_ns
    FROM events""")
def decode_timestamps(spark, sf_dir):
    """The same instant in every wire form."""
    ts = F.col("ts").cast("timestamp")
    us, ms = F.unix_micros(ts), F.unix_millis(ts)
    text = lambda c: c.cast("string")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    day = F.lit(86_400_000_000).cast("bigint")
    prefix = "io.debezium.time."
    return X.read(spark, sf_dir, "events").select(
        "event_id",
        D.decode_timestamp(text(ms), prefix + "Timestamp").alias("ms"),
        D.decode_timestamp(text(us), prefix + "MicroTimestamp").alias("us"),
        D.decode_timestamp(text(us * 1000), prefix + "NanoTimestamp").alias("ns"),
        D.decode_timestamp(text(ms)).alias("unknown_ms"), D.decode_timestamp(text(us)).alias("unknown_us"),
        D.decode_timestamp(F.concat(iso, F.lit("Z"))).alias("iso_instant"),
        D.decode_timestamp(F.concat(iso, F.lit("Z")), prefix + "ZonedTimestamp").cast("timestamp_ntz").alias("zoned"),
        D.decode_json_timestamp(iso).alias("json_iso"),
        D.decode_json_timestamp(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).alias("json_sql"),
        D.decode_json_timestamp(text(ms)).alias("json_digits"),
        D.decode_time(text(F.pmod(ms, day / 1000).cast("bigint")), prefix + "Time").alias("time_ms"),
        D.decode_time(text(F.pmod(us, day)), prefix + "MicroTime").alias("time_us"),
        D.decode_time(text(F.pmod(us, day) * 1000), prefix + "NanoTime").alias("time_ns"))


@query("decode_dates", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS from_days, CAST(o_orderdate AS DATE) AS from_iso,
           CAST(NULL AS DATE) AS from_junk FROM orders""")
def decode_dates(spark, sf_dir):
    """epoch days and ISO dates."""
    day = F.col("o_orderdate").cast("date")
    return X.read(spark, sf_dir, "orders").select(
        "o_orderkey", D.decode_date(F.unix_date(day).cast("string")).alias("from_days"),
        D.decode_date(day.cast("string")).alias("from_iso"), D.decode_date("o_orderpriority").alias("from_junk"))


@query("lenient_coercions", """
    SELECT event_id, CAST(trunc(value) AS INTEGER) AS int_of_number, CAST(NULL AS INTEGER) AS int_of_text,
           CAST(0 AS INTEGER) AS zero_of_text, event_id AS long_value, CAST(value AS DOUBLE) AS double_value,
           event_id % 2 = 1 AS bool_of_int, event_id % 2 = 1 AS bool_of_text, CAST(NULL AS BOOLEAN) AS bool_of_junk,
           false AS false_of_junk, props AS text_value FROM events""")
def lenient_coercions(spark, sf_dir):
    """scalar readings that never fail."""
    num = X.money("value")
    odd = F.col("event_id") % 2
    return X.read(spark, sf_dir, "events").select(
        "event_id", D.coerce(num, "int").alias("int_of_number"), D.coerce("event_type", "int").alias("int_of_text"),
        D.coerce("event_type", "int", zero_on_bad=True).alias("zero_of_text"),
        D.coerce(F.col("event_id").cast("string"), "bigint").alias("long_value"), D.coerce(num, "double").alias("double_value"),
        D.coerce(odd.cast("string"), "boolean").alias("bool_of_int"),
        D.coerce(F.when(odd == 1, "true").otherwise("false"), "boolean").alias("bool_of_text"),
        D.coerce("event_type", "boolean").alias("bool_of_junk"),
        D.coerce("event_type", "boolean", zero_on_bad=True).alias("false_of_junk"), D.coerce("props", "string").alias("text_value"))


@query("decode_bytes", "SELECT event_id, hex(encode(props)) AS decoded, hex(encode(props)) AS raw_text FROM events")
def decode_bytes(spark, sf_dir):
    """base64 bytes, and a text's own bytes."""
    return X.read(spark, sf_dir, "events").select(
        "event_id", F.hex(D.decode_bytes(F.base64(F.col("props").cast("binary")))).alias("decoded"),
        F.hex(D.decode_bytes("props", raw_text=True)).alias("raw_text"))

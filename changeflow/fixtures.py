"""Change events, logs and messages derived from the test tables (FIXTURES.md).

Everything is computed by Spark from the tables it is given; nothing is stored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changeflow.functions.parsing import once

KEEP_NULLS = {"ignoreNullFields": "false"}
ORDER_COLUMNS = [
    {"field": "o_orderkey", "type": "int64", "optional": False},
    {"field": "o_custkey", "type": "int64", "optional": True},
    {"field": "o_orderstatus", "type": "string", "optional": True},
    {"field": "o_totalprice", "type": "bytes", "optional": True,
     "name": "org.apache.kafka.connect.data.Decimal",
     "parameters": {"scale": "2", "connect.decimal.precision": "15"}},
    {"field": "o_orderdate", "type": "int64", "optional": True, "name": "io.debezium.time.Timestamp"},
]
CUSTOMER_COLUMNS = [
    {"field": "c_custkey", "type": "int64", "optional": False},
    {"field": "c_name", "type": "string", "optional": True},
    {"field": "c_acctbal", "type": "bytes", "optional": True,
     "name": "org.apache.kafka.connect.data.Decimal",
     "parameters": {"scale": "2", "connect.decimal.precision": "12"}},
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def read_spread(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table whose rows are about to be turned into text.

    A test table is one small file and would be one task, so rows are always dealt to the
    session's shuffle partitions.
    """
    rows = read(spark, sf_dir, table)
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.columns[0])


def schema_block(columns: list[dict]) -> str:
    """The schema part of an event with row images of these columns."""
    images = [{"field": f, "type": "struct", "optional": True, "fields": columns} for f in ("before", "after")]
    rest = [{"field": "op", "type": "string", "optional": False}, {"field": "ts_ms", "type": "int64", "optional": True}]
    return json.dumps({"type": "struct", "fields": images + rest})


def cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("bigint")


def unscaled(value: Column) -> Column:
    """Base64 of an 8-byte two's-complement integer."""
    return F.base64(F.unhex(F.lpad(F.hex(value), 16, "0")))


def money(value: str) -> Column:
    return F.col(value).cast("decimal(18,2)").cast("string")


def millis(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _events(rows: DataFrame, table: str, key: Column, columns: list[dict]) -> DataFrame:
    """(k, seq, op, before, after, ts_ms) rows as JSON: half wrapped, half bare, all with
    their schema block."""
    source = F.struct(F.lit("shop").alias("db"), F.lit(table).alias("table"), F.col("ts_ms"),
                      F.lit("log.000001").alias("file"), F.col("seq").cast("bigint").alias("pos"),
                      F.lit(0).cast("bigint").alias("row"))
    body = F.struct(F.col("op"), F.col("before"), F.col("after"), source.alias("source"), F.col("ts_ms"),
                    F.lit(None).cast("string").alias("transaction"))
    text = F.to_json(body, KEEP_NULLS)
    block = schema_block(columns)
    value = F.when(key % 2 == 0, F.concat(F.lit('{"schema":' + block + ',"payload":'), text, F.lit("}"))) \
        .otherwise(F.concat(F.lit('{"schema":' + block + ","), F.substr(text, F.lit(2))))
    return rows.select(key.alias("k"), "seq", "op", "ts_ms", value.alias("value"))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to three change events per order.

    seq 1 always (snapshot row if k % 5 = 0, else create), seq 2 an update if k % 3 = 0,
    seq 3 a delete if k % 7 = 0.
    """
    o = read_spread(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", cents("o_totalprice").alias("c"), millis("o_orderdate").alias("t"))
    k = F.col("o_orderkey")

    def image(updated: Column) -> Column:
        return F.struct(
            k, F.col("o_custkey"),
            F.when(updated, "U").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
            unscaled(F.when(updated, F.col("c") + 100).otherwise(F.col("c"))).alias("o_totalprice"),
            F.col("t").alias("o_orderdate"))

    never, changed = F.lit(False), k % 3 == 0

    def step(seq: int, op: Column, before: Column, after: Column) -> Column:
        return F.struct(F.lit(seq).alias("seq"), op.alias("op"), before.alias("before"), after.alias("after"),
                        (F.col("t") + (seq - 1) * 1000).alias("ts_ms"))

    none = F.when(never, image(never))
    first = step(1, F.when(k % 5 == 0, "r").otherwise("c"), none, image(never))
    second = step(2, F.lit("u"), image(never), image(F.lit(True)))
    third = step(3, F.lit("d"), image(changed), none)
    steps = F.filter(F.array(first, second, third),
                     lambda s: (s["seq"] == 1) | ((s["seq"] == 2) & (k % 3 == 0)) | ((s["seq"] == 3) & (k % 7 == 0)))
    return _events(o.select("o_orderkey", F.inline(steps)), "orders", k, ORDER_COLUMNS)


def customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creates of customers, with negative balances."""
    c = read_spread(spark, sf_dir, "customer")
    image = F.struct("c_custkey", "c_name", unscaled(cents("c_acctbal")).alias("c_acctbal"))
    rows = c.select("c_custkey", F.lit(1).alias("seq"), F.lit("c").alias("op"),
                    F.lit(None).cast("string").alias("before"), image.alias("after"), F.lit(0).cast("bigint").alias("ts_ms"))
    return _events(rows, "customer", F.col("c_custkey"), CUSTOMER_COLUMNS)


def noisy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events plus, per order, rows that are not data changes: heartbeats, a
    truncate without image, a JSON array and a broken text."""
    k = F.col("o_orderkey")
    o = read_spread(spark, sf_dir, "orders").select("o_orderkey")
    noise = o.select(
        F.when(k % 4 == 0, F.concat(F.lit('{"ts_ms":'), k.cast("string"), F.lit("}")))
        .when(k % 4 == 1, F.lit('{"op":"t","before":null,"after":null,"source":{"table":"orders"}}'))
        .when(k % 4 == 2, F.concat(F.lit("["), k.cast("string"), F.lit("]")))
        .otherwise(F.concat(F.lit('{"op":"c","after":{"o_orderkey":'), k.cast("string"))).alias("value"))
    return order_events(spark, sf_dir).select("value").unionByName(noise)


def game_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema-less JSON of events; ``extra`` appears in odd ids, ``value`` is integral
    in every third row, ``big`` needs 64 bits, ``nothing`` is always null."""
    e = read_spread(spark, sf_dir, "events")
    number = F.when(F.col("event_id") % 3 == 0, F.floor("value").cast("string")).otherwise(money("value"))
    text = F.concat(
        F.lit('{"event_type":"'), "event_type", F.lit('","user_id":'), F.col("user_id").cast("string"),
        F.lit(',"value":'), number, F.lit(',"props":'), "props",
        F.lit(',"big":'), (F.col("event_id") + 3000000000).cast("string"),
        F.lit(',"flag":'), F.when(F.col("event_id") % 2 == 0, "true").otherwise("false"),
        F.lit(',"tm":"'), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit('","nothing":null'),
        F.when(F.col("event_id") % 2 == 1, F.concat(F.lit(',"extra":'), F.col("event_id").cast("string"))).otherwise(F.lit("")),
        F.lit("}"))
    return e.select("event_id", text.alias("value"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access-log lines of events in base64. Every 101st is plain text, every 103rd
    has only 30 fields; ``-`` stands for numbers when event_id % 7 = 0."""
    e = read_spread(spark, sf_dir, "events")
    i = F.col("event_id")

    def num(value: Column) -> Column:
        return F.when(i % 7 == 0, F.lit("-")).otherwise(value.cast("string"))

    fields: list[Column] = []
    numeric = {3: money("value"), 4: F.lit(200) + i % 5, 5: i, 10: F.col("user_id"),
               14: money("value"), 29: i % 1000, 30: F.lit(0), 31: i % 77,
               32: F.lit(1024) + i % 6000, 40: i % 31}
    for n in range(41):
        if n == 0:
            fields.append((millis("ts").cast("decimal(16,0)") / 1000).cast("decimal(16,3)").cast("string"))
        elif n in numeric:
            fields.append(num(numeric[n]))
        elif n == 6:
            fields.append(F.upper("event_type"))
        elif n == 9:
            fields.append(F.concat(F.lit("/item/"), F.col("user_id").cast("string")))
        else:
            fields.append(F.concat(F.lit(f"f{n}-"), i.cast("string")))
    parts = once(e.select(i, F.array(*fields).alias("_parts")), "_line", F.concat_ws(
        "\t", F.when(i % 103 == 0, F.slice("_parts", 1, 30)).otherwise(F.col("_parts"))))
    return parts.select(i, F.when(i % 101 == 0, F.col("_line")).otherwise(F.base64(F.col("_line").cast("binary"))).alias("value"))


def wide_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders joined with their customers as 28-field JSON; uuid is missing when
    o_orderkey % 11 = 0, and one text in 13 is broken."""
    o, c = read_spread(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    k, ck = F.col("o_orderkey"), F.col("c_custkey")
    s = lambda col: col.cast("string")
    row = F.struct(
        F.when(k % 11 != 0, F.concat(F.lit("id-"), s(k))).alias("uuid"), ck.alias("customerId"),
        F.col("o_totalprice").cast("bigint").alias("transactionAmount"),
        F.concat(F.lit("10.0.0."), s(ck % 256)).alias("sourceIp"), F.col("o_orderstatus").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("transactionTime"),
        F.col("c_name").alias("user_name"), F.concat(F.lit("+1"), s(ck)).alias("phone_number"),
        (k % 1000).cast("int").alias("product_id"), F.concat(F.lit("p"), s(k % 1000)).alias("product_name"),
        F.col("o_orderpriority").alias("product_type"), (F.lit(20200101) + k % 28).cast("int").alias("manufacturing_date"),
        F.col("o_totalprice").alias("price"), (k % 10).cast("double").alias("unit"),
        F.concat(F.lit("u"), s(ck), F.lit("@example.com")).alias("email"), F.concat(s(ck), F.lit(" Main St")).alias("address"),
        F.concat(F.lit("city"), s(F.col("c_nationkey"))).alias("city"), s(F.col("c_nationkey")).alias("country"),
        F.concat(F.lit("10.1.0."), s(ck % 256)).alias("ip_address"), F.lit("https://example.com").alias("website"),
        F.lit("ACME").alias("company_name"), F.col("c_mktsegment").alias("department"),
        F.col("c_acctbal").alias("salary"), (F.lit(18) + ck % 60).cast("int").alias("age"),
        F.when(ck % 2 == 0, "F").otherwise("M").alias("gender"), F.lit("2024-01-01").alias("created_date"),
        F.when(ck % 5 != 0, "2024-02-02").alias("last_login"), (ck % 100).cast("int").alias("score"))
    text = F.to_json(row)
    return j.select(k, F.when(k % 13 == 0, F.substr(text, F.lit(1), F.lit(20))).otherwise(text).alias("value"))

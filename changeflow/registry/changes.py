"""D1-D10, S10-S12, S15, S16, R2."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow import fixtures as X
from changeflow.functions import decode as D
from changeflow.functions.parsing import open_envelope
from changeflow.operators import changelog as C
from changeflow.operators.routing import select_tables
from changeflow.registry import query
from changeflow.registry.decoding import EVENTS_SQL, KIND_SQL, MONEY_SQL, order_changes
from changeflow.session import materialize, scratch_dir
from changeflow.sinks.keyed import KeyedTable
from changeflow.sources.snapshot import interleave, loaded_rows, read_waves, snapshot_chunks as chunks, within
from changeflow.sources.streams import as_kafka_rows, kafka_values, replay_stream
from changeflow.streaming.runner import finish, run_batches

KEY = ["o_orderkey"]
STATE_SQL = f"""
    SELECT k AS o_orderkey, o_custkey, CASE WHEN k % 3 = 0 THEN 'U' ELSE s END AS o_orderstatus,
           {MONEY_SQL.format('CASE WHEN k % 3 = 0 THEN c + 100 ELSE c END')} AS o_totalprice, d AS o_orderdate
    FROM o WHERE k % 7 <> 0"""


@query("row_kinds", f"""
    WITH {EVENTS_SQL}
    SELECT k, CAST(seq AS BIGINT) AS pos, {KIND_SQL} AS kind, s AS status FROM ev""")
def row_kinds(spark, sf_dir):
    """Kind and image of each event."""
    events = C.data_events(open_envelope(X.order_events(spark, sf_dir).select("value")))
    return events.select(
        F.get_json_object("_image", "$.o_orderkey").cast("bigint").alias("k"), "source.pos",
        C.row_kind("op").alias("kind"), F.get_json_object("_image", "$.o_orderstatus").alias("status"))


SPLIT_SQL = f"""
    WITH {EVENTS_SQL},
    cl AS (SELECT k, ts_ms, 0 AS step, '-U' AS kind, old_s AS s, old_c AS c FROM ev WHERE op = 'u'
           UNION ALL SELECT k, ts_ms, 1, {KIND_SQL}, s, c FROM ev)"""


@query("changelog_split_updates", f"""{SPLIT_SQL}
    SELECT k AS o_orderkey, ts_ms, step, kind, s AS o_orderstatus, {MONEY_SQL.format('c')} AS o_totalprice FROM cl""")
def changelog_split_updates(spark, sf_dir):
    """D3: an update as its old and its new image."""
    return order_changes(spark, sf_dir, upsert=False).select(
        "o_orderkey", F.col("_ts_ms").alias("ts_ms"), F.col("_order._step").alias("step"), F.col("_kind").alias("kind"),
        "o_orderstatus", "o_totalprice")


@query("changelog_append", f"""{SPLIT_SQL}
    SELECT kind, count(*) AS n, CAST(sum({MONEY_SQL.format('c')}) AS DECIMAL(25,2)) AS total FROM cl GROUP BY kind""")
def changelog_append(spark, sf_dir):
    """Every change kept in an append-only table."""
    path = scratch_dir(spark, "audit")
    order_changes(spark, sf_dir, upsert=False).write.mode("append").parquet(path)
    return spark.read.parquet(path).groupBy(F.col("_kind").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").cast("decimal(25,2)").alias("total"))


@query("current_state", f"WITH {EVENTS_SQL} {STATE_SQL}")
def current_state(spark, sf_dir):
    """The keyed table after all changes."""
    return C.current_state(order_changes(spark, sf_dir), KEY)


@query("apply_changes", f"WITH {EVENTS_SQL} {STATE_SQL}")
def apply_changes(spark, sf_dir):
    """The first events as a target, then the rest applied to it."""
    # Both sides read the events from where they were written, parsed once.
    changes = materialize(order_changes(spark, sf_dir), "events")
    target = C.current_state(changes.where("_order.pos = 1 AND o_orderkey % 2 = 0"), KEY)
    rest = changes.where("_order.pos > 1 OR o_orderkey % 2 = 1")
    return C.apply_changes(target, rest, KEY)


@query("snapshot_plus_changes", f"WITH {EVENTS_SQL} {STATE_SQL}")
def snapshot_plus_changes(spark, sf_dir):
    """Table rows loaded directly, then the change events (creates repeat rows)."""
    o = X.read(spark, sf_dir, "orders")
    snapshot = o.where("o_orderkey % 5 = 0").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        D.fit_decimal((X.cents("o_totalprice").cast("decimal(17,0)") / 100), 15, 2).alias("o_totalprice"), "o_orderdate")
    loaded = C.snapshot_events(snapshot, "orders")
    changes = order_changes(spark, sf_dir).where("NOT (o_orderkey % 5 = 0 AND _order.pos = 1)")
    return C.current_state(loaded.unionByName(changes.withColumn("_ts_ms", F.col("_ts_ms"))), KEY)


@query("state_as_of", f"""
    WITH {EVENTS_SQL}, seen AS (SELECT * FROM ev WHERE ts_ms <= 883612800000),
    last AS (SELECT k, max(seq) AS seq FROM seen GROUP BY k)
    SELECT k AS o_orderkey, o_custkey, s AS o_orderstatus, {MONEY_SQL.format('c')} AS o_totalprice, d AS o_orderdate
    FROM seen JOIN last USING (k, seq) WHERE op <> 'd'""")
def state_as_of(spark, sf_dir):
    """The table as of 1998-01-01T00:00:00Z."""
    return C.state_as_of(order_changes(spark, sf_dir), KEY, 883612800000)


@query("table_history", f"""
    WITH {EVENTS_SQL}
    SELECT 'orders' AS table_name, CAST(make_timestamp(ts_ms * 1000) AS DATE) AS version,
           count(*) FILTER (WHERE op IN ('c', 'r')) AS n_insert, count(*) FILTER (WHERE op = 'u') AS n_update,
           count(*) FILTER (WHERE op = 'd') AS n_delete, min(ts_ms) AS first_ts_ms, max(ts_ms) AS last_ts_ms
    FROM ev GROUP BY 2""")
def table_history(spark, sf_dir):
    """What each day changed."""
    version = F.timestamp_millis("_ts_ms").cast("date")
    return C.table_history(order_changes(spark, sf_dir), version).withColumnRenamed("_table", "table_name")


LAST_WRITE_SQL = """
    SELECT user_id AS "customerId", date_trunc('hour', ts) AS "transactionTime", arg_max(value, event_id) AS amount,
           arg_max(event_type, event_id) AS status FROM events GROUP BY ALL"""


def customer_hours(spark, sf_dir):
    """An empty keyed table, and the earlier and later half of the events as its changes."""
    events = X.read(spark, sf_dir, "events").select(
        F.col("user_id").alias("customerId"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("transactionTime"),
        F.col("value").alias("amount"), F.col("event_type").alias("status"), F.lit("+I").alias("_kind"),
        F.col("event_id").alias("_order"))
    middle = events.agg(F.expr("div(max(_order), 2)")).first()[0]
    table = KeyedTable(spark, scratch_dir(spark, "keyed"), ["customerId", "transactionTime"])
    return table, events.where(F.col("_order") <= middle), events.where(F.col("_order") > middle)


@query("upsert_composite_key", LAST_WRITE_SQL)
def upsert_composite_key(spark, sf_dir):
    """Last write per (customer, hour) in a keyed table: two batches and a repeated one."""
    table, early, late = customer_hours(spark, sf_dir)
    table.upsert(early)
    table.upsert(late)
    table.upsert(early)
    return table.read()


@query("late_event_in_later_batch", LAST_WRITE_SQL)
def late_event_in_later_batch(spark, sf_dir):
    """The order of the events decides, also where older ones come in a later batch."""
    table, early, late = customer_hours(spark, sf_dir)
    table.upsert(late)
    table.upsert(early)
    return table.read()


@query("restart_new_checkpoint", LAST_WRITE_SQL)
def restart_new_checkpoint(spark, sf_dir):
    """Batch ids that begin again with a new checkpoint neither hide nor replace rows."""
    table, early, late = customer_hours(spark, sf_dir)
    table.upsert(early)
    table.upsert(late)
    return table.read()


@query("restart_idempotent", f"WITH {EVENTS_SQL} {STATE_SQL}")
def restart_idempotent(spark, sf_dir):
    """A stream of changes into a keyed table, stopped and restarted, with its
    first batch delivered twice."""
    from changeflow.operators.schemas import ColumnSpec
    specs = [ColumnSpec(c["field"], c["type"], c.get("name"), c["optional"], c.get("parameters", {}))
             for c in X.ORDER_COLUMNS]
    messages, state = scratch_dir(spark, "events"), scratch_dir(spark, "events-state")
    table = KeyedTable(spark, scratch_dir(spark, "orders"), KEY)

    def work(batch, batch_id):
        changes = C.changelog(C.data_events(open_envelope(batch.select("value"))))
        # Each delivery takes the parsed batch from where it was written.
        decoded = materialize(C.project_images(changes, specs), "batch")
        table.upsert(decoded)
        table.upsert(decoded)

    events = X.order_events(spark, sf_dir)
    for step in (events.where("seq = 1"), events.where("seq > 1")):
        as_kafka_rows(step).write.mode("append").parquet(messages)
        finish(run_batches(kafka_values(replay_stream(spark, messages)), work, state))
    return table.read()


@query("table_selection", f"""
    WITH {EVENTS_SQL} SELECT 'orders' AS table_name, count(*) AS n FROM ev""")
def table_selection(spark, sf_dir):
    """The captured tables chosen by a pattern."""
    both = X.order_events(spark, sf_dir).select("value").unionByName(X.customer_events(spark, sf_dir).select("value"))
    opened = open_envelope(both).select("source.db", "source.table")
    chosen = select_tables(opened, "shop", "ord.*|shop.nation")
    return chosen.groupBy(F.col("table").alias("table_name")).agg(F.count(F.lit(1)).alias("n"))


@query("route_by_source_table", f"""
    WITH {EVENTS_SQL}
    SELECT 'orders' AS table_name, (SELECT count(*) FROM ev) AS n UNION ALL SELECT 'customer', count(*) FROM customer
    UNION ALL SELECT 'unknown_table', count(*) FROM part""")
def route_by_source_table(spark, sf_dir):
    """R2: the source table, or a fixed name where it is missing."""
    bare = X.read(spark, sf_dir, "part").select(F.to_json(F.struct(
        F.lit("c").alias("op"), F.struct("p_partkey", "p_name").alias("after"))).alias("value"))
    rows = X.order_events(spark, sf_dir).select("value") \
        .unionByName(X.customer_events(spark, sf_dir).select("value")).unionByName(bare)
    return C.data_events(open_envelope(rows)).groupBy(F.col("_table").alias("table_name")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("snapshot_chunks", """
    WITH m AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi, count(*) AS n FROM orders),
    s AS (SELECT *, CAST(floor((hi - lo + 1) / n * 2000) AS BIGINT) AS step FROM m),
    c AS (SELECT *, unnest(range(0, CAST(ceil((hi - lo + 1) / step) AS BIGINT))) AS chunk FROM s)
    SELECT chunk, CASE WHEN chunk > 0 THEN lo + chunk * step END AS lower,
           CASE WHEN lo + (chunk + 1) * step <= hi THEN lo + (chunk + 1) * step END AS upper FROM c""")
def snapshot_chunks(spark, sf_dir):
    """Key ranges of an evenly spread key."""
    return chunks(X.read(spark, sf_dir, "orders"), "o_orderkey", strategy="even")


@query("snapshot_chunks_ranked", """
    WITH r AS (SELECT ts, (row_number() OVER (ORDER BY ts) - 1) AS rn FROM (SELECT DISTINCT ts FROM events)),
    h AS (SELECT rn // 2000 AS chunk, ts FROM r WHERE rn % 2000 = 0)
    SELECT chunk, CASE WHEN chunk > 0 THEN ts END AS lower, lead(ts) OVER (ORDER BY chunk) AS upper FROM h""")
def snapshot_chunks_ranked(spark, sf_dir):
    """Key ranges of a key that arithmetic cannot cut."""
    return chunks(X.read(spark, sf_dir, "events").select("ts").distinct(), "ts")


@query("snapshot_read_by_chunks", f"""
    WITH {EVENTS_SQL},
    m AS (SELECT min(k) AS lo, CAST(floor((max(k) - min(k) + 1) / count(*) * 500) AS BIGINT) AS step, max(k) AS hi, min(t) AS t0, max(t) + 2000 - min(t) AS span FROM o),
    c AS (SELECT *, CAST(ceil((hi - lo + 1) / step) AS BIGINT) AS chunks FROM m),
    p AS (SELECT *, (chunks + 3) // 4 AS per FROM c),
    w AS (SELECT *, (chunks + per - 1) // per AS waves FROM p),
    seen AS (SELECT ev.*, t0 + span * (3 * (((k - lo) // step) // per) + 3) // (3 * waves + 1) AS high FROM ev, w),
    per_key AS (
        SELECT k, CAST(coalesce(arg_max(op, seq) FILTER (ts_ms <= high), 'd') <> 'd' AS BIGINT) AS n_snapshot, count(*) FILTER (ts_ms > high) AS n_log,
               arg_max(op, seq) AS op, arg_max(s, seq) AS s, arg_max(c, seq) AS c FROM seen GROUP BY k)
    SELECT k AS o_orderkey, n_snapshot, n_log, {KIND_SQL} = '-D' AS deleted, s AS o_orderstatus, {MONEY_SQL.format('c')} AS o_totalprice
    FROM per_key WHERE n_snapshot + n_log > 0""")
def snapshot_read_by_chunks(spark, sf_dir):
    """Orders are read in four waves of key ranges while they change. The position of the log and
    the table move on with every step of the load; each key has its row of the load, if it had one at the end of its wave,
    and the changes since."""
    # The log is recorded once; every wave and its positions read the record.
    changes = materialize(order_changes(spark, sf_dir).drop("_table"), "log")
    start, end = changes.agg(F.min("_ts_ms"), F.max("_ts_ms")).first()
    plan = chunks(X.read(spark, sf_dir, "orders"), "o_orderkey", 500, strategy="even")
    n = plan.count()
    steps, tick = 3 * -(-n // -(-n // 4)) + 1, 0

    def now():
        nonlocal tick
        tick += 1
        return start + (end - start) * tick // steps

    def read(bounds):
        return C.state_as_of(changes.where(within("o_orderkey", bounds[0][0], bounds[-1][1])), KEY, now())

    out = scratch_dir(spark, "load")
    notes = read_waves(plan, "o_orderkey", read, now, out, waves=4)
    every = interleave(loaded_rows(notes, out), notes, changes, "o_orderkey", F.col("_ts_ms"), log_place)
    loaded = F.col("_order.file").isNull()
    return every.groupBy("o_orderkey").agg(
        F.count_if(loaded).alias("n_snapshot"), F.count_if(~loaded).alias("n_log"), (F.max_by("_kind", "_order") == "-D").alias("deleted"),
        F.max_by("o_orderstatus", "_order").alias("o_orderstatus"), F.max_by("o_totalprice", "_order").alias("o_totalprice"))


def log_place(position):
    """The order of a row that stands for everything up to a position."""
    none = F.lit(None)
    return F.struct(position.alias("ts_ms"), none.cast("string").alias("file"), none.cast("bigint").alias("pos"), none.cast("bigint").alias("row"))

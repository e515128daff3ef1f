"""Sliding windows on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changeflow.operators.windows import COUNT, DEFAULT_HOP, MICROS, Hop, Stat, hop_direct

WATERMARK = 5
#: Settings of queries with state: open panes and windows of all keys are kept off the heap.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """T5: for queries that start from now on. A checkpoint goes on with the store it began with."""
    for key, value in ROCKSDB.items():
        spark.conf.set(key, value)


def _text(key: str, kind: str) -> Column:
    """A key as hexadecimal text, equal for equal keys; ``-`` for NULL."""
    value = F.col(key)
    if kind in ("float", "double"):
        value = value + F.lit(0).cast(kind)  # minus zero is zero
    if kind == "timestamp":
        value = F.unix_micros(value)
    return F.coalesce(F.hex(value if kind == "binary" else value.cast("string")), F.lit("-"))


def _untexted(text: Column, kind: str) -> Column:
    value = F.unhex(F.nullif(text, F.lit("-")))
    if kind == "binary":
        return value
    value = value.cast("string")
    return F.timestamp_micros(value.cast("bigint")) if kind == "timestamp" else value.cast(kind)


def hop_stream_runs(df: DataFrame, ts: str, keys: list[str], stats: tuple[Stat, ...] = COUNT,
                    hop: Hop = DEFAULT_HOP, delay: int = WATERMARK, groups: int = 1024) -> DataFrame:
    """Each window once, when the watermark (``delay`` seconds behind) passes its end; successive windows of a key
    with equal contents that are due together are one row. ``run_windows`` makes a row of each.

    A late row counts in those of its windows that are still open and is dropped if there are none;
    rows without a time are in no window. For a key that holds no rows all windows up to the
    watermark are closed.

    The event time given to Spark is that of a row's last window, with the delay longer by as much: the
    watermark is the same, and Spark's own filter drops just the rows that no window waits for.

    Keys share state in ``groups`` groups, which a checkpoint keeps. They reach Python as one text: pandas has no NULL numbers or times.
    """
    from changeflow.streaming.panes import Panes

    keep_state_in_rocksdb(df.sparkSession)
    parts = {k: v for s in stats for k, v in s.addends().items()}
    us, slide = F.unix_micros(F.col(ts).cast("timestamp")), F.lit(hop.slide * MICROS)
    kinds = {f.name: f.dataType.simpleString() for f in df.select(*keys).schema}
    timed = df.where(F.col(ts).isNotNull()).select(
        F.concat_ws(",", *[_text(k, kind) for k, kind in kinds.items()]).alias("x_key"), F.timestamp_micros(us + F.lit(hop.size * MICROS)).alias("_due"),
        F.call_function("div", us - F.pmod(us, slide), slide).alias("x_pane"),
        *[v.alias(f"x{k}") for k, v in parts.items()]).withWatermark("_due", f"{hop.size + delay} seconds")
    timed = timed.withColumn("x_group", F.pmod(F.xxhash64("x_key"), F.lit(groups)).cast("int"))
    sums = {f"x{k}": timed.schema[f"x{k}"].dataType.simpleString() for k in parts}
    made = {"x_key": "string", "_from": "bigint", "_to": "bigint"} | sums
    runs = timed.groupBy("x_group").transformWithStateInPandas(
        Panes("x_key", "x_pane", sums, hop.slide * 1000, hop.panes), ", ".join(f"`{k}` {kind}" for k, kind in made.items()), "append", "EventTime")
    own = F.split("x_key", ",")
    return runs.select(*[_untexted(own[i], kind).alias(k) for i, (k, kind) in enumerate(kinds.items())], "_from", "_to",
                       *[F.col(f"x{k}").alias(k) for k in parts])


def run_windows(runs: DataFrame, keys: list[str], stats: tuple[Stat, ...] = COUNT, hop: Hop = DEFAULT_HOP) -> DataFrame:
    """A row for each window of the runs that ``hop_stream_runs`` made with the same arguments."""
    end = F.col("_w") * F.lit(hop.slide * MICROS)
    return runs.withColumn("_w", F.explode(F.sequence("_from", "_to"))).select(
        *keys, F.timestamp_micros(end - F.lit(hop.size * MICROS)).alias("window_start"),
        F.timestamp_micros(end).alias("window_end"), *[s.settled() for s in stats])


def hop_stream(df: DataFrame, ts: str, keys: list[str], stats: tuple[Stat, ...] = COUNT,
               hop: Hop = DEFAULT_HOP, delay: int = WATERMARK, groups: int = 1024) -> DataFrame:
    """``hop_stream_runs`` with a row for each window."""
    return run_windows(hop_stream_runs(df, ts, keys, stats, hop, delay, groups), keys, stats, hop)


def hop_stream_direct(df: DataFrame, ts: str, keys: list[str], stats: tuple[Stat, ...] = COUNT,
                      hop: Hop = DEFAULT_HOP, delay: int = WATERMARK) -> DataFrame:
    """The same through ``F.window``: every row is copied into each of its windows, and state holds a row for each open window of each key."""
    keep_state_in_rocksdb(df.sparkSession)
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{delay} seconds")
    return hop_direct(timed, ts, keys, stats, hop)

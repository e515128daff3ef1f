"""Run a job: ``spark-submit ... -m changeflow <job> --name value ...``.

Parameters come from a group of runtime properties (``--application.properties`` names a JSON file that the driver
can read, ``--property.group`` the group in it) if there is one, else from the command line.

Sources: ``--kafka.bootstrap.servers`` and ``--kafka.topic`` (with ``--kafka.group.id``,
``--kafka.startup.mode``, ``--enablessl`` and ``--ssl.*``), ``--kinesis.stream`` and ``--aws.region`` (with
``--kinesis.position`` and ``--kinesis.format``, the name of the reader in the package given to spark-submit), or
``--source.path`` for a folder of recorded messages. ``--checkpoint.path`` is required; with
``--checkpoint.interval`` (milliseconds) the job keeps running at that interval, without
it the job handles what is there and stops.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

from changeflow.config import PROPERTY_GROUP, JobConfig, catalog_conf, property_group
from changeflow.plans import documents, streams, tables
from changeflow.session import prepare
from changeflow.sinks.search import http_transport
from changeflow.sources import declared
from changeflow.sources.streams import kafka_stream, kafka_values, kinesis_stream, replay_stream


def source(spark: SparkSession, c: JobConfig) -> DataFrame:
    if c.get("source.path"):
        return kafka_values(replay_stream(spark, c.get("source.path")))
    if c.get("kinesis.stream"):
        return kinesis_stream(spark, c.get("kinesis.format", "aws-kinesis"), stream=c.require("kinesis.stream"),
                              region=c.require("aws.region"), position=c.get("kinesis.position", "LATEST"))
    ssl = None
    if c.flag("enablessl"):
        ssl = {k.removeprefix("ssl."): v for k, v in c.values.items() if k.startswith("ssl.")}
    return kafka_stream(
        spark, brokers=c.require("kafka.bootstrap.servers"), topic=c.require("kafka.topic"), group=c.get("kafka.group.id"),
        startup=c.get("kafka.startup.mode", "latest-offset"), ssl=ssl,
        max_per_trigger=c.integer("kafka.max.per.trigger", 0) or None)


def keys_of(c: JobConfig) -> dict[str, list[str]]:
    """``--keys.<table> a,b`` for each table with a known key."""
    return {k.removeprefix("keys."): v.split(",") for k, v in c.values.items() if k.startswith("keys.")}


def run(spark: SparkSession, job: str, c: JobConfig):
    """Start a job; returns its streaming queries."""
    if job == "catalog-report":
        documents.catalog_report(spark, c.require("table"), c.get("database"), c.get("catalog"))
        return []
    rows, checkpoint = source(spark, c), c.require("checkpoint.path")
    every = f"{c.integer('checkpoint.interval', 0)} milliseconds" if c.get("checkpoint.interval") else None
    shards = c.integer("sink.parallelism", 0) or None

    def index() -> tuple:
        return c.require("search.index"), http_transport(c.require("search.host"), c.get("search.username"), c.get("search.password"))

    def cells():
        path = c.require("sink.path")
        return lambda df, batch_id: df.write.mode("overwrite").parquet(f"{path}/batch={tables.stream_name(checkpoint)}-{batch_id}")

    jobs = {
        "cdc-tables": lambda: tables.cdc_to_tables(rows, c, checkpoint, every, keys_of(c)),
        "declared-events": lambda: tables.declared_events(
            rows, c, c.get("row", declared.PRODUCT_ORDER_ROW), [k for k in c.get("keys", "id").split(",") if k], checkpoint, every),
        "json-tables": lambda: tables.json_to_tables(rows, c, checkpoint, every),
        "keyed-transactions": lambda: tables.keyed_transactions(rows, c.require("sink.path"), checkpoint, every, c.get("dead.path")),
        "transaction-statistics": lambda: streams.transaction_statistics(
            rows, c.require("sink.path"), c.require("stat.path"), checkpoint, every),
        "product-statistics": lambda: streams.product_statistics(
            rows, c.require("sink.path"), c.require("stat.path"), checkpoint, every),
        "access-logs": lambda: streams.access_logs(
            rows, c.require("sink.path"), c.require("dead.path"), checkpoint, every,
            None if c.flag("processing.time") else "log_time", c.get("sink.table")),
        "envelope-archive": lambda: streams.envelope_archive(
            rows, c.require("sink.path"), checkpoint, every, c.get("flavour", "text"), c.flag("hourly"),
            c.integer("max.records", 0) or None, c.get("sink.table")),
        "changes-index": lambda: documents.changes_to_index(
            rows, c.get("row", declared.USER_ORDER_ROW), c.get("keys", "id").split(","), *index(), checkpoint, every, shards, c.get("dead.path")),
        "transactions-index": lambda: documents.transactions_to_index(rows, *index(), checkpoint, every, shards, c.get("dead.path")),
        "wide-cells": lambda: documents.messages_to_cells(rows, cells(), checkpoint, every, letters=c.get("dead.path")),
    }
    if job not in jobs:
        raise SystemExit(f"unknown job {job}; one of catalog-report, {', '.join(jobs)}")
    started = jobs[job]()
    return started if isinstance(started, list) else [started]


def parameters(argv: list[str]) -> JobConfig:
    """The group of runtime properties if there is one, else the command line."""
    given = JobConfig.from_sources(None, argv)
    group = None
    if given.get("application.properties") and os.path.exists(given.get("application.properties")):
        with open(given.get("application.properties")) as file:
            group = property_group(file.read(), given.get("property.group", PROPERTY_GROUP))
    return JobConfig.from_sources(group, argv)


def main(argv: list[str]) -> None:
    if not argv:
        raise SystemExit(__doc__)
    config = parameters(argv[1:])
    builder = SparkSession.builder.appName(f"changeflow {argv[0]}")
    if config.get("iceberg.catalog.type") or config.get("sink.target"):
        for key, value in catalog_conf(config).items():
            builder = builder.config(key, value)
    for query in run(prepare(builder.getOrCreate()), argv[0], config):
        query.awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])

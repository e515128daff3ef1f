"""Session settings shared by jobs, queries and tests."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Only result-affecting or cluster-neutral settings live here: partition counts,
# memory and master belong to spark-submit.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows go to Python by bytes, not by number: ten thousand long texts would fill a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on (UTC above all)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "changeflow", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = prepare(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Without it only a
    local master may fall back to a temporary folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for what runs inside, as they were before afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


#: Settings that keep disk small while much is staged and written: files of a shuffle go with the execution that made them, not when the
#: driver collects its garbage, and files are packed tighter. Whole numbers and times that a dictionary does not hold are stored by their
#: differences, of which successive windows have one; times in the way of the Parquet standard.
SMALL_FILES = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "parquet.writer.version": "v2",
}


@contextmanager
def tasks_by_rows(spark: SparkSession, rows: int, each: int = 50_000) -> Iterator[int]:
    """Shuffles of what runs inside are cut for ``each`` input rows, so that a task's memory does not grow with the input.

    At least the session's partitions; adaptive execution does not merge them, since it knows compressed bytes only. What runs
    inside must be complete when it is left, written for instance.
    """
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(name) for name in names]
    n = max(int(before[0]), -(-rows // each))
    try:
        for name, value in zip(names, (str(n), "false")):
            spark.conf.set(name, value)
        yield n
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage durably (a lost executor loses nothing) and fixes results that a
    second evaluation could cut differently.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def materialized(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``materialize`` for what runs inside; the copy is released when that is done."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    yield df.sparkSession.read.schema(df.schema).parquet(path)
    release(df.sparkSession, path)


def release(spark: SparkSession, path: str) -> None:
    """Empty a scratch folder that nothing reads any more: its files are replaced by one without rows."""
    spark.range(0).write.mode("overwrite").parquet(path)

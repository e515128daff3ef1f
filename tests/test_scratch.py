"""What jobs stage goes as soon as it has been written."""

import glob
import uuid

import pyarrow.parquet as pq
import pytest
from conftest import SF, rows

from changeflow import registry, session
from changeflow.config import JobConfig
from changeflow.plans import tables
from changeflow.registry import accounts
from changeflow.session import SMALL_FILES, settings
from changeflow.sinks.keyed import KeyedTable
from changeflow.sources.streams import replay_stream
from changeflow.streaming.runner import finish

registry.load()


def staged(*patterns):
    """The rows of the files below the folders that are for a while only."""
    found = [f for p in patterns for f in glob.glob(f"{p}/**/*.parquet", recursive=True)]
    assert found
    return sum(pq.ParquetFile(f).metadata.num_rows for f in found)


@pytest.fixture
def scratch(folder, monkeypatch):
    """The folder that scratch data of one test goes to."""
    def path(spark, label):
        return f"{folder}/{label}-{uuid.uuid4().hex}"

    monkeypatch.setattr(session, "scratch_dir", path)
    monkeypatch.setattr(accounts, "scratch_dir", path)
    return folder


def test_jobs_run_in_turn_and_leave_what_they_write(spark, scratch, monkeypatch):
    """all jobs ran at once, and messages, staged batches, copies and shuffles of all lay there to the end."""
    running, wait = [], accounts.finish

    def noted(query):
        running.append(len(spark.streams.active))
        wait(query)

    monkeypatch.setattr(accounts, "finish", noted)
    accounts_of = registry.QUERIES["job_dead_letters"](spark, SF).collect()
    # Statistics are two streams, the copy and the windows.
    assert len(running) == 13 and max(running) <= 2
    assert len(accounts_of) == 11 and all(r["rows_in"] == r["rows_out"] + r["skipped"] + r["letters"] > 0 for r in accounts_of)
    assert staged(f"{scratch}/messages-*", f"{scratch}/*-stage", f"{scratch}/*/*-stage", f"{scratch}/upsert-*", f"{scratch}/**/_stage/slot*/rows") == 0
    [times] = {m.row_group(0).column(2).physical_type for f in glob.glob(f"{scratch}/job-*/part-*.parquet")
               if (m := pq.ParquetFile(f).metadata).num_rows and m.schema.names == ["customerId", "cnt", "triggerTs"]}
    assert times == "INT64"
    assert {k: spark.conf.get(k, None) for k in SMALL_FILES} == dict.fromkeys(SMALL_FILES)


def test_settings_are_put_back(spark):
    with settings(spark, {"spark.sql.shuffle.partitions": "3", "parquet.writer.version": "v2"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3" and spark.conf.get("parquet.writer.version") == "v2"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4" and spark.conf.get("parquet.writer.version", None) is None


def test_a_routed_batch_is_released(spark, folder):
    spark.createDataFrame([('{"a": 1}',), ("{",)], "value string").write.parquet(f"{folder}/in")
    stream = replay_stream(spark, f"{folder}/in", "value string")
    config = JobConfig({"iceberg.warehouse": f"{folder}/w", "iceberg.table": "t"})
    finish(tables.json_to_tables(stream, config, f"{folder}/state"))
    assert staged(f"{folder}/state-stage") == 0
    assert rows(tables.read_appended(spark, tables.table_path(config, "t")).select("a")) == [(1,)]


@pytest.mark.parametrize("second", [[(2, "z", "+U", (5,))], [(1, "a", "+I", (1,))]])
def test_an_upsert_leaves_only_the_table(spark, scratch, second):
    """Also if it changes nothing, as a repeated batch does."""
    table = KeyedTable(spark, f"{scratch}/t", ["k"], buckets=2)
    for batch in ([(1, "a", "+I", (1,)), (2, "b", "+I", (2,))], second):
        table.upsert(spark.createDataFrame(batch, "k int, v string, _kind string, _order struct<n: int>"))
        assert staged(f"{scratch}/t/_stage/slot*/rows", f"{scratch}/upsert-*") == 0
    assert rows(table.read(), "k") == [(1, "a"), (2, second[0][1] if second[0][0] == 2 else "b")]


def test_rows_that_a_dead_writer_left_are_taken_up_and_released(spark, folder, monkeypatch):
    batch = "k int, v string, _kind string, _order struct<n: int>"
    KeyedTable(spark, f"{folder}/t", ["k"], buckets=2).upsert(spark.createDataFrame([(1, "a", "+I", (1,))], batch))

    def dies(self, rows, version):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_publish", dies)
        with pytest.raises(RuntimeError):
            KeyedTable(spark, f"{folder}/t", ["k"]).upsert(spark.createDataFrame([(1, "b", "+U", (2,))], batch))
    assert staged(f"{folder}/t/_stage/slot*/rows") > 0
    table = KeyedTable(spark, f"{folder}/t", ["k"])
    table.upsert(spark.createDataFrame([(2, "c", "+I", (3,))], batch))
    assert rows(table.read(), "k") == [(1, "b"), (2, "c")]
    assert staged(f"{folder}/t/_stage/slot*/rows") == 0

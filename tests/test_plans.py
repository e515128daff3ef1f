"""Physical plans and layouts that must hold at scale."""

import pytest
from pyspark.sql import functions as F

from changeflow import fixtures as X
from changeflow.functions.parsing import open_envelope
from changeflow.operators import changelog as C, schemas as S
from changeflow.operators.routing import distribute, route_by_field
from changeflow.sinks import files
from changeflow.sinks.tables import write_routed
from changeflow.sources.tables import time_slice
from conftest import SF


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_slice_reads_only_matching_folders(spark, folder):
    events = spark.read.parquet(f"{SF}/events.parquet")
    files.write_hourly(events.select("event_id", "ts").where("day(ts) < 4"), folder, "ts")
    got = time_slice(spark.read.parquet(folder), "2024-01-02 00", "2024-01-02 06")
    text = plan(got.select("event_id"))
    assert "make_timestamp" in text.split("PartitionFilters: [")[1].split("ReadSchema")[0]
    assert "ReadSchema: struct<event_id:bigint>" in text
    assert got.count() == events.where("ts >= '2024-01-02 00:00:00' AND ts < '2024-01-02 06:00:00'").count()


def test_stateless_decoding_has_no_shuffle(spark):
    rows = spark.createDataFrame([("{}",)], "value STRING")
    specs = [S.ColumnSpec("a", "int32"), S.ColumnSpec("d", "bytes", "org.apache.kafka.connect.data.Decimal", parameters={"scale": "2"})]
    text = plan(C.project_images(C.changelog(C.data_events(open_envelope(rows)), upsert=False), specs))
    assert "Exchange" not in text and "Python" not in text


def test_inference_combines_before_its_single_shuffle(spark):
    routed = route_by_field(X.game_events(spark, SF).select("value"), "event_type", "x")
    text = plan(S.infer_schema(routed))
    assert text.count("ENSURE_REQUIREMENTS") == 1 and "partial_bit_or" in text and "Python" not in text


def test_schema_blocks_are_hashed_not_sorted(spark):
    events = C.data_events(open_envelope(X.order_events(spark, SF).select("value"), with_schema=True))
    text = plan(S.event_schemas(C.slim_events(events)))
    assert "SortAggregate" not in text and text.count("ENSURE_REQUIREMENTS") == 1


def test_apply_joins_keys_only(spark, folder):
    target = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    changes = spark.range(3).select(
        F.col("id").alias("k"), F.lit("y").alias("v"), F.lit("+U").alias("_kind"), F.col("id").alias("_order"),
        F.lit("t").alias("_table"), F.lit(0).alias("_ts_ms"))
    out = C.apply_changes(target, changes, ["k"])
    assert "LeftAnti" in plan(out) and "CartesianProduct" not in plan(out)
    # The changes are reduced once: only their written result is read, twice.
    assert "max_by" not in plan(out) and plan(out).count("Scan parquet") == 2
    assert out.groupBy("v").count().orderBy("v").collect() == [("x", 7), ("y", 3)]


def test_schema_versions_shuffle_hashes(spark):
    df = spark.sql("SELECT 't' AS _table, id AS _order, concat('text', id div 5) AS schema FROM range(10)")
    out = S.schema_versions(df)
    assert "md5(" in plan(out) and sorted(out.collect()) == [("t", 0, "text0"), ("t", 5, "text1")]


def test_distribution_and_routed_write(spark, folder):
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, "hot").otherwise("cold").alias("_table"))
    assert distribute(df, "_table", "id", partitions=6).rdd.getNumPartitions() == 6
    assert distribute(df, "_table").count() == 1000
    write_routed(df, folder)
    assert dict(spark.read.parquet(folder).groupBy("_table").count().collect()) == {"hot": 900, "cold": 100}


def test_write_options():
    assert files.write_options("orc", 10, "audit") == {"format": "orc", "branch": "audit", "maxRecordsPerFile": "10"}
    assert files.write_options()["branch"] == "main"
    with pytest.raises(ValueError):
        files.write_options("csv")


def test_requests_are_packed_without_shuffle(spark):
    from changeflow.sinks import search

    lines = spark.range(0, 5000, 1, 3).select(F.repeat(F.lit("ü"), (F.col("id") % 50).cast("int")).alias("line"), (F.col("id") % 7).alias("_id"))
    packed = search.pack_requests(lines, max_actions=100, max_bytes=4000)
    assert not any(word in plan(packed) for word in ("Exchange", "Sort", "Window"))
    got = packed.collect()
    assert sum(r["n_actions"] for r in got) == 5000 and max(r["n_actions"] for r in got) <= 100 and max(r["n_bytes"] for r in got) <= 4000
    assert all(len(r["body"].encode()) == r["n_bytes"] for r in got) and sum(r["n_bytes"] for r in got) == sum(2 * (i % 50) for i in range(5000))
    [one] = search.pack_requests(spark.createDataFrame([("x" * 9000,)], "line STRING"), max_bytes=4000).collect()
    assert one["n_bytes"] == 9000 and search.pack_requests(lines.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 12])
def test_files_have_the_target_size(spark, folder, parts):
    hashes = F.transform(F.sequence(F.lit(1), F.lit(parts)), lambda i: F.md5(F.concat(F.col("id").cast("string"), F.lit("-"), i.cast("string"))))
    rows = spark.range(0, 600_000 // parts, 1, 8).select("id", F.array_join(hashes, "").alias("t"))
    target = 2_000_000
    files.in_files_of(rows, target).write.parquet(folder)
    sizes = [r[0] for r in spark.read.format("binaryFile").load(folder).select("length").collect()]
    assert len(sizes) > 1 and all(target / 2 < size < target * 2 for size in sizes)
    with pytest.raises(ValueError):
        files.in_files_of(rows, 0)


def test_one_write_for_each_layout(spark, folder, monkeypatch):
    from changeflow.plans import tables
    from changeflow.registry.schemas import two_tables

    writes = []
    monkeypatch.setattr(tables, "write_routed", lambda df, path: writes.append(path) or write_routed(df, path))
    events = C.slim_events(two_tables(spark, SF)).withColumn("_table", F.when(F.col("_table") == "orders", F.concat(F.lit("o"), (F.col("ts_ms") % 7).cast("string"))).otherwise("c"))
    paths = tables.append_by_schema(events, folder)
    assert len(writes) == 2 and len(paths) == 1 + events.where("_table <> 'c'").select("_table").distinct().count()
    assert spark.read.parquet(paths["c"]).count() == 150

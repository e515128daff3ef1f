"""D1-D10, K2, T7."""

import random

import pytest

from pyspark.sql import functions as F

from changeflow.operators import changelog as C
from changeflow.registry.decoding import order_changes
from changeflow.sinks.keyed import KeyedTable
from changeflow.sources.snapshot import interleave, jdbc_predicates, loaded_rows, read_waves, snapshot_chunks, within
from changeflow.session import materialize
from conftest import SF, rows

KEY = ["o_orderkey"]


def test_any_batching_gives_the_same_state(spark):
    changes = materialize(order_changes(spark, SF), "changes")
    want = C.current_state(changes, KEY)
    for cut in (1, 2, 3):
        base = C.current_state(changes.where(F.col("_order.pos") <= cut - 1), KEY)
        got = C.apply_changes(base, changes.where(F.col("_order.pos") >= cut), KEY)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_keyed_table_batches_and_evolution(spark, folder):
    """Repeated batches, deletes, a wider type, an added column, a number that becomes text."""
    random.seed(3)
    table, state, order = KeyedTable(spark, folder, ["k"], buckets=4), {}, 0
    for batch in range(7):
        data = []
        for _ in range(40):
            order += 1
            k, kind = random.randrange(15), random.choice(["+I", "+U", "+U", "-D"])
            data.append((k, order, kind, order))
            state.pop(k, None) if kind == "-D" else state.__setitem__(k, order)
        df = spark.createDataFrame(data, f"k INT, v {'BIGINT' if batch >= 3 else 'INT'}, _kind STRING, _order INT")
        if batch == 5:
            df = df.withColumn("note", F.lit("new"))
        if batch == 6:
            df = df.withColumn("v", F.col("v").cast("string"))
            state = {k: str(v) for k, v in state.items()}
        table.upsert(df)
        table.upsert(df.where("_order % 2 = 0"))
        assert dict(rows(table.read().select("k", "v"))) == state
    assert table.read().dtypes == [("k", "int"), ("v", "string"), ("note", "string")]


def change(spark, *data):
    return spark.createDataFrame(data, "k INT, v STRING, _kind STRING, _order INT")


def test_keyed_table_keeps_marks_of_deleted_keys(spark, folder):
    table = KeyedTable(spark, folder, ["k"])
    table.upsert(change(spark, (1, "a", "+I", 1), (2, "b", "+I", 1)))
    table.upsert(change(spark, (1, None, "-D", 5)))
    table.upsert(change(spark, (1, "old", "+U", 3), (2, "older", "+U", 0)))
    assert rows(table.read()) == [(2, "b")]
    table.upsert(change(spark, (1, "again", "+I", 6), (None, "no key", "+I", 1)))
    assert sorted(rows(table.read()), key=str) == [(1, "again"), (2, "b"), (None, "no key")]
    table.upsert(change(spark))
    assert table.read().count() == 3


def test_keyed_table_of_an_empty_batch(spark, folder):
    table = KeyedTable(spark, folder, ["k"])
    assert table.schema() is None
    table.upsert(change(spark))
    assert table.read().columns == ["k", "v"] and table.read().count() == 0


def test_keyed_table_replaces_touched_folders_only(spark, folder):
    table = KeyedTable(spark, folder, ["k"], buckets=16)
    table.upsert(change(spark, *((k, "a", "+I", 1) for k in range(200))))

    def files():
        # The files themselves, not the read path: a rewritten folder has files of another name.
        return {r[0] for r in spark.read.parquet(f"{folder}/v0").select(F.input_file_name()).distinct().collect()}

    before = files()
    table.upsert(change(spark, (7, "b", "+U", 2)))
    after = files()
    assert len(before) == 16 and len(after - before) == 1 and len(before - after) == 1
    assert rows(table.read().where("v = 'b'")) == [(7, "b")] and table.read().count() == 200


def test_keyed_table_finishes_what_a_dead_writer_began(spark, folder, monkeypatch):
    """Whether the writer dies before, in or after the replacement, no row is lost and none comes twice."""
    table = KeyedTable(spark, folder, ["k"], buckets=2)
    table.upsert(change(spark, *((k, "a", "+I", 1) for k in range(20))))

    def dies(self, rows, version):
        # A folder is gone, its replacement isn't there yet.
        kept = spark.read.parquet(f"{folder}/v{version}").where("_bucket = 0").select("k").collect()
        rows.where("_bucket = 1").write.mode("overwrite").partitionBy("_bucket").parquet(f"{folder}/v{version}")
        assert kept
        raise RuntimeError("dead")

    monkeypatch.setattr(KeyedTable, "_publish", dies)
    batch = change(spark, *((k, "b", "+U", 2) for k in range(0, 30, 3)))
    with pytest.raises(RuntimeError):
        table.upsert(batch)
    monkeypatch.undo()
    want = {k: "a" for k in range(20)} | {k: "b" for k in range(0, 30, 3)}
    # Another writer's batch comes first.
    KeyedTable(spark, folder, ["k"]).upsert(change(spark, (100, "c", "+I", 3)))
    assert dict(rows(table.read())) == want | {100: "c"}
    table.upsert(batch)
    assert dict(rows(table.read())) == want | {100: "c"} and table.read().count() == len(want) + 1


def test_hot_key_is_combined_before_the_shuffle(spark):
    changes = order_changes(spark, SF)
    plan = C.current_state(changes, KEY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(o_orderkey") == 2 or plan.count("partial_max_by") == 1
    assert "Window" not in plan


def test_ranked_chunks_cover_all_keys_once(spark):
    df = spark.range(0, 5000, 3).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("k"))
    chunks = snapshot_chunks(df, "k", split_size=100).orderBy("chunk").collect()
    assert len(chunks) == 17 and chunks[0]["lower"] is None and chunks[-1]["upper"] is None
    assert all(a["upper"] == b["lower"] for a, b in zip(chunks, chunks[1:]))
    sizes = [df.where((F.lit(c["lower"]).isNull() | (F.col("k") >= c["lower"])) & (F.lit(c["upper"]).isNull() | (F.col("k") < c["upper"]))).count()
             for c in (chunks[0], chunks[8], chunks[-1])]
    assert sizes == [100, 100, 67]


def test_strategies_of_chunks(spark):
    df = spark.range(300).select((F.col("id") * F.col("id") * 1000).alias("k"))
    assert snapshot_chunks(df, "k", split_size=100).count() == 3
    assert snapshot_chunks(df, "k", split_size=100, strategy="by_density").count() == 3
    assert rows(snapshot_chunks(spark.range(300), "id", 100, "by_density"), "chunk") == [(0, None, 100), (1, 100, 200), (2, 200, None)]
    for wrong in (lambda: snapshot_chunks(df, "k", strategy="other"), lambda: snapshot_chunks(df.select(F.col("k").cast("string")), "k", strategy="even")):
        with pytest.raises(ValueError):
            wrong()
    assert rows(snapshot_chunks(df.where("k < 0"), "k")) == [(0, None, None)]


def test_predicates_of_chunks():
    assert jdbc_predicates("k", [(None, 5), (5, 9), (9, None)]) == ["(k < 5) OR k IS NULL", "k >= 5 AND k < 9", "k >= 9"]
    assert jdbc_predicates("k", [(None, None)]) == ["(1 = 1) OR k IS NULL"] and jdbc_predicates("k", [("a'b", None)]) == ["k >= 'a''b'"]


def test_load_goes_on_after_a_failure_and_takes_changes_of_its_time(spark, folder):
    """Rows change before, while and after they are read; the load dies once and is started again."""
    log = [(k, f"v{k}", "+I", 0) for k in range(40)]
    state = {k: f"v{k}" for k in range(40)} | {None: "none"}
    clock, died = [0], []
    log.append((None, "none", "+I", 0))

    def change(at):
        for k in (at % 40, (at * 7) % 40, 39 - at % 40):
            if (at + k) % 3:
                state[k] = f"w{at}-{k}"
                log.append((k, state[k], "+U", at))
            elif k in state:
                del state[k]
                log.append((k, None, "-D", at))

    def position():
        clock[0] += 1
        change(clock[0])
        return clock[0]

    def read(bounds):
        if bounds[0][0] == 20 and not died:
            died.append(True)
            raise RuntimeError("dead")
        position()
        data = spark.createDataFrame(list(state.items()), "k INT, v STRING")
        lower, upper = bounds[0][0], bounds[-1][1]
        found = data.where(within("k", lower, upper))
        position()
        return found

    plan = snapshot_chunks(spark.createDataFrame([(k,) for k in range(40)], "k INT"), "k", 5)
    with pytest.raises(RuntimeError):
        read_waves(plan, "k", read, position, folder, waves=4)
    notes = read_waves(plan, "k", read, position, folder, waves=4)
    assert notes.count() == 4 and died
    for _ in range(5):
        position()
    changes = spark.createDataFrame(log, "k INT, v STRING, _kind STRING, _order INT")
    every = interleave(loaded_rows(notes, folder), notes, changes, "k", F.col("_order"), lambda at: at)
    loaded = every.where("_kind = '+I'")
    assert loaded.select("k").distinct().count() == loaded.count()
    assert dict(rows(C.current_state(every, ["k"]))) == state
    # Changes that the load has are not repeated.
    after = {r["wave"]: r["high"] for r in notes.collect()}
    assert every.where("_kind <> '+I'").count() == sum(at > after[0 if k is None or k < 10 else k // 10] for k, _, _, at in log if at)

"""Clashing column names, nulls and empty tables through the operators that carry whole documents, and through the pipeline."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from changeflow.llm import decontamination, pfair, sharding, superminhash, toxicity

#: Names that the operators use inside or for their new columns.
CLASHING = ["shard", "slot", "_chunk", "_key", "_first", "_inside", "mix_source", "mix_epoch", "mix_slot", "_pid", "_own", "_row", "_s", "_k", "_at", "_size", "c",
            "c0_", "score", "toxic_score", "_copies", "_t", "_u", "n", "label", "node", "joined", "start", "size", "h", "d", "k"]


def documents(spark, rows):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.select(*names, *[F.lit(f"own {c}").alias(c) for c in CLASHING])


ROWS = [(1, "one two three four five six", "en", "a"), (2, "one two three four five six", "en", None), (None, None, None, "a"), (3, "", "en", "b"), (3, "", "en", "b"),
        (4, "w " * 50_000 + "end", "de", "a"), (None, "other words are here now too", "en", None)]


def carried(got, docs):
    """The documents' own columns, as they came."""
    back = got.select(*[F.col(f"`{c}`") for c in docs.columns])
    return sorted(map(tuple, back.collect()), key=str)


def test_new_columns_make_way_for_those_of_the_table(spark):
    docs = documents(spark, ROWS)
    want = sorted(map(tuple, docs.collect()), key=str)
    dealt = sharding.shuffle_into_shards(docs, 3)
    assert dealt.columns == [*docs.columns, "_shard", "_slot"] and carried(dealt, docs) == want
    assert sorted(r[0] for r in dealt.select("_shard").distinct().collect()) == [0, 1, 2]
    mixed = pfair.mix(docs, block_rows=2)
    assert mixed.columns[-5:] == ["_mix_source", "_mix_epoch", "mix_block", "_mix_slot", "mix_position"]
    assert carried(mixed.where("_mix_epoch = 0"), docs) == want
    assert pfair.mix(docs.limit(0)).columns == mixed.columns
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    assert scored.columns == [*docs.columns, "_score"] and carried(scored, docs) == want
    assert toxicity.drop_toxic(docs, labels.limit(0)).columns == docs.columns
    kept = superminhash.drop_near_copies(docs)
    # One of the copies, one of the repeated rows.
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 2
    items = spark.createDataFrame([(7, "other words are here now too")], "item_id long, text string")
    clean = decontamination.drop_contaminated(docs, items)
    assert clean.columns == docs.columns and clean.count() == len(ROWS) - 1


@pytest.fixture
def tables(spark, folder):
    def write(docs, labels, items):
        docs.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        items.write.parquet(f"{folder}/benchmark.parquet")
        return folder
    return write


def test_pipeline_of_empty_tables(spark, tables):
    sf_dir = tables(documents(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int"), spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, sf_dir).collect() == []


def test_pipeline_of_nulls_and_repeated_rows(spark, tables):
    """Nothing is toxic or in the benchmark: one of the copies goes, and one of the repeated rows."""
    docs = documents(spark, ROWS).select("doc_id", "text", "lang", "source", "n_chars")
    sf_dir = tables(docs, spark.createDataFrame([(1, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int"), spark.createDataFrame([(None, None), (1, "")], "item_id long, text string"))
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == [*docs.columns, "shard", "slot"]
    got = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert got == {(d, t) for d, t, *_ in ROWS} - {(2, ROWS[1][1])}

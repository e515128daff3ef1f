"""From ``documents`` to shards: toxic documents go, one of each group of near copies stays,
documents with benchmark passages go, sources are mixed to target weights, and the mixture is shuffled into shards.

Each stage reads what the stage before it wrote to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changeflow.llm.common import read
from changeflow.llm.decontamination import drop_contaminated
from changeflow.llm.pfair import mix
from changeflow.llm.sharding import shuffle_into_shards
from changeflow.llm.superminhash import drop_near_copies
from changeflow.llm.toxicity import drop_toxic
from changeflow.session import materialize, prepare


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go."""
    return drop_toxic(docs, read(prepare(spark), sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id."""
    prepare(spark)
    return drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a word of an occurring benchmark window go."""
    return drop_contaminated(docs, read(prepare(spark), sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; those of sources below their weight again, until it is met."""
    prepare(spark)
    return mix(docs).select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture in a uniformly random order over 40 shards."""
    prepare(spark)
    return shuffle_into_shards(docs)


STAGES = [("toxicity", without_toxic), ("near_dedup", without_near_copies), ("decontamination", without_benchmark),
          ("mixing", mixed), ("sharding", sharded)]

#: A fitted model, probabilistic candidates and a seeded shuffle: not SQL. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

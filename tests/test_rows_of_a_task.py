"""Shuffles are cut by the rows of the input."""

import pytest
from pyspark.sql import functions as F

from changeflow.session import tasks_by_rows


def test_shuffles_are_cut_by_rows(spark):
    """the cells of a task grew with the messages."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with tasks_by_rows(spark, 3_000, each=100):
        assert spark.range(3_000).groupBy((F.col("id") % 500).alias("k")).count().rdd.getNumPartitions() == 30
    with pytest.raises(ZeroDivisionError), tasks_by_rows(spark, 10):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        1 / 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"

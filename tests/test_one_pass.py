"""Messages are judged in one pass."""

from changeflow import registry
from changeflow.functions.parsing import with_error
from conftest import SF

registry.load()


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_messages_are_judged_in_one_pass(spark):
    """objects and letters each parsed all messages."""
    assert plan(registry.QUERIES["dead_letter_split"](spark, SF)).count("Relation [") == 2  # events and noise


def test_a_message_and_its_error(spark):
    texts = spark.createDataFrame([(t,) for t in ('{"a":1}', "[1]", "{", None, "7")], "value STRING")
    assert [r[1] for r in with_error(texts).collect()] == [None, "not an object", "malformed", "empty", "not an object"]

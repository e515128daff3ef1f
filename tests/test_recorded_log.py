"""Changes that are read several times are parsed once."""

import pytest

from changeflow import registry
from conftest import SF

registry.load()


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["snapshot_read_by_chunks", "apply_changes"])
def test_a_log_that_is_read_again_is_parsed_once(spark, name):
    """each reader of the changes made and parsed the event texts again."""
    assert "o_orderpriority" not in plan(registry.QUERIES[name](spark, SF))  # a column of the recorded table only

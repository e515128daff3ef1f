"""Tables of one layout."""

from changeflow.operators.changelog import slim_events
from changeflow.plans import tables as plans
from changeflow.registry.schemas import two_tables
from conftest import SF


def test_layouts_are_looked_for_once(spark, folder, monkeypatch):
    """the schema blocks of all events were read twice."""
    calls, specs = [], plans.S.table_specs
    monkeypatch.setattr(plans.S, "table_specs", lambda events: calls.append(1) or specs(events))
    assert set(plans.append_by_schema(slim_events(two_tables(spark, SF)), folder)) == {"orders", "customer"}
    assert len(calls) == 1

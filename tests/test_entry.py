"""Driver contract."""

import __spark_entry__ as E
from gearwatch import registry


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["equipment_id", "equipment_name", "criticality", "operating_hours",
                          "avg_vibration", "avg_temp", "status"]


def test_registry_consistent():
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 60
    # the corpus operators are named op<N>_ and come from their own subpackage, never from the core registry
    assert not any(n.startswith("op") or "pipeline" in n for n in registry.QUERIES)

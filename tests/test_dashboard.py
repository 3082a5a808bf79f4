"""The rollup-derived dashboard equals the direct datasets."""

import __spark_entry__ as E
from gearwatch.operators import dashboard as D

from .conftest import SMOKE


def test_rollup_datasets_equal_direct(spark, readings, equip):
    rollup = D.reading_rollup(readings).cache()
    derived = D.datasets_from_rollup(rollup, equip)
    qs = E.queries()
    assert len(derived) == 12
    for name, df in derived.items():
        direct = qs[name](spark, SMOKE)
        assert sorted(df.columns) == sorted(direct.columns), name
        a = sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
        b = sorted(tuple(r[c] for c in sorted(direct.columns)) for r in direct.collect())
        assert a == b, name
    rollup.unpersist()


def test_attribute_rollups_aggregate_before_join(spark):
    plan = E.queries()["ds_equip_vib"](spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    # the join sees per-equipment partials, not readings: an Aggregate sits below the Join
    join_at = plan.find("Join Inner")
    assert join_at >= 0 and "Aggregate" in plan[join_at:]


def test_refresh_dashboard_writes_all(spark, readings, equip):
    from gearwatch.session import scratch_path
    from gearwatch.sources.sinks import read_table
    paths = D.refresh_dashboard(readings, equip, scratch_path(spark, "t_dash"))
    assert len(paths) == 12
    direct = E.queries()["ds_status_counts"](spark, SMOKE)
    assert sorted(map(tuple, read_table(spark, paths["ds_status_counts"]).collect())) == \
        sorted(map(tuple, direct.collect()))

"""M0 invariants: measures recomputed at the query grain."""

import pytest
from pyspark.sql import functions as F

from gearwatch.plans.metric_views import availability_view, health_view, oee_view


def test_grand_total_is_sum_of_parts(readings):
    mv = availability_view(readings)
    total = mv.query([]).first()
    per = mv.query(["equipment_id"]).agg(F.sum("total_readings"), F.sum("normal_readings"),
                                         F.sum("abnormal_readings")).first()
    assert (total.total_readings, total.normal_readings, total.abnormal_readings) == tuple(per)
    assert total.total_readings == readings.count()


def test_ratio_not_averaged(readings):
    mv = availability_view(readings)
    total = mv.query([], ["total_readings", "normal_readings", "availability_pct"]).first()
    assert total.availability_pct == round(total.normal_readings * 100.0 / total.total_readings, 1)


def test_oee_bounded_by_factors(readings):
    for r in oee_view(readings).query(["equipment_id"]).collect():
        assert r.oee_pct <= min(r.availability_pct, r.performance_pct, r.quality_pct) + 0.1


def test_where_and_having(readings):
    mv = health_view(readings)
    one = mv.query(["equipment_id"], ["total_readings"], where=F.col("equipment_id") == "EQ-000001").collect()
    assert len(one) == 1
    hi = mv.query(["equipment_id"], ["avg_vibration"], having=F.col("avg_vibration") >= 7.0).collect()
    assert all(r.avg_vibration >= 7.0 for r in hi)


def test_unknown_measure(readings):
    with pytest.raises(KeyError):
        health_view(readings).query(["equipment_id"], ["no_such_measure"])


def test_ratio_types_are_double(readings):
    schema = dict(oee_view(readings).query(["equipment_id"]).dtypes)
    assert schema["oee_pct"] == "double" and schema["availability_pct"] == "double"


def test_combined_views_one_scan(readings):
    both = oee_view(readings).combine(health_view(readings))
    got = {r.equipment_id: (r.oee_pct, r.anomaly_rate_pct)
           for r in both.query(["equipment_id"], ["oee_pct", "anomaly_rate_pct"]).collect()}
    a = {r.equipment_id: r.oee_pct for r in oee_view(readings).query(["equipment_id"], ["oee_pct"]).collect()}
    b = {r.equipment_id: r.anomaly_rate_pct
         for r in health_view(readings).query(["equipment_id"], ["anomaly_rate_pct"]).collect()}
    assert got == {k: (a[k], b[k]) for k in a}
    plan = both.query(["equipment_id"], ["oee_pct", "anomaly_rate_pct"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 3  # lineitem, supplier, nation once each


def test_combine_rejects_conflicts(readings, spark):
    from gearwatch.operators.metric_view import MetricView
    other = MetricView("x", readings, {"equipment_id": "equipment_id"}, {"avg_vibration": "AVG(vibration_rms)"})
    with pytest.raises(ValueError):
        health_view(readings).combine(other)
    with pytest.raises(ValueError):
        health_view(readings).combine(MetricView("y", spark.range(1), {}, {}))


def test_metric_dictionary(spark, readings):
    from gearwatch.sources.catalog import metric_dictionary
    views = [availability_view(readings), health_view(readings), oee_view(readings)]
    rows = metric_dictionary(spark, views).collect()
    kinds = {(r.view, r.kind) for r in rows}
    assert ("mv_oee", "measure") in kinds and ("mv_equipment_availability", "dimension") in kinds
    assert sum(r.kind == "measure" for r in rows) == 18  # 4 + 10 + 4 measures
    assert sum(r.kind == "dimension" for r in rows) == 4  # 2 + 1 + 1 dimensions


def test_every_dimension_and_measure_is_described(spark, readings):
    from gearwatch import config as C
    from gearwatch.sources.catalog import metric_dictionary
    views = [availability_view(readings), health_view(readings), oee_view(readings)]
    rows = [r for r in metric_dictionary(spark, views).collect() if r.kind != "view"]
    assert len(rows) == 22 and all(r.comment == C.VIEW_COMMENTS[r.view][r.name] for r in rows)
    views[2].publish(spark, "gw_oee_told", ["equipment_id"])
    told = {f.name: f.metadata.get("comment") for f in spark.table("gw_oee_told").schema.fields}
    assert told == C.VIEW_COMMENTS["mv_oee"]

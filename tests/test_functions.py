"""Golden calls, NULL behaviour and the threshold grid (strict >)."""

import math

import pytest
from pyspark.sql import functions as F

from gearwatch import config as C
from gearwatch.functions.health import (estimate_rul, priority_score, register_sql_functions, score_fleet,
                                        status_of)


@pytest.fixture(scope="module")
def sqlfn(spark):
    register_sql_functions(spark)
    return spark


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()[0]


def test_golden_calls_sql(sqlfn):
    row = sqlfn.sql("SELECT assess_vibration_status(8.5, 72.0) AS s, estimate_rul(5000, 6.0, 65.0, 10000) AS r,"
                    " maintenance_priority_score(3000, '핵심', 45) AS p").first()
    assert row.s == C.STATUS_DANGER
    assert row.r == 4250.0
    assert row.p == 62.5


def test_golden_calls_columns(spark):
    assert one(spark, status_of(F.lit(8.5), F.lit(72.0))) == C.STATUS_DANGER
    assert one(spark, estimate_rul(F.lit(5000), F.lit(6.0), F.lit(65.0))) == 4250.0
    assert one(spark, priority_score(F.lit(3000.0), F.lit("핵심"), F.lit(45))) == 62.5


def test_default_argument_and_nulls(sqlfn):
    row = sqlfn.sql("SELECT estimate_rul(5000, 6.0, 65.0) AS a, estimate_rul(NULL, 6.0, 65.0) AS b,"
                    " maintenance_priority_score(NULL, 'x', 1) AS c,"
                    " maintenance_priority_score(3000, NULL, NULL) AS d").first()
    assert (row.a, row.b, row.c, row.d) == (4250.0, 0.0, 0.0, 63.0)
    # NULL temperature: the inner GREATEST skips it, so no temperature penalty
    assert sqlfn.sql("SELECT estimate_rul(5000, 6.0, NULL)").first()[0] == 4700.0
    n = F.lit(None).cast("double")
    assert one(sqlfn, estimate_rul(n, F.lit(6.0), F.lit(65.0))) == 0.0
    assert one(sqlfn, priority_score(n, F.lit("x"), F.lit(1))) == 0.0
    assert one(sqlfn, priority_score(F.lit(3000.0), F.lit(None).cast("string"), F.lit(None).cast("int"))) == 63.0


GRID = [
    (4.5, 0.0, C.STATUS_NORMAL), (4.50001, 0.0, C.STATUS_CAUTION), (7.0, 0.0, C.STATUS_CAUTION),
    (7.01, 0.0, C.STATUS_DANGER), (10.0, 0.0, C.STATUS_DANGER), (10.01, 0.0, C.STATUS_CRITICAL),
    (0.0, 60.0, C.STATUS_NORMAL), (0.0, 60.1, C.STATUS_CAUTION), (0.0, 75.0, C.STATUS_CAUTION),
    (0.0, 75.1, C.STATUS_DANGER), (0.0, 90.0, C.STATUS_DANGER), (0.0, 90.1, C.STATUS_CRITICAL),
    (None, 80.0, C.STATUS_DANGER), (8.0, None, C.STATUS_DANGER), (None, None, C.STATUS_NORMAL),
    (float("nan"), 0.0, C.STATUS_CRITICAL),  # NaN > 10 is true in Spark SQL
]


@pytest.mark.parametrize("v,t,expected", GRID)
def test_threshold_grid(sqlfn, v, t, expected):
    df = sqlfn.createDataFrame([(v, t)], "v double, t double")
    got_col = df.select(status_of("v", "t")).first()[0]
    got_sql = df.selectExpr("assess_vibration_status(v, t)").first()[0]
    assert got_col == got_sql == expected


def test_priority_clamps(spark):
    assert one(spark, priority_score(F.lit(-100000.0), F.lit("핵심"), F.lit(10000))) == 100.0
    assert one(spark, priority_score(F.lit(100000.0), F.lit("보조"), F.lit(0))) == 0.0


def test_sql_and_column_agree_on_table(sqlfn, readings, equip):
    from gearwatch.operators.aggregates import avg_of, per_equipment
    from gearwatch.sources.tables import maintenance_days
    agg = per_equipment(readings, signals=("vibration_rms", "temperature_c"), maxes=())
    base = maintenance_days(equip).join(agg, "equipment_id").select(
        "equipment_id", "criticality", "operating_hours", "last_maintenance_days",
        avg_of("sum_vibration_rms", "cnt_vibration_rms").alias("avg_vibration"),
        avg_of("sum_temperature_c", "cnt_temperature_c").alias("avg_temperature"))
    scored = score_fleet(base).selectExpr(
        "*", "assess_vibration_status(avg_vibration, avg_temperature) AS s2",
        "estimate_rul(operating_hours, avg_vibration, avg_temperature) AS r2",
        "maintenance_priority_score(rul_hours, criticality, last_maintenance_days) AS p2").collect()
    assert scored
    for r in scored:
        assert r.status == r.s2
        assert r.rul_hours == r.r2
        assert math.isclose(r.priority_score, r.p2, rel_tol=0, abs_tol=1e-9)


def test_plan_has_no_python_udf(sqlfn, readings):
    df = readings.selectExpr("assess_vibration_status(vibration_rms, temperature_c) AS s",
                             "estimate_rul(100, vibration_rms, temperature_c) AS r")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan

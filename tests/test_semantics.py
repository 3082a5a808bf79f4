"""Same name, different meaning: keep each definition where the reference uses it."""

from pyspark.sql import functions as F

from gearwatch import config as C
from gearwatch.operators import aggregates as A
from gearwatch.operators import medallion as M
from gearwatch.operators import readings as R
from gearwatch.plans.metric_views import health_view


def test_status_raw_vs_rounded(spark):
    # avg vibration 7.004 -> raw status 위험, rounded (7.0) status 주의
    rows = [("E1", "n", "l", C.CRIT_CORE, 100)]
    equip = spark.createDataFrame(rows, "equipment_id string, equipment_name string, line string, criticality string, operating_hours int")
    readings = spark.createDataFrame([("E1", 7.004, 20.0), ("E1", 7.004, 20.0)],
                                     "equipment_id string, vibration_rms double, temperature_c double")
    fleet = A.fleet_status(readings, equip).first()
    summary = A.equipment_summary(readings, equip).first()
    assert fleet.status == C.STATUS_DANGER and fleet.avg_vibration == 7.0
    assert summary.status == C.STATUS_CAUTION and summary.avg_vibration == 7.0


def test_warning_banded_vs_cumulative(readings):
    layers = M.build_layers(readings)
    gold = layers.gold.agg(F.sum("warning_count"), F.sum("critical_count")).first()
    mv = health_view(readings).query([], ["warning_count", "critical_count"]).first()
    silver = layers.silver
    band = silver.where((F.col("vibration_rms") > 7) & (F.col("vibration_rms") <= 10)).count()
    assert gold[0] == band                       # pipeline: 7 < vib <= 10 after quality drops
    cumulative = readings.where((F.col("vibration_rms") > 7) | (F.col("temperature_c") > 75)).count()
    assert mv.warning_count == cumulative        # metric view: vib > 7 OR temp > 75, raw table
    assert mv.warning_count > gold[0]
    crit_any = readings.where((F.col("vibration_rms") > 10) | (F.col("temperature_c") > 90)).count()
    assert mv.critical_count == crit_any and gold[1] <= crit_any


def test_recent_window_starts_yesterday_midnight(spark):
    df = spark.createDataFrame([("E", "2024-01-31 23:59:59"), ("E", "2024-02-01 00:00:00"), ("E", "2024-02-05 00:00:00")],
                               "equipment_id string, ts string").select(
        "equipment_id", F.to_timestamp_ntz("ts").alias("timestamp"))
    got = sorted(str(r.timestamp) for r in R.recent_readings(df).collect())
    assert got == ["2024-02-01 00:00:00", "2024-02-05 00:00:00"]  # no upper bound


def test_quality_null_is_violation(spark):
    from gearwatch.operators.quality import SILVER_RULES, expect_or_drop, quality_report
    df = spark.createDataFrame([(1.0, 20.0, 1.0), (None, 20.0, 1.0), (60.0, 20.0, -1.0), (1.0, None, None)],
                               "vibration_rms double, temperature_c double, pressure_bar double")
    kept, obs = expect_or_drop(df, SILVER_RULES)
    assert kept.count() == 1
    metrics = obs.get
    assert metrics["_rows"] == 4
    assert metrics[C.RULE_VALID_VIBRATION[0]] == 2 and metrics[C.RULE_VALID_TEMPERATURE[0]] == 1
    assert metrics[C.RULE_VALID_PRESSURE[0]] == 2
    rep = {r.rule: (r.passed, r.failed) for r in quality_report(df).collect()}
    assert all(p + f == 4 for p, f in rep.values())
    assert rep[C.RULE_VALID_PRESSURE[0]] == (2, 2)


def test_urgency_order(spark):
    gold = spark.createDataFrame([(6, 20, 8.0, 50.0), (5, 11, 8.0, 50.0), (0, 0, 8.0, 50.0), (0, 0, 1.0, 50.0)],
                                 "critical_count long, warning_count long, max_vibration double, max_temperature double")
    got = [r.urgency for r in M.build_recommendations(gold).collect()]
    assert got == [C.URGENCY_IMMEDIATE, C.URGENCY_THIS_WEEK, C.URGENCY_ROUTINE]

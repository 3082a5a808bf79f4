"""Business questions Q1-Q13 as fixed named queries over the metric views (+J-3, O3).

Each question is a metric-view query (measures recomputed at the asked
grain) plus ordinary filter / sort / limit; top-k uses a total order with an
equipment_id tie-break so results are deterministic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from .. import config as C
from .. import oracle as O
from ..operators import aggregates as A
from ..operators import dashboard as D
from ..operators import readings as R
from ..registry import register
from ..sources import tables as T
from .metric_views import (D_AVAILABILITY, D_HEALTH, D_OEE, availability_view, d_select, health_view,
                           oee_view)

# The fixture's counterpart of the reference's example machine "EQ-002".
FOCUS_EQUIPMENT = "EQ-000002"
TREND_DAYS = 7
OEE_TARGET = 60
VIBRATION_LEVEL = 7.0
TOP_K = 3

READINGS = "FROM sensor_readings"


def _readings(spark, sf_dir):
    return T.sensor_readings(spark, sf_dir)


@register("question_availability_by_equipment", covers="Q1 M1",
          oracle=O.with_views(f"SELECT equipment_id, {d_select(D_AVAILABILITY)} {READINGS} GROUP BY 1"))
def q1(spark, sf_dir):
    return availability_view(_readings(spark, sf_dir)).query(["equipment_id"])


@register("question_lowest_availability", covers="Q2 O3",
          oracle=O.with_views(f"SELECT equipment_id, {d_select(D_AVAILABILITY, ['availability_pct'])} {READINGS} "
                              "GROUP BY 1 ORDER BY availability_pct, equipment_id LIMIT 1"))
def q2(spark, sf_dir):
    return availability_view(_readings(spark, sf_dir)).query(
        ["equipment_id"], ["availability_pct"], order_by=["availability_pct", "equipment_id"], limit=1)


@register("question_daily_availability_trend", covers="Q3 M1",
          oracle=O.with_views(f"""SELECT CAST("timestamp" AS DATE) AS measurement_date, {d_select(D_AVAILABILITY)} {READINGS}
WHERE equipment_id = '{FOCUS_EQUIPMENT}' GROUP BY 1 ORDER BY 1"""))
def q3(spark, sf_dir):
    return availability_view(_readings(spark, sf_dir)).query(
        ["measurement_date"], where=F.col("equipment_id") == FOCUS_EQUIPMENT, order_by="measurement_date")


@register("question_oee_by_equipment", covers="Q4 M3",
          oracle=O.with_views(f"SELECT equipment_id, {d_select(D_OEE, ['oee_pct'])} {READINGS} GROUP BY 1 ORDER BY oee_pct"))
def q4(spark, sf_dir):
    return oee_view(_readings(spark, sf_dir)).query(["equipment_id"], ["oee_pct"], order_by=["oee_pct", "equipment_id"])


@register("question_oee_below_target", covers="Q5 M3 (post-aggregate filter)",
          oracle=O.with_views(f"SELECT * FROM (SELECT equipment_id, {d_select(D_OEE, ['oee_pct'])} {READINGS} GROUP BY 1) "
                              f"WHERE oee_pct < {OEE_TARGET} ORDER BY oee_pct"))
def q5(spark, sf_dir):
    return oee_view(_readings(spark, sf_dir)).query(
        ["equipment_id"], ["oee_pct"], having=F.col("oee_pct") < OEE_TARGET, order_by=["oee_pct", "equipment_id"])


@register("question_oee_factors", covers="Q6 M3",
          oracle=O.with_views(f"SELECT equipment_id, {d_select(D_OEE, ['availability_pct', 'performance_pct', 'quality_pct'])} "
                              f"{READINGS} GROUP BY 1 ORDER BY 1"))
def q6(spark, sf_dir):
    return oee_view(_readings(spark, sf_dir)).query(
        ["equipment_id"], ["availability_pct", "performance_pct", "quality_pct"], order_by="equipment_id")


@register("question_top_anomaly_rate", covers="Q7 M2 O3",
          oracle=O.with_views(f"SELECT equipment_id, {d_select(D_HEALTH, ['anomaly_rate_pct'])} {READINGS} "
                              f"GROUP BY 1 ORDER BY anomaly_rate_pct DESC, equipment_id LIMIT {TOP_K}"))
def q7(spark, sf_dir):
    return health_view(_readings(spark, sf_dir)).query(
        ["equipment_id"], ["anomaly_rate_pct"], order_by=[F.desc("anomaly_rate_pct"), F.asc("equipment_id")], limit=TOP_K)


@register("question_high_avg_vibration", covers="Q8 M2 (>= 7.0)",
          oracle=O.with_views(f"SELECT * FROM (SELECT equipment_id, {d_select(D_HEALTH, ['avg_vibration'])} {READINGS} "
                              f"GROUP BY 1) WHERE avg_vibration >= {VIBRATION_LEVEL} ORDER BY avg_vibration DESC"))
def q8(spark, sf_dir):
    return health_view(_readings(spark, sf_dir)).query(
        ["equipment_id"], ["avg_vibration"], having=F.col("avg_vibration") >= VIBRATION_LEVEL,
        order_by=[F.desc("avg_vibration"), F.asc("equipment_id")])


@register("question_max_temperature", covers="Q9 M2",
          oracle=O.with_views(f"SELECT equipment_id, {d_select(D_HEALTH, ['max_temperature'])} {READINGS} "
                              "GROUP BY 1 ORDER BY max_temperature DESC"))
def q9(spark, sf_dir):
    return health_view(_readings(spark, sf_dir)).query(
        ["equipment_id"], ["max_temperature"], order_by=[F.desc("max_temperature"), F.asc("equipment_id")])


_OEE_RATE_CTES = f"""
oee AS (SELECT equipment_id, {d_select(D_OEE, ['oee_pct'])} {READINGS} GROUP BY 1),
health AS (SELECT equipment_id, {d_select(D_HEALTH, ['anomaly_rate_pct'])} {READINGS} GROUP BY 1)"""


def _oee_and_rate(spark, sf_dir):
    """J-3: OEE and anomaly rate per equipment.  Both views read the same
    table at the same grain, so their measures are computed in one scan and
    one aggregate (``MetricView.combine``) rather than two joined results."""
    readings = _readings(spark, sf_dir)
    both = oee_view(readings).combine(health_view(readings))
    return both.query(["equipment_id"], ["oee_pct", "anomaly_rate_pct"])


@register("question_core_oee_anomaly", covers="Q10 J-3",
          oracle=O.with_views(f"""
SELECT e.equipment_id, e.equipment_name, o.oee_pct, h.anomaly_rate_pct
FROM equipment_master e JOIN oee o ON e.equipment_id = o.equipment_id JOIN health h ON e.equipment_id = h.equipment_id
WHERE e.criticality = {O.q(C.CRIT_CORE)} ORDER BY o.oee_pct""", _OEE_RATE_CTES))
def q10(spark, sf_dir):
    equip = T.equipment_master(spark, sf_dir).where(F.col("criticality") == C.CRIT_CORE)
    return (equip.select("equipment_id", "equipment_name").join(_oee_and_rate(spark, sf_dir), "equipment_id")
            .orderBy("oee_pct", "equipment_id"))


@register("question_anomaly_per_1000h", covers="Q11 J-3",
          oracle=O.with_views(f"""
SELECT e.equipment_id, e.operating_hours, h.anomaly_rate_pct,
       {O.rnd('h.anomaly_rate_pct * 1000.0 / e.operating_hours', 4)} AS anomaly_rate_per_1000h
FROM equipment_master e JOIN health h ON e.equipment_id = h.equipment_id
ORDER BY anomaly_rate_per_1000h DESC""", _OEE_RATE_CTES))
def q11(spark, sf_dir):
    rate = health_view(_readings(spark, sf_dir)).query(["equipment_id"], ["anomaly_rate_pct"])
    equip = T.equipment_master(spark, sf_dir).select("equipment_id", "operating_hours")
    out = equip.join(rate, "equipment_id").withColumn(
        "anomaly_rate_per_1000h",
        # a machine that has not run yet has no rate
        F.round(F.try_divide(F.col("anomaly_rate_pct") * F.lit(1000.0), F.col("operating_hours")), 4))
    return out.orderBy(F.desc("anomaly_rate_per_1000h"), "equipment_id")


_TREND_START = C.DEFAULT_AS_OF.date() - _dt.timedelta(days=TREND_DAYS - 1)  # the last day is included


@register("question_recent_vibration_trend", covers="Q12 W9",
          oracle=O.with_views(f"""
SELECT equipment_id, CAST("timestamp" AS DATE) AS dt, {O.rnd('AVG(vibration_rms)', 2)} AS avg_vib {READINGS}
WHERE equipment_id = '{FOCUS_EQUIPMENT}' AND CAST("timestamp" AS DATE) BETWEEN DATE '{_TREND_START}' AND {O.AS_OF_DATE}
GROUP BY 1, 2 ORDER BY dt"""))
def q12(spark, sf_dir):
    readings = _readings(spark, sf_dir)
    day = F.to_date("timestamp")
    recent = readings.where((F.col("equipment_id") == FOCUS_EQUIPMENT)
                            & (day >= F.lit(_TREND_START.isoformat()).cast("date"))
                            & (day <= R.as_of_date()))
    return D.trend(D.daily_partials(recent), "vibration_rms", "avg_vib", 2)


@register("question_danger_equipment", covers="Q13 F1",
          oracle=O.with_views(f"""
SELECT * FROM (
  SELECT e.equipment_id, e.equipment_name, e.criticality, e.operating_hours,
         {O.rnd('AVG(s.vibration_rms)', 2)} AS avg_vibration, {O.rnd('AVG(s.temperature_c)', 1)} AS avg_temp,
         {O.status_sql('AVG(s.vibration_rms)', 'AVG(s.temperature_c)')} AS status
  FROM equipment_master e JOIN sensor_readings s ON e.equipment_id = s.equipment_id GROUP BY ALL)
WHERE status = {O.q(C.STATUS_DANGER)} ORDER BY equipment_id"""))
def q13(spark, sf_dir):
    fleet = A.fleet_status(_readings(spark, sf_dir), T.equipment_master(spark, sf_dir))
    return R.filter_status(fleet, (C.STATUS_DANGER,))

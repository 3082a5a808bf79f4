"""M1-M5: the three metric views and their check queries (+A7-A9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .. import oracle as O
from ..operators.dashboard import reading_rollup
from ..operators.metric_view import MetricView
from ..registry import register
from ..sources import tables as T

NORMAL = f"vibration_rms <= {C.VIBRATION_DANGER} AND temperature_c <= {C.TEMPERATURE_DANGER}"
ABNORMAL = f"vibration_rms > {C.VIBRATION_DANGER} OR temperature_c > {C.TEMPERATURE_DANGER}"
OPTIMAL = f"vibration_rms <= {C.VIBRATION_CAUTION} AND temperature_c <= {C.TEMPERATURE_CAUTION}"
VALID = f"vibration_rms > 0 AND temperature_c > 0 AND pressure_bar > {C.OEE_MIN_PRESSURE}"
CRITICAL = f"vibration_rms > {C.VIBRATION_CRITICAL} OR temperature_c > {C.TEMPERATURE_CRITICAL}"


def cnt(cond: str) -> str:
    return f"COUNT(1) FILTER (WHERE {cond})"


def pct(cond: str) -> str:
    return f"{cnt(cond)} * 100.0 / COUNT(1)"


AVAILABILITY_MEASURES = {
    "total_readings": "COUNT(1)",
    "normal_readings": cnt(NORMAL),
    "abnormal_readings": cnt(ABNORMAL),
    "availability_pct": f"ROUND({pct(NORMAL)}, 1)",
}

HEALTH_MEASURES = {
    "avg_vibration": "ROUND(AVG(vibration_rms), 2)",
    "max_vibration": "ROUND(MAX(vibration_rms), 2)",
    "avg_temperature": "ROUND(AVG(temperature_c), 1)",
    "max_temperature": "ROUND(MAX(temperature_c), 1)",
    "avg_pressure": "ROUND(AVG(pressure_bar), 1)",
    "avg_current": "ROUND(AVG(current_amp), 2)",
    "total_readings": "COUNT(1)",
    "critical_count": cnt(CRITICAL),
    "warning_count": cnt(ABNORMAL),
    "anomaly_rate_pct": f"ROUND({pct(ABNORMAL)}, 2)",
}

OEE_MEASURES = {
    "availability_pct": f"ROUND({pct(NORMAL)}, 1)",
    "performance_pct": f"ROUND({pct(OPTIMAL)}, 1)",
    "quality_pct": f"ROUND({pct(VALID)}, 1)",
    "oee_pct": f"ROUND(({pct(NORMAL)}) * ({pct(OPTIMAL)}) * ({pct(VALID)}) / 10000, 1)",
}


def availability_view(readings: DataFrame) -> MetricView:
    return MetricView("mv_equipment_availability", readings,
                      {"equipment_id": "equipment_id", "measurement_date": "DATE(timestamp)"},
                      AVAILABILITY_MEASURES, comments=C.VIEW_COMMENTS["mv_equipment_availability"],
                      comment="Daily availability per equipment: share of readings in the normal range "
                              "(vibration <= 7.0 and temperature <= 75).")


def health_view(readings: DataFrame) -> MetricView:
    return MetricView("mv_equipment_health", readings, {"equipment_id": "equipment_id"}, HEALTH_MEASURES,
                      comments=C.VIEW_COMMENTS["mv_equipment_health"],
                      comment="Sensor health per equipment: averages, maxima and anomaly share.")


def oee_view(readings: DataFrame) -> MetricView:
    return MetricView("mv_oee", readings, {"equipment_id": "equipment_id"}, OEE_MEASURES, comments=C.VIEW_COMMENTS["mv_oee"],
                      comment="OEE = availability x performance x quality / 10000 on unrounded ratios.")


# ---- DuckDB twins of the measures ----------------------------------------------------

def d_cnt(cond):
    return f"COUNT(1) FILTER (WHERE {cond})"


def d_pct(cond):
    return f"(CAST({d_cnt(cond)} AS DOUBLE) * 100.0 / COUNT(1))"


D_AVAILABILITY = {
    "total_readings": "COUNT(1)",
    "normal_readings": d_cnt(NORMAL),
    "abnormal_readings": d_cnt(ABNORMAL),
    "availability_pct": O.rnd(d_pct(NORMAL), 1),
}
D_HEALTH = {
    "avg_vibration": O.rnd("AVG(vibration_rms)", 2),
    "max_vibration": O.rnd("MAX(vibration_rms)", 2),
    "avg_temperature": O.rnd("AVG(temperature_c)", 1),
    "max_temperature": O.rnd("MAX(temperature_c)", 1),
    "avg_pressure": O.rnd("AVG(pressure_bar)", 1),
    "avg_current": O.rnd("AVG(current_amp)", 2),
    "total_readings": "COUNT(1)",
    "critical_count": d_cnt(CRITICAL),
    "warning_count": d_cnt(ABNORMAL),
    "anomaly_rate_pct": O.rnd(d_pct(ABNORMAL), 2),
}
D_OEE = {
    "availability_pct": O.rnd(d_pct(NORMAL), 1),
    "performance_pct": O.rnd(d_pct(OPTIMAL), 1),
    "quality_pct": O.rnd(d_pct(VALID), 1),
    "oee_pct": O.rnd(f"{d_pct(NORMAL)} * {d_pct(OPTIMAL)} * {d_pct(VALID)} / 10000", 1),
}


def d_select(measures: dict[str, str], names=None) -> str:
    names = names or list(measures)
    return ", ".join(f"{measures[n]} AS {n}" for n in names)


@register("mv_availability_by_equipment_day", covers="M0 M1 A7 A8 P8 A12",
          oracle=O.with_views(f"""SELECT equipment_id, CAST("timestamp" AS DATE) AS measurement_date,
{d_select(D_AVAILABILITY)} FROM sensor_readings GROUP BY 1, 2"""))
def q_mv_availability_day(spark, sf_dir):
    return availability_view(T.sensor_readings(spark, sf_dir)).query(["equipment_id", "measurement_date"])


@register("mv_availability_total", covers="M0 M1 (grand total)",
          oracle=O.with_views(f"SELECT {d_select(D_AVAILABILITY)} FROM sensor_readings"))
def q_mv_availability_total(spark, sf_dir):
    return availability_view(T.sensor_readings(spark, sf_dir)).query([])


@register("mv_health", covers="M0 M2 A7 A8",
          oracle=O.with_views(f"SELECT equipment_id, {d_select(D_HEALTH)} FROM sensor_readings GROUP BY 1"))
def q_mv_health(spark, sf_dir):
    return health_view(T.sensor_readings(spark, sf_dir)).query(["equipment_id"])


@register("mv_oee", covers="M0 M3 M4 A9 O1",
          oracle=O.with_views(f"SELECT equipment_id, {d_select(D_OEE)} FROM sensor_readings GROUP BY 1 ORDER BY oee_pct"))
def q_mv_oee(spark, sf_dir):
    return oee_view(T.sensor_readings(spark, sf_dir)).query(["equipment_id"], order_by=["oee_pct", "equipment_id"])


M5_MEASURES = ["avg_vibration", "avg_temperature", "anomaly_rate_pct", "warning_count"]


@register("mv_health_check", covers="M5 O1",
          oracle=O.with_views(f"""SELECT equipment_id, {d_select(D_HEALTH, M5_MEASURES)} FROM sensor_readings
GROUP BY 1 ORDER BY anomaly_rate_pct DESC"""))
def q_mv_health_check(spark, sf_dir):
    return health_view(T.sensor_readings(spark, sf_dir)).query(
        ["equipment_id"], M5_MEASURES, order_by=[F.desc("anomaly_rate_pct"), F.asc("equipment_id")])


# ---- the same views over the shared rollup (aggregate-aware serving) ------------------
# Each measure merges the rollup's partials; results equal the readings-based views
# (same oracle SQL), while a query reads (equipment, day, hour) rows instead of readings.

def _rpct(col: str) -> str:
    return f"SUM({col}) * 100.0 / SUM(n)"


def _ravg(signal: str) -> str:
    return f"SUM(sum_{signal}) / SUM(cnt_{signal})"


ROLLUP_AVAILABILITY = {
    "total_readings": "SUM(n)",
    "normal_readings": "SUM(normal_n)",
    "abnormal_readings": "SUM(abnormal_n)",
    "availability_pct": f"ROUND({_rpct('normal_n')}, 1)",
}
ROLLUP_HEALTH = {
    "avg_vibration": f"ROUND({_ravg('vibration_rms')}, 2)",
    "max_vibration": "ROUND(MAX(max_vibration_rms), 2)",
    "avg_temperature": f"ROUND({_ravg('temperature_c')}, 1)",
    "max_temperature": "ROUND(MAX(max_temperature_c), 1)",
    "avg_pressure": f"ROUND({_ravg('pressure_bar')}, 1)",
    "avg_current": f"ROUND({_ravg('current_amp')}, 2)",
    "total_readings": "SUM(n)",
    "critical_count": "SUM(critical_n)",
    "warning_count": "SUM(abnormal_n)",
    "anomaly_rate_pct": f"ROUND({_rpct('abnormal_n')}, 2)",
}
ROLLUP_OEE = {
    "availability_pct": f"ROUND({_rpct('normal_n')}, 1)",
    "performance_pct": f"ROUND({_rpct('optimal_n')}, 1)",
    "quality_pct": f"ROUND({_rpct('valid_n')}, 1)",
    "oee_pct": f"ROUND(({_rpct('normal_n')}) * ({_rpct('optimal_n')}) * ({_rpct('valid_n')}) / 10000, 1)",
}
ROLLUP_DIMS = {"equipment_id": "equipment_id", "measurement_date": "date", "hour": "hr"}


def rollup_views(rollup: DataFrame) -> dict[str, MetricView]:
    """The three metric views served from ``dashboard.reading_rollup``."""
    return {"availability": MetricView("mv_equipment_availability", rollup, ROLLUP_DIMS, ROLLUP_AVAILABILITY),
            "health": MetricView("mv_equipment_health", rollup, ROLLUP_DIMS, ROLLUP_HEALTH),
            "oee": MetricView("mv_oee", rollup, ROLLUP_DIMS, ROLLUP_OEE)}


def _rollup(spark, sf_dir):
    return rollup_views(reading_rollup(T.sensor_readings(spark, sf_dir)))


@register("mv_availability_from_rollup", covers="M1 over the shared rollup",
          oracle=O.with_views(f"""SELECT equipment_id, CAST("timestamp" AS DATE) AS measurement_date,
{d_select(D_AVAILABILITY)} FROM sensor_readings GROUP BY 1, 2"""))
def q_mv_availability_from_rollup(spark, sf_dir):
    return _rollup(spark, sf_dir)["availability"].query(["equipment_id", "measurement_date"])


@register("mv_health_from_rollup", covers="M2 over the shared rollup",
          oracle=O.with_views(f"SELECT equipment_id, {d_select(D_HEALTH)} FROM sensor_readings GROUP BY 1"))
def q_mv_health_from_rollup(spark, sf_dir):
    return _rollup(spark, sf_dir)["health"].query(["equipment_id"])


@register("mv_oee_from_rollup", covers="M3 over the shared rollup",
          oracle=O.with_views(f"SELECT equipment_id, {d_select(D_OEE)} FROM sensor_readings GROUP BY 1 ORDER BY oee_pct"))
def q_mv_oee_from_rollup(spark, sf_dir):
    return _rollup(spark, sf_dir)["oee"].query(["equipment_id"], order_by=["oee_pct", "equipment_id"])

"""Dashboard datasets W1-W12 (+A10-A12, O1, O2) and the shared rollup."""

from __future__ import annotations

from .. import config as C
from .. import oracle as O
from ..operators import aggregates as A
from ..operators import dashboard as D
from ..registry import register
from ..sources import tables as T

JOIN = "FROM equipment_master e JOIN sensor_readings s ON e.equipment_id = s.equipment_id"


def _inputs(spark, sf_dir):
    return T.sensor_readings(spark, sf_dir), T.equipment_master(spark, sf_dir)


def _partials(readings):
    return A.per_equipment(readings, signals=("vibration_rms", "temperature_c", "pressure_bar"),
                           maxes=("vibration_rms",))


def _name_rollup(name):
    attr, value, signal, digits, desc = D.NAME_ROLLUPS[name]
    order = "DESC" if desc else ""
    sql = O.with_views(f"SELECT e.{attr}, {O.rnd(f'AVG(s.{signal})', digits)} AS {value} {JOIN} "
                       f"GROUP BY e.{attr} ORDER BY {value} {order}")

    def run(spark, sf_dir):
        readings, equip = _inputs(spark, sf_dir)
        return D.avg_by_attribute(_partials(readings), equip, attr, value, signal, digits, desc)
    run.__name__ = f"q_{name}"
    return sql, run


for _name, _cov in (("ds_equip_vib", "W1 J-1 O1"), ("ds_equip_temp", "W2 J-1 O1"),
                    ("ds_equip_press", "W6 J-1 O1"), ("ds_line_vib", "W8 J-1 O1")):
    _sql, _fn = _name_rollup(_name)
    register(_name, oracle=_sql, covers=_cov)(_fn)


@register("ds_status_counts", covers="W3 A10 O2",
          oracle=O.with_views(f"""
WITH eq AS (SELECT e.equipment_id, {O.status_sql('AVG(s.vibration_rms)', 'AVG(s.temperature_c)')} AS status
            {JOIN} GROUP BY e.equipment_id)
SELECT status, COUNT(*) AS cnt FROM eq GROUP BY status
ORDER BY CASE status WHEN {O.q(C.STATUS_CRITICAL)} THEN 1 WHEN {O.q(C.STATUS_DANGER)} THEN 2
                     WHEN {O.q(C.STATUS_CAUTION)} THEN 3 ELSE 4 END"""))
def q_ds_status_counts(spark, sf_dir):
    return A.status_counts(*_inputs(spark, sf_dir))


@register("ds_equip_hours", covers="W4 O1",
          oracle=O.with_views("SELECT equipment_name, operating_hours FROM equipment_master ORDER BY operating_hours DESC"))
def q_ds_equip_hours(spark, sf_dir):
    return D.equip_hours(T.equipment_master(spark, sf_dir))


@register("ds_equip_max_vib", covers="W5 O1",
          oracle=O.with_views(f"SELECT e.equipment_name, {O.rnd('MAX(s.vibration_rms)', 2)} AS max_vibration {JOIN} "
                              "GROUP BY e.equipment_name ORDER BY max_vibration DESC"))
def q_ds_equip_max_vib(spark, sf_dir):
    readings, equip = _inputs(spark, sf_dir)
    return D.equip_max_vib(_partials(readings), equip)


@register("ds_crit_vib", covers="W7 O2",
          oracle=O.with_views(f"""SELECT e.criticality, {O.rnd('AVG(s.vibration_rms)', 2)} AS avg_vibration {JOIN}
GROUP BY e.criticality ORDER BY CASE e.criticality WHEN {O.q(C.CRIT_CORE)} THEN 1 WHEN {O.q(C.CRIT_IMPORTANT)} THEN 2 ELSE 3 END"""))
def q_ds_crit_vib(spark, sf_dir):
    readings, equip = _inputs(spark, sf_dir)
    return D.crit_vib(_partials(readings), equip)


@register("ds_vibration_trend", covers="W9 A12 P8",
          oracle=O.with_views(f"""SELECT equipment_id, CAST("timestamp" AS DATE) AS dt,
{O.rnd('AVG(vibration_rms)', 2)} AS avg_vib FROM sensor_readings GROUP BY equipment_id, CAST("timestamp" AS DATE) ORDER BY dt"""))
def q_ds_vibration_trend(spark, sf_dir):
    readings, _ = _inputs(spark, sf_dir)
    return D.trend(D.daily_partials(readings), "vibration_rms", "avg_vib", 2)


@register("ds_temp_trend", covers="W10 A12 P8",
          oracle=O.with_views(f"""SELECT equipment_id, CAST("timestamp" AS DATE) AS dt,
{O.rnd('AVG(temperature_c)', 1)} AS avg_temp FROM sensor_readings GROUP BY equipment_id, CAST("timestamp" AS DATE) ORDER BY dt"""))
def q_ds_temp_trend(spark, sf_dir):
    readings, _ = _inputs(spark, sf_dir)
    return D.trend(D.daily_partials(readings), "temperature_c", "avg_temp", 1)


@register("ds_anomaly_hour", covers="W11 A12 P1",
          oracle=O.with_views(f"""SELECT CAST(HOUR("timestamp") AS INTEGER) AS hr, COUNT(*) AS cnt FROM sensor_readings
WHERE vibration_rms > {C.VIBRATION_DANGER} OR temperature_c > {C.TEMPERATURE_DANGER} GROUP BY 1 ORDER BY hr"""))
def q_ds_anomaly_hour(spark, sf_dir):
    readings, _ = _inputs(spark, sf_dir)
    return A.anomaly_by_hour(readings)


@register("ds_scatter", covers="W12 A11",
          oracle=O.with_views(f"""SELECT e.equipment_name, e.criticality, {O.rnd('AVG(s.vibration_rms)', 2)} AS avg_vib,
{O.rnd('AVG(s.temperature_c)', 1)} AS avg_temp {JOIN} GROUP BY ALL"""))
def q_ds_scatter(spark, sf_dir):
    readings, equip = _inputs(spark, sf_dir)
    return D.scatter(_partials(readings), equip)


def _rollup_sql():
    v, t, p = "vibration_rms", "temperature_c", "pressure_bar"
    sums = ", ".join(f"SUM({s}) AS sum_{s}, COUNT({s}) AS cnt_{s}" for s in A.SIGNALS)
    return O.with_views(f"""
SELECT equipment_id, CAST("timestamp" AS DATE) AS date, CAST(HOUR("timestamp") AS INTEGER) AS hr, COUNT(*) AS n, {sums},
       MAX({v}) AS max_vibration_rms, MAX({t}) AS max_temperature_c,
       COUNT(*) FILTER (WHERE {v} <= {C.VIBRATION_DANGER} AND {t} <= {C.TEMPERATURE_DANGER}) AS normal_n,
       COUNT(*) FILTER (WHERE {v} > {C.VIBRATION_DANGER} OR {t} > {C.TEMPERATURE_DANGER}) AS abnormal_n,
       COUNT(*) FILTER (WHERE {v} <= {C.VIBRATION_CAUTION} AND {t} <= {C.TEMPERATURE_CAUTION}) AS optimal_n,
       COUNT(*) FILTER (WHERE {v} > 0 AND {t} > 0 AND {p} > {C.OEE_MIN_PRESSURE}) AS valid_n,
       COUNT(*) FILTER (WHERE {v} > {C.VIBRATION_CRITICAL} OR {t} > {C.TEMPERATURE_CRITICAL}) AS critical_n
FROM sensor_readings GROUP BY 1, 2, 3""")


@register("dashboard_rollup", covers="shared rollup for W1-W12, M1-M3", oracle=_rollup_sql())
def q_dashboard_rollup(spark, sf_dir):
    readings, _ = _inputs(spark, sf_dir)
    return D.reading_rollup(readings)

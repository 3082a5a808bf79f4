"""Source views, fleet status and EDA queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from .. import oracle as O
from ..functions.health import register_sql_functions, score_fleet
from ..operators import aggregates as A
from ..operators import readings as R
from ..registry import register
from ..sources import tables as T
from ..sources.catalog import equipment_listing


def inputs(spark, sf_dir):
    return T.sensor_readings(spark, sf_dir), T.equipment_master(spark, sf_dir)


@register("equipment_master", covers="S1 S2 fixture mapping",
          oracle=O.with_views("SELECT equipment_id, equipment_name, line, criticality, operating_hours FROM equipment_master"))
def q_equipment_master(spark, sf_dir):
    return T.equipment_master(spark, sf_dir)


@register("sensor_readings", covers="S1 fixture mapping",
          oracle=O.with_views('SELECT equipment_id, "timestamp", vibration_rms, temperature_c, pressure_bar, current_amp FROM sensor_readings'))
def q_sensor_readings(spark, sf_dir):
    return T.sensor_readings(spark, sf_dir)


FLEET_ORACLE = O.with_views(f"""
SELECT e.equipment_id, e.equipment_name, e.criticality, e.operating_hours,
       {O.rnd('AVG(s.vibration_rms)', 2)} AS avg_vibration,
       {O.rnd('AVG(s.temperature_c)', 1)} AS avg_temp,
       {O.status_sql('AVG(s.vibration_rms)', 'AVG(s.temperature_c)')} AS status
FROM equipment_master e JOIN sensor_readings s ON e.equipment_id = s.equipment_id
GROUP BY ALL ORDER BY e.equipment_id""")


@register("fleet_status", covers="F1 J-1 A11 O1 U1", oracle=FLEET_ORACLE)
def q_fleet_status(spark, sf_dir):
    readings, equip = inputs(spark, sf_dir)
    return A.fleet_status(readings, equip)


@register("equipment_listing", covers="S8",
          oracle=O.with_views("""
SELECT equipment_id,
       to_json({'equipment_id': equipment_id, 'equipment_name': equipment_name, 'line': line,
                'criticality': criticality, 'operating_hours': operating_hours}) AS record
FROM equipment_master"""))
def q_equipment_listing(spark, sf_dir):
    return equipment_listing(T.equipment_master(spark, sf_dir))


@register("ingest_daily_batch", covers="S5",
          oracle=O.with_views(f"""
SELECT equipment_id, "timestamp", vibration_rms, temperature_c, pressure_bar, current_amp
FROM sensor_readings WHERE CAST("timestamp" AS DATE) = {O.AS_OF_DATE}"""))
def q_ingest_daily_batch(spark, sf_dir):
    readings, _ = inputs(spark, sf_dir)
    return R.ingest_daily_batch(readings, C.DEFAULT_AS_OF.date())


@register("basic_stats", covers="A1 O1",
          oracle=O.with_views(f"""
SELECT equipment_id, AVG(vibration_rms) AS avg_vibration, MAX(vibration_rms) AS max_vibration,
       AVG(temperature_c) AS avg_temperature, MAX(temperature_c) AS max_temperature,
       {O.r6('STDDEV_SAMP(vibration_rms)')} AS std_vibration, COUNT(*) AS reading_count
FROM sensor_readings GROUP BY equipment_id ORDER BY equipment_id"""))
def q_basic_stats(spark, sf_dir):
    readings, _ = inputs(spark, sf_dir)
    return A.basic_stats(readings).withColumn("std_vibration", F.round("std_vibration", 6))


ANOMALY_TYPE_SQL = (f"CASE WHEN vibration_rms > {C.VIBRATION_DANGER} AND temperature_c > {C.TEMPERATURE_DANGER} "
                    f"THEN {O.q(C.ANOMALY_BOTH)} WHEN vibration_rms > {C.VIBRATION_DANGER} THEN {O.q(C.ANOMALY_VIBRATION)} "
                    f"ELSE {O.q(C.ANOMALY_TEMPERATURE)} END")
ANOMALY_WHERE = f"(vibration_rms > {C.VIBRATION_DANGER} OR temperature_c > {C.TEMPERATURE_DANGER})"


@register("anomalies", covers="P1 P2",
          oracle=O.with_views(f"""
SELECT equipment_id, "timestamp", vibration_rms, temperature_c, pressure_bar, current_amp,
       {ANOMALY_TYPE_SQL} AS anomaly_type
FROM sensor_readings WHERE {ANOMALY_WHERE}"""))
def q_anomalies(spark, sf_dir):
    readings, _ = inputs(spark, sf_dir)
    return R.tag_anomaly_type(R.filter_anomalies(readings))


@register("anomaly_counts", covers="A2 P1 P2",
          oracle=O.with_views(f"""
SELECT equipment_id, {ANOMALY_TYPE_SQL} AS anomaly_type, COUNT(*) AS "count"
FROM sensor_readings WHERE {ANOMALY_WHERE}
GROUP BY 1, 2 ORDER BY equipment_id"""))
def q_anomaly_counts(spark, sf_dir):
    readings, _ = inputs(spark, sf_dir)
    return A.anomaly_counts(readings)


@register("equipment_summary", covers="A3 J-1 O1",
          oracle=O.with_views(f"""
WITH g AS (
  SELECT e.equipment_id, e.equipment_name, e.criticality, e.operating_hours,
         {O.rnd('AVG(s.vibration_rms)', 2)} AS avg_vibration,
         {O.rnd('AVG(s.temperature_c)', 1)} AS avg_temp
  FROM sensor_readings s JOIN equipment_master e ON s.equipment_id = e.equipment_id
  GROUP BY 1, 2, 3, 4)
SELECT *, {O.status_sql('avg_vibration', 'avg_temp')} AS status FROM g ORDER BY avg_vibration DESC"""))
def q_equipment_summary(spark, sf_dir):
    readings, equip = inputs(spark, sf_dir)
    return A.equipment_summary(readings, equip)


@register("recent_readings", covers="P3",
          oracle=O.with_views(f"""
SELECT * FROM sensor_readings WHERE "timestamp" >= {O.RECENT_START}"""))
def q_recent_readings(spark, sf_dir):
    readings, _ = inputs(spark, sf_dir)
    return R.recent_readings(readings)


@register("score_fleet", covers="U1 U2 U3 U5",
          oracle=O.with_views(f"""
WITH f AS (
  SELECT e.equipment_id, e.criticality, e.operating_hours, e.operating_hours % 365 AS last_maintenance_days,
         AVG(s.vibration_rms) AS avg_vibration, AVG(s.temperature_c) AS avg_temperature
  FROM equipment_master e JOIN sensor_readings s ON e.equipment_id = s.equipment_id
  GROUP BY ALL),
r AS (SELECT *, {O.status_sql('avg_vibration', 'avg_temperature')} AS status,
             {O.rul_sql('operating_hours', 'avg_vibration', 'avg_temperature')} AS rul_hours FROM f)
SELECT *, {O.priority_sql('rul_hours', 'criticality', 'last_maintenance_days')} AS priority_score FROM r"""))
def q_score_fleet(spark, sf_dir):
    readings, equip = inputs(spark, sf_dir)
    agg = A.per_equipment(readings, signals=("vibration_rms", "temperature_c"), maxes=())
    base = (T.maintenance_days(equip).join(agg, "equipment_id")
            .select("equipment_id", "criticality", "operating_hours", "last_maintenance_days",
                    A.avg_of("sum_vibration_rms", "cnt_vibration_rms").alias("avg_vibration"),
                    A.avg_of("sum_temperature_c", "cnt_temperature_c").alias("avg_temperature")))
    return score_fleet(base)


FLEET_SQL = """
WITH machine AS (
  SELECT equipment_id, avg(vibration_rms) AS v, avg(temperature_c) AS t FROM sensor_readings GROUP BY ALL)
SELECT equipment_id, equipment_name, criticality, operating_hours, round(v, 2) AS avg_vibration,
       round(t, 1) AS avg_temp, assess_vibration_status(v, t) AS status
FROM machine JOIN equipment_master USING (equipment_id)
ORDER BY equipment_id"""


@register("fleet_status_sql", covers="F1 A11 U1 (SQL text + registered SQL function)", oracle=FLEET_ORACLE)
def q_fleet_status_sql(spark, sf_dir):
    """F1 as SQL text over temp views, using the session's SQL function.

    Readings are averaged per machine first, so the join takes one row a machine.
    """
    register_sql_functions(spark)
    T.equipment_master(spark, sf_dir).createOrReplaceTempView("equipment_master")
    T.sensor_readings(spark, sf_dir).createOrReplaceTempView("sensor_readings")
    return spark.sql(FLEET_SQL)

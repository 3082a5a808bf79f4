"""Daily job queries: A4, B1-B3, S4."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from .. import oracle as O
from ..operators import aggregates as A
from ..operators import alerts as AL
from ..operators import readings as R
from ..registry import register
from ..session import scratch_path
from ..sources import tables as T
from ..sources.ledger import append_run, read_runs
from ..sources.sinks import append_batch, read_table

HEALTH_CTE = f"""
health AS (
  SELECT equipment_id, AVG(vibration_rms) AS avg_vibration, MAX(vibration_rms) AS max_vibration,
         AVG(temperature_c) AS avg_temperature, MAX(temperature_c) AS max_temperature,
         AVG(pressure_bar) AS avg_pressure, STDDEV_SAMP(vibration_rms) AS vibration_volatility,
         COUNT(*) AS reading_count, {O.AS_OF_TS} AS analysis_timestamp
  FROM sensor_readings WHERE "timestamp" >= {O.RECENT_START}
  GROUP BY equipment_id)"""

ALERTS_CTE = HEALTH_CTE + f""",
scored AS (
  SELECT h.equipment_id, e.equipment_name, h.avg_vibration, h.avg_temperature,
         {O.status_sql('h.avg_vibration', 'h.avg_temperature')} AS status,
         {O.rul_sql('e.operating_hours', 'h.avg_vibration', 'h.avg_temperature')} AS rul_hours
  FROM health h JOIN equipment_master e ON h.equipment_id = e.equipment_id)"""

ALERTS_SELECT = f"""
SELECT equipment_id, equipment_name, status,
       {O.q(C.ALERT_PREFIX)} || status || '] ' || equipment_name || ' (' || equipment_id || ') - '
       || {O.q(C.ALERT_VIBRATION)} || CAST({O.rnd('avg_vibration', 1)} AS VARCHAR) || {O.q(C.ALERT_VIBRATION_UNIT)}
       || {O.q(C.ALERT_TEMPERATURE)} || CAST({O.rnd('avg_temperature', 1)} AS VARCHAR) || {O.q(C.ALERT_TEMPERATURE_UNIT)}
       || {O.q(C.ALERT_RUL)} || CAST({O.rnd('rul_hours', 0)} AS VARCHAR) || {O.q(C.ALERT_RUL_UNIT)} AS alert_message,
       avg_vibration, avg_temperature, rul_hours, {O.AS_OF_TS} AS created_at
FROM scored WHERE status IN ({O.q(C.STATUS_DANGER)}, {O.q(C.STATUS_CRITICAL)})"""


@register("daily_health", covers="A4 P3",
          oracle=O.with_views(f"""SELECT equipment_id, avg_vibration, max_vibration, avg_temperature, max_temperature,
       avg_pressure, {O.r6('vibration_volatility')} AS vibration_volatility, reading_count, analysis_timestamp
FROM health""", HEALTH_CTE))
def q_daily_health(spark, sf_dir):
    readings = T.sensor_readings(spark, sf_dir)
    return A.daily_health(readings).withColumn("vibration_volatility", F.round("vibration_volatility", 6))


@register("alerts", covers="B1 B2 J-2 U1 U2 P4", oracle=O.with_views(ALERTS_SELECT, ALERTS_CTE))
def q_alerts(spark, sf_dir):
    readings, equip = T.sensor_readings(spark, sf_dir), T.equipment_master(spark, sf_dir)
    return AL.generate_alerts(A.daily_health(readings), equip)


@register("daily_job_run", covers="B3 S4 S5 S3", oracle=O.with_views(ALERTS_SELECT, ALERTS_CTE))
def q_daily_job_run(spark, sf_dir):
    """Store history partitioned by date, re-ingest the run day (idempotent),
    analyze with partition pruning, append alerts; return the alerts table."""
    readings, equip = T.sensor_readings(spark, sf_dir), T.equipment_master(spark, sf_dir)
    base = scratch_path(spark, "daily")
    store = append_batch(R.reading_date(readings), f"{base}/sensor_readings", "date")  # existing history
    paths = AL.daily_run(spark, store, readings, equip, C.DEFAULT_AS_OF.date(), base)
    return read_table(spark, paths["alerts"]).drop("date")


RUN_DAY = f"CAST({O.AS_OF_TS} AS DATE)"
RUN_OF = f"""CASE WHEN CAST("timestamp" AS DATE) <> {RUN_DAY} THEN 'history' WHEN HOUR("timestamp") < 12 THEN 'morning' ELSE 'evening' END"""


def _two_files(spark, sf_dir):
    """The run day's readings come in two files; the second is handed over twice."""
    readings, equip = T.sensor_readings(spark, sf_dir), T.equipment_master(spark, sf_dir)
    base, day = scratch_path(spark, "daily_files"), C.DEFAULT_AS_OF.date()
    store = f"{base}/sensor_readings"
    append_run(R.reading_date(readings).where(F.col("date") != F.lit(day)), store, "history", "date")
    first = F.hour("timestamp") < 12
    for run_id, file in (("morning", readings.where(first)), ("evening", readings.where(~first)), ("evening", readings.where(~first))):
        paths = AL.daily_run(spark, store, file, equip, day, base, run_id=run_id)
    return paths


@register("daily_files_store", covers="B3 S4 S5",
          oracle=O.with_views(f"""
SELECT {RUN_OF} AS run_id, CAST("timestamp" AS DATE) AS date, COUNT(*) AS n, SUM(current_amp) AS current_sum
FROM sensor_readings GROUP BY 1, 2"""))
def q_daily_files_store(spark, sf_dir):
    """What the store holds of each run and day after two files of a day and a retry."""
    stored = read_runs(spark, _two_files(spark, sf_dir)["readings"])
    return stored.groupBy("run_id", "date").agg(F.count(F.lit(1)).alias("n"), F.sum("current_amp").alias("current_sum"))


@register("daily_files_alerts", covers="B3 B1 S4", oracle=O.with_views(ALERTS_SELECT, ALERTS_CTE))
def q_daily_files_alerts(spark, sf_dir):
    """The alerts of the last run, which has seen both files of the day."""
    return read_runs(spark, _two_files(spark, sf_dir)["alerts"], ["evening"]).drop("date", "run_id")

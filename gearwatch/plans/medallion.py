"""Medallion queries: D3-D8, P5-P10, A5, A6."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from .. import oracle as O
from ..operators import medallion as M
from ..operators import quality as Q
from ..registry import register
from ..session import scratch_path
from ..sources import tables as T
from ..sources.sinks import read_table, write_snapshot

BRONZE_SQL = f"""SELECT *, {O.AS_OF_TS} AS ingestion_timestamp, {O.q(C.BRONZE_SOURCE)} AS source FROM sensor_readings"""


def _sig_status(col, crit, danger, caution):
    return (f"CASE WHEN {col} > {crit} THEN {O.q(C.STATUS_CRITICAL)} WHEN {col} > {danger} THEN {O.q(C.STATUS_DANGER)} "
            f"WHEN {col} > {caution} THEN {O.q(C.STATUS_CAUTION)} ELSE {O.q(C.STATUS_NORMAL)} END")


def _keep(cond):
    return f"COALESCE({cond}, FALSE)"


SILVER_CTE = f"""
bronze AS ({BRONZE_SQL}),
silver AS (
  SELECT *, {_sig_status('vibration_rms', C.VIBRATION_CRITICAL, C.VIBRATION_DANGER, C.VIBRATION_CAUTION)} AS vibration_status,
         {_sig_status('temperature_c', C.TEMPERATURE_CRITICAL, C.TEMPERATURE_DANGER, C.TEMPERATURE_CAUTION)} AS temperature_status,
         CAST("timestamp" AS DATE) AS date
  FROM bronze
  WHERE {_keep(C.RULE_VALID_VIBRATION[1])} AND {_keep(C.RULE_VALID_TEMPERATURE[1])})"""

GOLD_CTE = SILVER_CTE + f""",
gold AS (
  SELECT equipment_id, date,
         AVG(vibration_rms) AS avg_vibration, MAX(vibration_rms) AS max_vibration,
         AVG(temperature_c) AS avg_temperature, MAX(temperature_c) AS max_temperature,
         AVG(pressure_bar) AS avg_pressure, {O.r6('STDDEV_SAMP(vibration_rms)')} AS vibration_std,
         COUNT(*) AS reading_count,
         CAST(SUM(CASE WHEN vibration_status = {O.q(C.STATUS_CRITICAL)} THEN 1 ELSE 0 END) AS BIGINT) AS critical_count,
         CAST(SUM(CASE WHEN vibration_status = {O.q(C.STATUS_DANGER)} THEN 1 ELSE 0 END) AS BIGINT) AS warning_count
  FROM silver GROUP BY equipment_id, date)"""

RECO_SELECT = f"""
SELECT *, CASE WHEN critical_count > {C.URGENCY_CRITICAL_OVER} THEN {O.q(C.URGENCY_IMMEDIATE)}
               WHEN warning_count > {C.URGENCY_WARNING_OVER} THEN {O.q(C.URGENCY_THIS_WEEK)}
               ELSE {O.q(C.URGENCY_ROUTINE)} END AS urgency,
       {O.AS_OF_DATE} AS recommendation_date
FROM gold
WHERE max_vibration > {C.VIBRATION_DANGER} OR max_temperature > {C.TEMPERATURE_DANGER} OR critical_count > 0"""


def _round_std(df):
    return df.withColumn("vibration_std", F.round("vibration_std", 6))


@register("bronze", covers="D4 P5", oracle=O.with_views(BRONZE_SQL))
def q_bronze(spark, sf_dir):
    return M.build_bronze(T.sensor_readings(spark, sf_dir))


@register("silver", covers="D5 D2 P6 P7 P8", oracle=O.with_views("SELECT * FROM silver", SILVER_CTE))
def q_silver(spark, sf_dir):
    silver, _ = M.build_silver(M.build_bronze(T.sensor_readings(spark, sf_dir)))
    return silver


def _report_sql():
    parts = []
    for r in Q.SILVER_RULES:
        parts.append(f"SELECT {O.q(r.name)} AS rule, {O.q(r.action)} AS action, "
                     f"COUNT(*) FILTER (WHERE {_keep(r.condition)}) AS passed, "
                     f"COUNT(*) FILTER (WHERE NOT {_keep(r.condition)}) AS failed FROM sensor_readings")
    return "\nUNION ALL\n".join(parts)


@register("quality_report", covers="D3 D1 D2", oracle=O.with_views(_report_sql()))
def q_quality_report(spark, sf_dir):
    return Q.quality_report(T.sensor_readings(spark, sf_dir))


@register("quality_report_from_masks", covers="D1 D3", oracle=O.with_views(_report_sql()))
def q_quality_report_from_masks(spark, sf_dir):
    """Every reading is stored with the bits of the rules it fails; the report is made of the counts of those."""
    path = write_snapshot(Q.marked(T.sensor_readings(spark, sf_dir)), scratch_path(spark, "marked"))
    return Q.report_of_masks(Q.mask_counts(read_table(spark, path)))


@register("warned_readings", covers="D1", oracle=O.with_views(f"""
SELECT *, CAST(CASE WHEN {_keep(Q.SILVER_RULES[0].condition)} THEN 0 ELSE 1 END
  + CASE WHEN {_keep(Q.SILVER_RULES[1].condition)} THEN 0 ELSE 2 END
  + CASE WHEN {_keep(Q.SILVER_RULES[2].condition)} THEN 0 ELSE 4 END AS BIGINT) AS failed_rules
FROM sensor_readings
WHERE {_keep(Q.SILVER_RULES[0].condition)} AND {_keep(Q.SILVER_RULES[1].condition)}"""))
def q_warned_readings(spark, sf_dir):
    """What the drop rules leave, each row with the bits of the warn rules it fails."""
    drops = [r.name for r in Q.SILVER_RULES if r.action == Q.DROP]
    return Q.passing(Q.marked(T.sensor_readings(spark, sf_dir)), drops)


@register("health_gold", covers="D6 A5 A6", oracle=O.with_views("SELECT * FROM gold", GOLD_CTE))
def q_health_gold(spark, sf_dir):
    layers = M.build_layers(T.sensor_readings(spark, sf_dir))
    return _round_std(layers.gold)


@register("recommendations", covers="D7 P9 P10", oracle=O.with_views(RECO_SELECT, GOLD_CTE))
def q_recommendations(spark, sf_dir):
    layers = M.build_layers(T.sensor_readings(spark, sf_dir))
    return _round_std(layers.recommendations)


@register("medallion_refresh", covers="D8 S3", oracle=O.with_views(RECO_SELECT, GOLD_CTE))
def q_medallion_refresh(spark, sf_dir):
    """D8 materialized: every layer written under the shared folder, then read back."""
    paths = M.run_layers(spark, T.sensor_readings(spark, sf_dir), scratch_path(spark, "medallion"))
    return _round_std(read_table(spark, paths["recommendations"]))


@register("gold_incremental_refresh", covers="D6 D8 S4 (refresh of touched dates only)",
          oracle=O.with_views("SELECT * FROM gold", GOLD_CTE))
def q_gold_incremental_refresh(spark, sf_dir):
    """History without the run day is built once; then the run day lands in
    silver and only its gold partition is recomputed.  Must equal full gold."""
    readings = T.sensor_readings(spark, sf_dir)
    base = scratch_path(spark, "gold_incremental")
    silver_path, gold_path = f"{base}/silver", f"{base}/gold"
    day = C.DEFAULT_AS_OF.date()
    history, _ = M.build_silver(M.build_bronze(readings.where(F.to_date("timestamp") != F.lit(str(day)).cast("date"))))
    write_snapshot(history, silver_path, partition_by="date")
    write_snapshot(M.build_health_gold(read_table(spark, silver_path)), gold_path, partition_by="date")
    M.land_silver_day(spark, readings, silver_path, day)
    M.refresh_gold_dates(spark, silver_path, gold_path, [day])
    return _round_std(read_table(spark, gold_path))

"""Per-reading predicates, tags and projections.

All are narrow transformations (no shuffle); filters stay ahead of computed
columns so Catalyst pushes them into the parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C


def as_of_timestamp(as_of: _dt.datetime | str | None = None) -> Column:
    """Pinned 'now' as a zone-less timestamp literal (replaces current_timestamp)."""
    as_of = as_of or C.DEFAULT_AS_OF
    text = as_of if isinstance(as_of, str) else as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(text).cast("timestamp_ntz")


def as_of_date(as_of: _dt.datetime | str | None = None) -> Column:
    """Pinned 'today' (replaces current_date)."""
    return F.to_date(as_of_timestamp(as_of))


def anomaly_condition() -> Column:
    return (F.col("vibration_rms") > C.VIBRATION_DANGER) | (F.col("temperature_c") > C.TEMPERATURE_DANGER)


def filter_anomalies(readings: DataFrame) -> DataFrame:
    """Readings with vibration > 7 or temperature > 75."""
    return readings.where(anomaly_condition())


def tag_anomaly_type(df: DataFrame) -> DataFrame:
    """Both signals -> 진동+온도; vibration only -> 고진동; else 고온."""
    v = F.col("vibration_rms") > C.VIBRATION_DANGER
    t = F.col("temperature_c") > C.TEMPERATURE_DANGER
    return df.withColumn("anomaly_type",
                         F.when(v & t, C.ANOMALY_BOTH).when(v, C.ANOMALY_VIBRATION)
                         .otherwise(C.ANOMALY_TEMPERATURE))


def recent_readings(readings: DataFrame, as_of=None) -> DataFrame:
    """Timestamp >= date_sub(as_of, 1), i.e. from yesterday's midnight, no upper bound.

    When readings are stored partitioned by ``date`` the same bound on the
    partition column prunes whole directories; see ``recent_readings_pruned``.
    """
    return readings.where(F.col("timestamp") >= F.date_sub(as_of_timestamp(as_of), 1))


def recent_readings_pruned(readings: DataFrame, as_of=None) -> DataFrame:
    """P3 on a date-partitioned store: add the partition bound so the scan prunes."""
    start = F.date_sub(as_of_timestamp(as_of), 1)
    return readings.where((F.col("date") >= start) & (F.col("timestamp") >= start))


def filter_status(df: DataFrame, levels=(C.STATUS_DANGER, C.STATUS_CRITICAL), col: str = "status") -> DataFrame:
    """Keep rows whose status is one of ``levels``."""
    return df.where(F.col(col).isin(*levels))


def tag_bronze(readings: DataFrame, as_of=None) -> DataFrame:
    """P5: ingestion time (pinned) and the constant source tag."""
    return (readings.withColumn("ingestion_timestamp", as_of_timestamp(as_of))
            .withColumn("source", F.lit(C.BRONZE_SOURCE)))


def single_signal_status(col: str, critical: float, danger: float, caution: float) -> Column:
    c = F.col(col)
    return (F.when(c > critical, C.STATUS_CRITICAL).when(c > danger, C.STATUS_DANGER)
            .when(c > caution, C.STATUS_CAUTION).otherwise(C.STATUS_NORMAL))


def tag_vibration_status(df: DataFrame) -> DataFrame:
    """4-level status from vibration alone."""
    return df.withColumn("vibration_status", single_signal_status(
        "vibration_rms", C.VIBRATION_CRITICAL, C.VIBRATION_DANGER, C.VIBRATION_CAUTION))


def tag_temperature_status(df: DataFrame) -> DataFrame:
    """4-level status from temperature alone."""
    return df.withColumn("temperature_status", single_signal_status(
        "temperature_c", C.TEMPERATURE_CRITICAL, C.TEMPERATURE_DANGER, C.TEMPERATURE_CAUTION))


def reading_date(df: DataFrame, col: str = "timestamp", out: str = "date") -> DataFrame:
    """Calendar date of the reading."""
    return df.withColumn(out, F.to_date(F.col(col)))


def needs_maintenance(gold: DataFrame) -> DataFrame:
    """Max vibration > 7 or max temperature > 75 or any critical reading."""
    return gold.where((F.col("max_vibration") > C.VIBRATION_DANGER)
                      | (F.col("max_temperature") > C.TEMPERATURE_DANGER)
                      | (F.col("critical_count") > 0))


def tag_urgency(gold: DataFrame, as_of=None) -> DataFrame:
    """P10: urgency by critical/warning counts, plus the recommendation date."""
    return (gold.withColumn("urgency",
                            F.when(F.col("critical_count") > C.URGENCY_CRITICAL_OVER, C.URGENCY_IMMEDIATE)
                            .when(F.col("warning_count") > C.URGENCY_WARNING_OVER, C.URGENCY_THIS_WEEK)
                            .otherwise(C.URGENCY_ROUTINE))
            .withColumn("recommendation_date", as_of_date(as_of)))


def project_columns(df: DataFrame, columns) -> DataFrame:
    """Subset and rename; ``columns`` is a list of names or a {new: old} dict."""
    if isinstance(columns, dict):
        return df.select(*[F.col(old).alias(new) for new, old in columns.items()])
    return df.select(*columns)


def ingest_daily_batch(readings: DataFrame, day: _dt.date | str) -> DataFrame:
    """One day of readings in the sensor_readings schema, ready to append.

    The reference simulates these values; here they are the real rows of
    that calendar day (24 hourly slots per equipment, from midnight).
    """
    day_text = day if isinstance(day, str) else day.isoformat()
    out = readings.where(F.to_date("timestamp") == F.lit(day_text).cast("date"))
    return out.select("equipment_id", "timestamp",
                      *[F.col(c).cast("double").alias(c)
                        for c in ("vibration_rms", "temperature_c", "pressure_bar", "current_amp")])

"""Daily health -> alerts, and the three-step daily run."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.health import estimate_rul, status_of
from ..sources.ledger import append_run, read_runs
from ..sources.sinks import append_batch, read_table, write_snapshot
from . import aggregates as A
from . import readings as R

ALERT_COLUMNS = ["equipment_id", "equipment_name", "status", "alert_message",
                 "avg_vibration", "avg_temperature", "rul_hours", "created_at"]


def alert_message(status="status", name="equipment_name", eq_id="equipment_id",
                  vib="avg_vibration", temp="avg_temperature", rul="rul_hours") -> Column:
    """B2: the alert text; NULL when any part is NULL (concat semantics)."""
    return F.concat(
        F.lit(C.ALERT_PREFIX), F.col(status), F.lit("] "),
        F.col(name), F.lit(" ("), F.col(eq_id), F.lit(") - "),
        F.lit(C.ALERT_VIBRATION), F.round(F.col(vib), 1).cast("string"), F.lit(C.ALERT_VIBRATION_UNIT),
        F.lit(C.ALERT_TEMPERATURE), F.round(F.col(temp), 1).cast("string"), F.lit(C.ALERT_TEMPERATURE_UNIT),
        F.lit(C.ALERT_RUL), F.round(F.col(rul), 0).cast("string"), F.lit(C.ALERT_RUL_UNIT))


def generate_alerts(health: DataFrame, equip: DataFrame, as_of=None) -> DataFrame:
    """B1: J-2 -> status -> RUL -> keep 위험/긴급 -> message -> 8 columns."""
    j = A.join_health_equipment(health, equip)
    out = (j.withColumn("status", status_of("avg_vibration", "avg_temperature"))
           .withColumn("rul_hours", estimate_rul("operating_hours", "avg_vibration", "avg_temperature")))
    out = R.filter_status(out, (C.STATUS_DANGER, C.STATUS_CRITICAL))
    out = (out.withColumn("alert_message", alert_message())
           .withColumn("created_at", R.as_of_timestamp(as_of)))
    return out.select(*ALERT_COLUMNS)


def daily_run(spark: SparkSession, store: str, new_readings: DataFrame, equip: DataFrame,
              day: _dt.date, base: str, as_of=None, run_id: str | None = None) -> dict[str, str]:
    """Ingest (S5) -> analyze (A4) -> alert (B1), each step writing a table.

    With ``run_id`` (one file, one hand-over) the store and the alerts are ledgers of runs: a second file of
    a day is added to the first, and a retry replaces its own rows only.  Without it the store is a
    plain date-partitioned folder and the batch stands for the whole day:

    * ingest appends the readings to ``store`` (the day, or the run, is replaced by a rerun);
    * analyze reads the store with a partition bound (prunes old days);
    * alerts are appended by run date, or as this run's.
    """
    paths = {"readings": store, "health": f"{base}/equipment_health_daily",
             "alerts": f"{base}/maintenance_alerts"}
    batch = R.reading_date(R.ingest_daily_batch(new_readings, day))
    if run_id is None:
        append_batch(batch, store, "date")
    else:
        append_run(batch, store, run_id, "date")
    stored = read_table(spark, store) if run_id is None else read_runs(spark, store).drop("run_id")
    recent = R.recent_readings_pruned(stored, as_of)
    health = A.daily_health(recent.drop("date"), as_of)
    write_snapshot(health, paths["health"])
    alerts = generate_alerts(read_table(spark, paths["health"]), equip, as_of).withColumn("date", F.to_date("created_at"))
    if run_id is None:
        append_batch(alerts, paths["alerts"], "date")
    else:
        append_run(alerts, paths["alerts"], run_id, "date")
    return paths

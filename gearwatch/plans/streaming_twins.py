"""Streaming twins T1-T3: each must equal its batch counterpart, so each
reuses the batch query's oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as O
from ..registry import register
from ..session import materialize, scratch_path
from ..sources import tables as T
from ..sources.sinks import read_table
from ..streaming import twins as S
from .daily_job import ALERTS_CTE, ALERTS_SELECT
from .medallion import GOLD_CTE, SILVER_CTE


def _landing(spark, sf_dir, base):
    return S.land_daily(spark, T.sensor_readings(spark, sf_dir), base)


@register("stream_silver", covers="T1 D5", oracle=O.with_views("SELECT * FROM silver", SILVER_CTE))
def q_stream_silver(spark, sf_dir):
    base = scratch_path(spark, "stream_silver")
    out = S.stream_silver(spark, _landing(spark, sf_dir, base), f"{base}/silver")
    return read_table(spark, out).drop("batch_id")


@register("stream_health_gold", covers="T2 D6", oracle=O.with_views("SELECT * FROM gold", GOLD_CTE))
def q_stream_health_gold(spark, sf_dir):
    base = scratch_path(spark, "stream_gold")
    gold = S.stream_health_gold(spark, _landing(spark, sf_dir, base), f"{base}/gold")
    return read_table(spark, gold).withColumn("vibration_std", F.round("vibration_std", 6))


@register("stream_gold_late_rows", covers="T2 T1 D6", oracle=O.with_views("SELECT * FROM gold", GOLD_CTE))
def q_stream_gold_late_rows(spark, sf_dir):
    """A tenth of all readings lands after everything else, mostly past the watermark; gold still has them all."""
    base = scratch_path(spark, "stream_gold_late")
    readings = T.sensor_readings(spark, sf_dir).select(*T.READING_COLUMNS)
    late = F.pmod(F.crc32(F.concat_ws("|", "equipment_id", "timestamp").cast("binary")), F.lit(10)) == 0
    landing = S.land_daily(spark, readings.where(~late), base)
    last = materialize(readings.where(late), "late-readings")
    S.land(last, last.count(), landing)
    silver = S.stream_silver(spark, landing, f"{base}/silver")
    gold = S.stream_health_gold(spark, landing, f"{base}/gold")
    S.merge_late_days(spark, silver, gold)
    return read_table(spark, gold).withColumn("vibration_std", F.round("vibration_std", 6))


@register("stream_alerts", covers="T3 B1", oracle=O.with_views(ALERTS_SELECT, ALERTS_CTE))
def q_stream_alerts(spark, sf_dir):
    base = scratch_path(spark, "stream_alerts")
    alerts = S.stream_alerts(spark, _landing(spark, sf_dir, base), T.equipment_master(spark, sf_dir), base)
    return read_table(spark, alerts)

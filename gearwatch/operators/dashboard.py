"""W1-W12 dashboard datasets and the mergeable rollup they can share.

Direct form: each dataset is one aggregate.  Those that group by a master
attribute (name, criticality, line) aggregate the readings per equipment
first and join the one-row-per-machine result, then merge sums/counts/maxes
to the attribute - exact, and the join never sees reading-level rows.

Rollup form: one pass builds ``reading_rollup`` at (equipment_id, date, hr)
with sums, counts, maxima and the conditional counts; every dataset and
metric (W1-W12, M1-M3 at equipment/date grain) is derivable from it, so a
dashboard refresh scans the readings once instead of twelve times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.health import status_of
from ..session import materialize
from ..sources.sinks import write_snapshot
from . import aggregates as A

NAME_ROLLUPS = {
    # dataset: (group column, value, source partial, rounding, descending)
    "ds_equip_vib": ("equipment_name", "avg_vibration", "vibration_rms", 2, True),
    "ds_equip_temp": ("equipment_name", "avg_temperature", "temperature_c", 1, True),
    "ds_equip_press": ("equipment_name", "avg_pressure", "pressure_bar", 1, False),
    "ds_line_vib": ("line", "avg_vibration", "vibration_rms", 2, True),
}


def _per_equipment_joined(partials: DataFrame, equip: DataFrame) -> DataFrame:
    return equip.join(partials, "equipment_id")


def avg_by_attribute(partials: DataFrame, equip: DataFrame, attr: str, value: str, signal: str,
                     digits: int, descending: bool) -> DataFrame:
    j = _per_equipment_joined(partials, equip)
    g = j.groupBy(attr).agg(F.sum(f"sum_{signal}").alias("s"), F.sum(f"cnt_{signal}").alias("c"))
    out = g.select(attr, F.round(F.try_divide("s", "c"), digits).alias(value))
    return out.orderBy(F.desc(value) if descending else F.asc(value), attr)


def equip_max_vib(partials: DataFrame, equip: DataFrame) -> DataFrame:
    """Name -> round(max vibration, 2), descending."""
    j = _per_equipment_joined(partials, equip)
    return (j.groupBy("equipment_name").agg(F.round(F.max("max_vibration_rms"), 2).alias("max_vibration"))
            .orderBy(F.desc("max_vibration"), "equipment_name"))


def equip_hours(equip: DataFrame) -> DataFrame:
    """Master only: name, operating hours descending."""
    return equip.select("equipment_name", "operating_hours").orderBy(F.desc("operating_hours"), "equipment_name")


def crit_vib(partials: DataFrame, equip: DataFrame) -> DataFrame:
    """Criticality -> round(avg vibration, 2), in business rank order."""
    j = _per_equipment_joined(partials, equip)
    g = j.groupBy("criticality").agg(F.sum("sum_vibration_rms").alias("s"), F.sum("cnt_vibration_rms").alias("c"))
    return (g.select("criticality", F.round(F.try_divide("s", "c"), 2).alias("avg_vibration"))
            .orderBy(A.criticality_rank("criticality"), "criticality"))


def scatter(partials: DataFrame, equip: DataFrame) -> DataFrame:
    """Name, criticality -> avg vibration (2), avg temperature (1)."""
    j = _per_equipment_joined(partials, equip)
    g = j.groupBy("equipment_name", "criticality").agg(
        F.sum("sum_vibration_rms").alias("sv"), F.sum("cnt_vibration_rms").alias("cv"),
        F.sum("sum_temperature_c").alias("st"), F.sum("cnt_temperature_c").alias("ct"))
    return g.select("equipment_name", "criticality",
                    F.round(F.try_divide("sv", "cv"), 2).alias("avg_vib"),
                    F.round(F.try_divide("st", "ct"), 1).alias("avg_temp"))


def trend(daily: DataFrame, signal: str, out: str, digits: int) -> DataFrame:
    """equipment_id, date -> rounded daily average, ordered by date."""
    return (daily.select("equipment_id", F.col("date").alias("dt"),
                         F.round(F.try_divide(f"sum_{signal}", f"cnt_{signal}"), digits).alias(out))
            .orderBy("dt", "equipment_id"))


def daily_partials(readings: DataFrame) -> DataFrame:
    return A.per_equipment(readings.withColumn("date", F.to_date("timestamp")),
                           signals=("vibration_rms", "temperature_c"), maxes=(),
                           keys=("equipment_id", "date"))


def reading_rollup(readings: DataFrame) -> DataFrame:
    """One pass: (equipment_id, date, hr) partials every dataset and metric can merge."""
    v, t, p = F.col("vibration_rms"), F.col("temperature_c"), F.col("pressure_bar")
    keyed = readings.withColumn("date", F.to_date("timestamp")).withColumn("hr", F.hour("timestamp"))
    aggs = [F.count(F.lit(1)).alias("n")]
    for s in A.SIGNALS:
        aggs += [F.sum(s).alias(f"sum_{s}"), F.count(s).alias(f"cnt_{s}")]
    aggs += [F.max("vibration_rms").alias("max_vibration_rms"), F.max("temperature_c").alias("max_temperature_c"),
             F.count_if((v <= C.VIBRATION_DANGER) & (t <= C.TEMPERATURE_DANGER)).alias("normal_n"),
             F.count_if((v > C.VIBRATION_DANGER) | (t > C.TEMPERATURE_DANGER)).alias("abnormal_n"),
             F.count_if((v <= C.VIBRATION_CAUTION) & (t <= C.TEMPERATURE_CAUTION)).alias("optimal_n"),
             F.count_if((v > 0) & (t > 0) & (p > C.OEE_MIN_PRESSURE)).alias("valid_n"),
             F.count_if((v > C.VIBRATION_CRITICAL) | (t > C.TEMPERATURE_CRITICAL)).alias("critical_n")]
    return keyed.groupBy("equipment_id", "date", "hr").agg(*aggs)


def datasets_from_rollup(rollup: DataFrame, equip: DataFrame) -> dict[str, DataFrame]:
    """All twelve datasets from one (materialized) rollup."""
    per_eq = A.merge_partials(rollup, ["equipment_id"])
    daily = A.merge_partials(rollup, ["equipment_id", "date"], maxes=())
    out = {name: avg_by_attribute(per_eq, equip, *spec) for name, spec in NAME_ROLLUPS.items()}
    out["ds_status_counts"] = status_counts_from_partials(per_eq, equip)
    out["ds_equip_hours"] = equip_hours(equip)
    out["ds_equip_max_vib"] = equip_max_vib(per_eq, equip)
    out["ds_crit_vib"] = crit_vib(per_eq, equip)
    out["ds_vibration_trend"] = trend(daily, "vibration_rms", "avg_vib", 2)
    out["ds_temp_trend"] = trend(daily, "temperature_c", "avg_temp", 1)
    out["ds_anomaly_hour"] = (rollup.where(F.col("abnormal_n") > 0).groupBy("hr")
                              .agg(F.sum("abnormal_n").alias("cnt")).orderBy("hr"))
    out["ds_scatter"] = scatter(per_eq, equip)
    return out


def status_counts_from_partials(per_eq: DataFrame, equip: DataFrame) -> DataFrame:
    j = _per_equipment_joined(per_eq, equip)
    st = j.select(status_of(F.try_divide("sum_vibration_rms", "cnt_vibration_rms"),
                            F.try_divide("sum_temperature_c", "cnt_temperature_c")).alias("status"))
    return st.groupBy("status").agg(F.count(F.lit(1)).alias("cnt")).orderBy(A.status_rank("status"))


def refresh_dashboard(readings: DataFrame, equip: DataFrame, base: str) -> dict[str, str]:
    """Refresh all twelve datasets with one scan of the readings.

    The rollup is written once (lineage cut); each dataset is then a small
    aggregate over it and is written as its own table under ``base``.
    """
    rollup = materialize(reading_rollup(readings), "dashboard_rollup")
    paths = {}
    for name, df in datasets_from_rollup(rollup, equip).items():
        paths[name] = write_snapshot(df, f"{base}/{name}")
    return paths

"""Remaining-life model queries: L1-L10, S9."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from .. import oracle as O
from ..operators import modeling as ML
from ..operators import readings as R
from ..registry import register
from ..session import materialize, scratch_path
from ..sources import tables as T
from ..sources.ledger import read_runs
from ..sources.sinks import inference_log, read_table, write_snapshot


def _bits(key_sql: str) -> str:
    return f"CAST(('0x' || substr(md5({key_sql}), 1, 8)) AS BIGINT)"


def _training_sql(by_date: bool) -> str:
    date_key = ', CAST("timestamp" AS DATE) AS date' if by_date else ""
    group = "equipment_id, date" if by_date else "equipment_id"
    key = "f.equipment_id || '|' || CAST(f.date AS VARCHAR)" if by_date else "f.equipment_id"
    arms = " ".join(f"WHEN {O.q(g)} THEN {c}" for g, c in C.CRITICALITY_CODES.items())
    noise = f"(CAST({_bits(key + chr(32) + '|| ' + O.q('#noise'))} AS DOUBLE) / 4294967296.0 * {2 * C.RUL_LABEL_NOISE} - {C.RUL_LABEL_NOISE})"
    return O.with_views(f"""
WITH agg AS (
  SELECT equipment_id{date_key}, AVG(vibration_rms) AS avg_vibration, MAX(vibration_rms) AS max_vibration,
         {O.r6('STDDEV_SAMP(vibration_rms)')} AS std_vibration, AVG(temperature_c) AS avg_temperature,
         MAX(temperature_c) AS max_temperature, AVG(pressure_bar) AS avg_pressure, AVG(current_amp) AS avg_current,
         COUNT(*) AS reading_count
  FROM sensor_readings GROUP BY {group}),
f AS (SELECT e.operating_hours, e.criticality, a.* FROM equipment_master e JOIN agg a ON e.equipment_id = a.equipment_id)
SELECT f.*, CAST(COALESCE(CASE f.criticality {arms} END, 0) AS DOUBLE) AS criticality_encoded,
       GREATEST(0.0, {C.RUL_MAX_OPERATING_HOURS} - CAST(f.operating_hours AS DOUBLE) - f.avg_vibration * {C.RUL_VIBRATION_WEIGHT}
                - GREATEST(f.avg_temperature - {C.RUL_TEMPERATURE_BASE}, 0) * {C.RUL_TEMPERATURE_WEIGHT} + {noise}) AS rul_hours,
       {_bits("f.equipment_id")} % 100 < {int(round(C.MODEL_TEST_FRACTION * 100))} AS is_test
FROM f""")


def _training(spark, sf_dir, by_date=True):
    return ML.training_set(T.sensor_readings(spark, sf_dir), T.equipment_master(spark, sf_dir), by_date)


@register("rul_training_set", covers="L1 L2 L3 L4", oracle=_training_sql(False))
def q_rul_training_set(spark, sf_dir):
    return _training(spark, sf_dir, False).withColumn("std_vibration", F.round("std_vibration", 6))


@register("rul_training_windows", covers="L10 L2 L3 L4", oracle=_training_sql(True))
def q_rul_training_windows(spark, sf_dir):
    return _training(spark, sf_dir, True).withColumn("std_vibration", F.round("std_vibration", 6))


def _fixed(spark, sf_dir):
    """Every machine with a prediction anyone can recompute: design life less hours."""
    rule = F.lit(C.RUL_MAX_OPERATING_HOURS) - F.col("operating_hours").cast("double")
    return _training(spark, sf_dir, False).withColumn("prediction", rule)


FIXED_SQL = (f"(SELECT *, {C.RUL_MAX_OPERATING_HOURS} - CAST(operating_hours AS DOUBLE) AS prediction "
             f"FROM ({_training_sql(False)}) t) p")


@register("rul_evaluate_fixed", covers="L6", oracle=f"""
SELECT COUNT(*) AS n, {O.r6('AVG(ABS(rul_hours - prediction))')} AS mae,
       {O.r6('1 - SUM((rul_hours - prediction) * (rul_hours - prediction)) / (VAR_POP(rul_hours) * COUNT(*))')} AS r2
FROM {FIXED_SQL}""")
def q_rul_evaluate_fixed(spark, sf_dir):
    return ML.evaluate(_fixed(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("mae", "r2")})


@register("rul_residuals_fixed", covers="L8", oracle=f"""
SELECT equipment_id, {O.r6('rul_hours')} AS actual, prediction AS predicted, {O.r6('rul_hours - prediction')} AS error
FROM {FIXED_SQL}""")
def q_rul_residuals_fixed(spark, sf_dir):
    return ML.residuals(_fixed(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("actual", "error")})


#: Training windows and model store by (application, input folder): one training serves all model queries of a session.
_TRAINED: dict[tuple[str, str], tuple[str, str]] = {}
VERSION = "rul-gbt-v1"


def _trained(spark, sf_dir):
    """(training windows, model store): windows written once, model trained and stored once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        windows, store = scratch_path(spark, "rul-windows"), scratch_path(spark, "rul-models")
        write_snapshot(_training(spark, sf_dir, True), windows)
        ML.train_and_store(read_table(spark, windows), store, VERSION)
        _TRAINED[key] = windows, store
    windows, store = _TRAINED[key]
    return read_table(spark, windows), store


@register("rul_holdout_metrics", covers="L5 L6")
def q_rul_holdout_metrics(spark, sf_dir):
    """The stored model on the held-out windows.

    ``mean_predictor_mae`` is the baseline the model must beat: always
    predicting the training-label mean (one scalar, fetched once).
    """
    data, store = _trained(spark, sf_dir)
    train_mean = data.where(~F.col("is_test")).agg(F.avg(ML.LABEL)).first()[0]
    return ML.evaluate(ML.score_stored(data.where("is_test"), store)[1], baseline=float(train_mean))


@register("rul_feature_importance", covers="L7")
def q_rul_feature_importance(spark, sf_dir):
    return ML.feature_importance(spark, ML.load_model(spark, _trained(spark, sf_dir)[1])[1])


@register("rul_residuals", covers="L8")
def q_rul_residuals(spark, sf_dir):
    data, store = _trained(spark, sf_dir)
    return ML.residuals(ML.score_stored(data.where("is_test"), store)[1])


@register("rul_inference_log", covers="L9 S9")
def q_rul_inference_log(spark, sf_dir):
    """Score every equipment's latest features with the stored model and
    append request/response rows to the inference log as a run."""
    store = _trained(spark, sf_dir)[1]
    current = ML.training_set(T.sensor_readings(spark, sf_dir), T.equipment_master(spark, sf_dir), by_date=False)
    version, scored = ML.score_stored(current, store)
    target = scratch_path(spark, "rul_inference_log")
    inference_log(scored, ML.FEATURES, version, R.as_of_timestamp(), target, run_id=f"{version} noon")
    return read_runs(spark, target)


@register("inference_log_runs", covers="S9 S4", oracle=f"""
SELECT equipment_id, operating_hours, prediction * r.factor AS rul_hours, 'fixed-v1' AS model_id, r.run_id, CAST({O.AS_OF_TS} AS DATE) AS date
FROM {FIXED_SQL}, (VALUES ('noon', 1.0), ('evening', 3.0)) r(run_id, factor)""")
def q_inference_log_runs(spark, sf_dir):
    """Two runs of one model on one day, the second repeated with other predictions: both runs stay, each once."""
    rows = materialize(_fixed(spark, sf_dir), "fixed-predictions")
    target = scratch_path(spark, "fixed_inference_log")
    for run_id, factor in (("noon", 1.0), ("evening", 2.0), ("evening", 3.0)):
        scored = rows.withColumn("prediction", F.col("prediction") * factor)
        inference_log(scored, ["operating_hours"], "fixed-v1", R.as_of_timestamp(), target, run_id=run_id)
    log = read_runs(spark, target)
    return log.select("equipment_id", F.get_json_object("request", "$.operating_hours").cast("int").alias("operating_hours"),
                      F.get_json_object("response", "$.rul_hours").cast("double").alias("rul_hours"), "model_id", "run_id", "date")

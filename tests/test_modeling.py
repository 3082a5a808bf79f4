"""L1-L10 invariants: no golden metrics exist, so test properties."""

import math

from pyspark.sql import functions as F

from gearwatch.operators import modeling as ML


def test_training_set_deterministic_split(readings, equip):
    a = ML.training_set(readings, equip, by_date=True)
    rows = a.select("equipment_id", "date", "is_test", "rul_hours").collect()
    b = {(r.equipment_id, r.date): (r.is_test, r.rul_hours)
         for r in ML.training_set(readings.repartition(3), equip, by_date=True).collect()}
    assert all(b[(r.equipment_id, r.date)] == (r.is_test, r.rul_hours) for r in rows)
    sides = {}
    for r in rows:
        sides.setdefault(r.equipment_id, set()).add(r.is_test)
    assert all(len(x) == 1 for x in sides.values())  # no machine on both sides of the split
    assert 0 < sum(r.is_test for r in rows) / len(rows) < 0.5  # ten machines here, so the share is coarse
    assert all(r.rul_hours >= 0 for r in rows)


def test_zero_noise_label_is_rul_formula(readings, equip):
    from gearwatch.functions.health import estimate_rul
    df = ML.training_set(readings, equip, by_date=False, noise=0.0)
    chk = df.select(F.col("rul_hours"), estimate_rul("operating_hours", "avg_vibration", "avg_temperature").alias("r"))
    assert all(r.rul_hours == r.r for r in chk.collect())


def test_model_invariants(spark, readings, equip):
    data = ML.training_set(readings, equip, by_date=True)
    fit = ML.fit_and_test(data, max_iter=20)
    pred = fit.test_predictions.collect()
    assert pred and all(math.isfinite(r.prediction) for r in pred)
    imp = ML.feature_importance(spark, fit.model).collect()
    assert len(imp) == len(ML.FEATURES) and abs(sum(r.importance for r in imp) - 1.0) < 1e-6
    train_mean = data.where(~F.col("is_test")).agg(F.avg("rul_hours")).first()[0]
    m = ML.evaluate(fit.test_predictions, baseline=train_mean).first()
    assert m.mae < m.mean_predictor_mae
    res = ML.residuals(fit.test_predictions).collect()
    assert all(abs(r.actual - r.predicted - r.error) < 1e-9 for r in res)


def test_evaluate_on_fixed_predictions(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "rul_hours double, prediction double")
    m = ML.evaluate(df, baseline=3.0).first()
    assert m.n == 3 and math.isclose(m.mae, 2 / 3)
    assert math.isclose(m.r2, 1 - 2 / 8) and math.isclose(m.mean_predictor_mae, 4 / 3)


def test_a_stored_model_scores_like_the_fitted_one(spark, readings, equip):
    import pytest

    from gearwatch.session import scratch_path
    data = ML.training_set(readings, equip, by_date=True).checkpoint()
    store = scratch_path(spark, "t_models")
    with pytest.raises(FileNotFoundError):
        ML.load_model(spark, store)
    fit = ML.fit_and_test(data, max_iter=5)
    ML.save_model(fit.model, store, "v1")
    ML.train_and_store(data, store, "v2", max_iter=2)
    with pytest.raises(ValueError):
        ML.save_model(fit.model, store, "v1")  # a version is never replaced
    test = data.where("is_test")
    rows = lambda df: sorted((r.equipment_id, str(r.date), r.prediction) for r in df.collect())
    version, scored = ML.score_stored(test, store, "v1")
    assert version == "v1" and rows(scored) == rows(fit.test_predictions)
    assert ML.score_stored(test, store)[0] == ML.serving_version(spark, store) == "v2"
    ML.promote(spark, store, "v1")
    assert rows(ML.score_stored(test, store)[1]) == rows(fit.test_predictions)


def test_model_queries_train_once(spark, monkeypatch):
    from gearwatch import registry
    from .conftest import SMOKE
    registry.load_all()
    trained = []
    real = ML.train_rul
    monkeypatch.setattr(ML, "train_rul", lambda train, n=100: trained.append(1) or real(train, 3))
    for name in ("rul_holdout_metrics", "rul_feature_importance", "rul_residuals", "rul_inference_log"):
        assert registry.QUERIES[name](spark, SMOKE).count() > 0
    assert len(trained) <= 1

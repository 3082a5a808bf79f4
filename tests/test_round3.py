"""Findings of round 3: hours of zero, few landed files and even training parts, counts without a shuffle."""

import os
from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__
from gearwatch.operators import modeling as ML
from gearwatch.operators import text as X
from gearwatch.plans import questions as Q
from gearwatch.session import scratch_path
from gearwatch.streaming import twins as S


def test_anomaly_rate_of_a_machine_without_hours(spark, monkeypatch):
    equip = spark.createDataFrame([("E1", 0), ("E2", 500)], "equipment_id string, operating_hours int")
    readings = spark.createDataFrame([("E1", 11.0, 20.0), ("E2", 11.0, 20.0), ("E2", 1.0, 20.0)],
                                     "equipment_id string, vibration_rms double, temperature_c double")
    readings = readings.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp_ntz")).withColumn(
        "pressure_bar", F.lit(100.0)).withColumn("current_amp", F.lit(10.0))
    monkeypatch.setattr(Q.T, "sensor_readings", lambda *_: readings)
    monkeypatch.setattr(Q.T, "equipment_master", lambda *_: equip)
    got = [(r.equipment_id, r.anomaly_rate_pct, r.anomaly_rate_per_1000h)
           for r in __spark_entry__.queries()["question_anomaly_per_1000h"](spark, "unused").collect()]
    assert got == [("E2", 50.0, 100.0), ("E1", 100.0, None)]


def test_a_day_lands_in_few_files(spark, readings, monkeypatch):
    def files(landing):
        return [f for f in os.listdir(landing.removeprefix("file:")) if f.endswith(".parquet")]

    dealt = readings.repartition(8)
    days = readings.select(F.to_date("timestamp")).distinct().count()
    landing = S.land_daily(spark, dealt, scratch_path(spark, "t_land"))
    assert len(files(landing)) == days
    assert spark.read.parquet(landing).exceptAll(readings).count() == 0 and spark.read.parquet(landing).count() == readings.count()
    monkeypatch.setattr(S, "ROWS_A_FILE", 40)
    assert len(files(S.land_daily(spark, dealt, scratch_path(spark, "t_land")))) > days


def test_training_rows_lie_in_even_parts(spark, monkeypatch):
    data = spark.range(1000).repartition(1).withColumn("is_test", F.col("id") % 5 == 0)
    monkeypatch.setattr(ML, "LEAST_ROWS", 100)
    sizes = ML.training_rows(data).rdd.glom().map(len).collect()
    assert len(sizes) == spark.sparkContext.defaultParallelism and sum(sizes) == 800 and max(sizes) < 1.1 * min(sizes)


def test_terms_are_counted_without_a_shuffle_of_them(spark):
    texts = ["b a b, c", None, "", "a", "Ä ä é b b b", "12 ! 3"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string").repartition(3)
    counted = docs.select("doc_id", F.inline(X.term_counts(X.tokens("content"))))
    assert "Exchange hashpartitioning" not in counted._jdf.queryExecution().executedPlan().toString()
    want = {0: Counter(b=2, a=1, c=1), 3: Counter(a=1), 4: Counter({"ä": 2, "é": 1, "b": 3})}
    assert {(r.doc_id, r.term): r.tf for r in counted.collect()} == {(i, t): n for i, c in want.items() for t, n in c.items()}
    again = docs.unionByName(docs.where("doc_id = 0")).unionByName(docs.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    got = {(r.doc_id, r.term): (r.tf, r.dl, r.df) for r in X.term_index(again).collect()}
    assert got[0, "b"] == (4, 4, 2) and got[None, "a"] == (1, 1, 3) and got[4, "ä"] == (2, 6, 1) and len(got) == 8

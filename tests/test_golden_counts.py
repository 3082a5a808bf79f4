"""Coverage numbers measured on sf0.01 (FIXTURES.md §2) as regression anchors."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from gearwatch import config as C

from .conftest import SMALL


@pytest.fixture(scope="module")
def qs():
    return E.queries()


def test_status_mix(spark, qs):
    got = {r.status: r.cnt for r in qs["ds_status_counts"](spark, SMALL).collect()}
    assert got == {C.STATUS_NORMAL: 31, C.STATUS_CAUTION: 22, C.STATUS_DANGER: 38, C.STATUS_CRITICAL: 9}


def test_reading_bands_and_nulls(spark, qs):
    r = qs["sensor_readings"](spark, SMALL)
    row = r.agg(F.count_if(F.col("vibration_rms") > 10).alias("v10"),
                F.count_if((F.col("vibration_rms") > 7) & (F.col("vibration_rms") <= 10)).alias("v7"),
                F.count_if((F.col("vibration_rms") > 4.5) & (F.col("vibration_rms") <= 7)).alias("v45"),
                F.count_if(F.col("temperature_c") > 90).alias("t90"),
                F.count_if(F.col("temperature_c") > 75).alias("t75"),
                F.count_if(F.col("vibration_rms").isNull()).alias("vn"),
                F.count_if(F.col("temperature_c").isNull()).alias("tn")).first()
    assert tuple(row) == (6959, 19547, 16333, 2976, 18840, 115, 114)


def test_quality_and_silver(spark, qs):
    rep = {r.rule: r.failed for r in qs["quality_report"](spark, SMALL).collect()}
    nulls = {C.RULE_VALID_VIBRATION[0]: 115, C.RULE_VALID_TEMPERATURE[0]: 114, C.RULE_VALID_PRESSURE[0]: 0}
    assert {k: v - nulls[k] for k, v in rep.items()} == {
        C.RULE_VALID_VIBRATION[0]: 295, C.RULE_VALID_TEMPERATURE[0]: 201, C.RULE_VALID_PRESSURE[0]: 140}
    assert qs["silver"](spark, SMALL).count() == 59278


def test_urgency_mix_and_alerts(spark, qs):
    got = {r.urgency: r["count"] for r in qs["recommendations"](spark, SMALL).groupBy("urgency").count().collect()}
    assert got == {C.URGENCY_IMMEDIATE: 575, C.URGENCY_THIS_WEEK: 509, C.URGENCY_ROUTINE: 1475}
    assert qs["alerts"](spark, SMALL).count() == 47
    assert qs["health_gold"](spark, SMALL).count() == 4200

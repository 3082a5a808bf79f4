"""The reference's eight master rows and hand-made readings (test-only input)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gearwatch import config as C
from gearwatch.operators import aggregates as A
from gearwatch.operators import dashboard as D
from gearwatch.operators import readings as R
from gearwatch.plans.metric_views import health_view
from gearwatch.sources.catalog import equipment_listing
from gearwatch.sources.tables import EQUIPMENT_SCHEMA, READINGS_SCHEMA, from_rows

# Golden master rows as published (FIXTURES.md §1).
MASTER = [
    ("EQ-001", "CNC 선반", "가공라인A", "핵심", 8500),
    ("EQ-002", "프레스기", "프레스라인B", "핵심", 12000),
    ("EQ-003", "컨베이어", "조립라인C", "중요", 5000),
    ("EQ-004", "로봇암", "용접라인D", "핵심", 3000),
    ("EQ-005", "펌프", "유틸리티E", "보조", 15000),
    ("EQ-006", "압축기", "유틸리티E", "중요", 9000),
    ("EQ-007", "냉각기", "가공라인A", "중요", 7000),
    ("EQ-008", "보일러", "유틸리티E", "핵심", 11000),
]


@pytest.fixture(scope="module")
def master(spark):
    return from_rows(spark, MASTER, EQUIPMENT_SCHEMA)


@pytest.fixture(scope="module")
def hand_readings(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("EQ-001", t0, 7.0, 60.0, 100.0, 10.0), ("EQ-001", t0 + dt.timedelta(hours=1), 7.0, 60.0, 100.0, 10.0),
            ("EQ-002", t0, 10.5, 50.0, 95.0, 12.0), ("EQ-003", t0, 3.0, 95.0, 40.0, 11.0),
            ("EQ-999", t0, 99.0, 99.0, 1.0, 1.0)]  # orphan reading: no master row
    return from_rows(spark, rows, READINGS_SCHEMA)


def test_master_listing_and_hours(master):
    rec = json.loads(equipment_listing(master).where("equipment_id = 'EQ-005'").first().record)
    assert rec == {"equipment_id": "EQ-005", "equipment_name": "펌프", "line": "유틸리티E",
                   "criticality": "보조", "operating_hours": 15000}
    names = [r.equipment_name for r in D.equip_hours(master).collect()]
    assert names[:3] == ["펌프", "프레스기", "보일러"]


def test_fleet_on_golden_rows(master, hand_readings):
    got = {r.equipment_id: r.status for r in A.fleet_status(hand_readings, master).collect()}
    # inner join: the orphan reading and machines without readings do not appear
    assert got == {"EQ-001": C.STATUS_CAUTION, "EQ-002": C.STATUS_CRITICAL, "EQ-003": C.STATUS_CRITICAL}


def test_inclusive_question_vs_strict_status(hand_readings):
    # EQ-001 averages exactly 7.0: in the "7.0 or more" question, but its status is only 주의
    hi = health_view(hand_readings).query(["equipment_id"], ["avg_vibration"],
                                         having=F.col("avg_vibration") >= 7.0).collect()
    assert "EQ-001" in {r.equipment_id for r in hi}


def test_single_signal_vs_combined_status(hand_readings):
    tagged = R.tag_temperature_status(R.tag_vibration_status(hand_readings))
    row = tagged.where("equipment_id = 'EQ-003'").first()
    assert row.vibration_status == C.STATUS_NORMAL and row.temperature_status == C.STATUS_CRITICAL


def test_metric_view_publish(spark, hand_readings):
    health_view(hand_readings).publish(spark, "gw_health_by_eq", ["equipment_id"], ["total_readings"])
    assert spark.sql("SELECT SUM(total_readings) FROM gw_health_by_eq").first()[0] == 5

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gearwatch.session import get_session
    s = get_session("local[4]", 8, app_name="gearwatch-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def readings(spark):
    from gearwatch.sources.tables import sensor_readings
    return sensor_readings(spark, SMOKE)


@pytest.fixture(scope="session")
def equip(spark):
    from gearwatch.sources.tables import equipment_master
    return equipment_master(spark, SMOKE)

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from horizonkit.session import get_spark
    s = get_spark("local[4]", app="horizonkit-tests", shuffle_partitions=4,
                  extra={"spark.driver.memory": "4g", "spark.sql.adaptive.enabled": "true"})
    yield s
    s.stop()


def hourly_rows(n, start=dt.datetime(2020, 1, 1), series="s", value=lambda i: float(i), step_hours=1):
    return [(series, start + dt.timedelta(hours=i * step_hours), value(i)) for i in range(n)]


SCHEMA = "series_id string, ts timestamp_ntz, y double"


@pytest.fixture
def make_series(spark):
    def mk(rows, schema=SCHEMA):
        return spark.createDataFrame(rows, schema)
    return mk

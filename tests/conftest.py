from __future__ import annotations

import json
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from nimbus.session import get_session  # noqa: E402

# Golden API document (from the source's unit tests).
GOLDEN = {
    "coord": {"lon": -74.006, "lat": 40.7128},
    "weather": [{"id": 800, "main": "Clear", "description": "clear sky", "icon": "01d"}],
    "main": {"temp": 72.5, "feels_like": 70.1, "temp_min": 68.0, "temp_max": 75.0,
             "pressure": 1013, "humidity": 65},
    "visibility": 10000,
    "wind": {"speed": 5.2, "deg": 180, "gust": 8.1},
    "clouds": {"all": 0},
    "dt": 1711900000,
    "sys": {"country": "US", "sunrise": 1711877000, "sunset": 1711922000},
    "timezone": -14400, "id": 5128581, "name": "New York", "cod": 200,
}


def pytest_collection_modifyitems(session, config, items):
    # Functions defined in test modules run inside Python workers (keyed
    # transports); pickle those modules by value since workers cannot import them.
    from pyspark import cloudpickle
    for mod in {item.module for item in items}:
        cloudpickle.register_pickle_by_value(mod)


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="nimbus-warehouse-")
    s = get_session("local[4]", 4, app_name="nimbus-tests",
                    conf={"spark.sql.warehouse.dir": warehouse})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def reading(**over) -> dict:
    """A valid flat reading; override any field."""
    base = {
        "city": "New York City", "state": "NY", "country": "US", "lat": 40.7128, "lon": -74.006,
        "fetched_at": "2024-03-31T16:00:05+00:00", "observed_at": "2024-03-31T15:46:40+00:00",
        "temp_f": 72.5, "feels_like_f": 70.1, "temp_min_f": 68.0, "temp_max_f": 75.0,
        "humidity_pct": 65, "pressure_hpa": 1013, "visibility_m": 10000,
        "wind_speed_mph": 5.2, "wind_deg": 180, "wind_gust_mph": 8.1, "clouds_pct": 0,
        "condition_id": 800, "condition_main": "Clear", "condition_description": "clear sky",
        "condition_icon": "01d", "sunrise": "2024-03-31T09:23:20+00:00",
        "sunset": "2024-03-31T21:53:20+00:00",
    }
    base.update(over)
    return base


def write_lines(path: Path, lines: list) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w") as f:
        for ln in lines:
            f.write((ln if isinstance(ln, str) else json.dumps(ln)) + "\n")


def new_dir() -> str:
    return tempfile.mkdtemp(prefix="nimbus-test-")

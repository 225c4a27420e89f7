import os
import sys
from datetime import datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from dockpulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_pieces(spark):
    """Settings under which small keys count as hot and are cut into short pieces."""
    spark.conf.set("spark.dockpulse.hotKeyRows", "5")
    spark.conf.set("spark.dockpulse.pieceRows", "4")
    yield
    spark.conf.unset("spark.dockpulse.hotKeyRows")
    spark.conf.unset("spark.dockpulse.pieceRows")


START = datetime(2025, 12, 26, 8, 0, 0)


def series(spark, values, station="a", start=0):
    """Observations of one station, 30 seconds apart."""
    rows = [
        (station, v, START + timedelta(seconds=30 * (start + i)), start + i)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, "station_id string, parking_count int, observed_at timestamp_ntz, seq long"
    )


def rows(df, *cols):
    return sorted((tuple(r[c] for c in (cols or df.columns)) for r in df.collect()), key=str)

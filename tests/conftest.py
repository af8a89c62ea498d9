from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("supplycast-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def series_frame(spark, series: dict[str, list], start="2015-01-01", step="month"):
    """Long table ``(series_id, ds, t, value)`` from lists of values."""
    rows = [
        (name, t + 1, None if v is None else float(v))
        for name, values in series.items()
        for t, v in enumerate(values)
    ]
    df = spark.createDataFrame(rows, "series_id string, t int, value double")
    unit = {"month": f"add_months(DATE '{start}', t - 1)", "day": f"date_add(DATE '{start}', t - 1)"}
    return df.selectExpr("series_id", f"{unit[step]} AS ds", "t", "value")

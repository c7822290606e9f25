"""Fixed values against literals: seasons, holidays, bands, trend labels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourloom.functions import features as fx
from hourloom.operators import windows


def test_calendar(spark):
    days = ["2024-03-23", "2024-08-14", "2024-12-25", "2024-02-05", "2024-05-01", "2024-11-09", "2024-07-03"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(d),) for d in days], "timestamp timestamp_ntz")
    got = {str(r.timestamp)[:10]: (r.season, r.is_holiday, r.is_working_day) for r in fx.temporal(df).collect()}
    assert got == {
        "2024-03-23": ("Spring", 1, 0), "2024-08-14": ("Monsoon", 1, 0), "2024-12-25": ("Winter", 1, 0), "2024-02-05": ("Winter", 0, 1),
        "2024-05-01": ("Summer", 0, 1), "2024-11-09": ("Autumn", 0, 0), "2024-07-03": ("Monsoon", 0, 1),
    }


def test_bands(spark):
    df = spark.createDataFrame([(v,) for v in (None, 120.0, 250.0, 600.0)], "v double")
    assert [tuple(r) for r in df.select(fx.band(F.col("v")), fx.display_category(F.col("v"))).collect()] == [
        (None, "Unavailable"), ("Unhealthy_Sensitive", "Unhealthy for Sensitive Groups"), ("Very_Unhealthy", "Very Unhealthy"), (None, "Hazardous"),
    ]


def test_trend_labels(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("up", 10.0), ("up", 12.5), ("down", 12.0), ("down", 10.0), ("flat", 1.0), ("flat", 1.0), ("one", 5.0), ("none", None), ("gap", 1.0), ("gap", None), ("gap", 4.0)]
    df = spark.createDataFrame([(c, at + dt.timedelta(hours=i), v) for i, (c, v) in enumerate(rows)], "city string, timestamp timestamp_ntz, aqi double")
    assert {r.city: (r.value, r.direction, r.label) for r in windows.trend(df).collect()} == {
        "up": (2.5, "up", "▲ +2.5 since last reading"), "down": (-2.0, "down", "▼ -2.0 since last reading"), "flat": (0.0, "flat", "No change since last reading"),
        "one": (None, "unknown", "Insufficient AQI history"), "none": (None, "unknown", "Insufficient AQI history"), "gap": (3.0, "up", "▲ +3.0 since last reading"),
    }


def test_strict_and_soft_batches(spark):
    from hourloom.operators import clean

    df = spark.createDataFrame([(0, 20.0, 5.0), (1, 99.0, -1.0), (2, None, 1e9), (3, -100.0, 0.0)], "n long, temperature double, pm25 double")
    good, bad = clean.validated_batch(df, "n", ["temperature"], strict=False)
    assert [r.n for r in good.collect()] == [0] and "errors" not in good.columns
    assert {r.n: r.errors for r in bad.collect()} == {1: ["row[1].temperature: out of range", "row[1].pm25: out of range"], 2: ["row[2].temperature: missing"], 3: ["row[3].temperature: out of range"]}
    with pytest.raises(ValueError, match=r"row\[1\].temperature: out of range; row\[1\].pm25"):
        clean.validated_batch(df, "n", ["temperature"])
    with pytest.raises(ValueError, match="empty"):
        clean.validated_batch(df.limit(0), "n", [])
    assert clean.validated_batch(df.limit(1), "n", ["temperature"])[0].count() == 1

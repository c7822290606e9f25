"""Hand-made frames for the traps, and properties."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourloom.functions import features as fx
from hourloom.operators import clean, joins, reports, windows
from hourloom.plans import training
from hourloom.sources import sinks

T0 = dt.datetime(2024, 1, 1)


def series(spark, values, city="a", step=1):
    rows = [(city, T0 + dt.timedelta(hours=i * step), None if v is None else float(v), i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, aqi double, ingest_seq long")


def column(df, c):
    return [r[c] for r in df.orderBy("timestamp").collect()]


def test_ema_matches_pandas_with_nulls_and_chunks(spark):
    values = [None, 2, None, None, 3, 5, None, 1, 4, 4, None, 9]
    got = column(windows.ema(series(spark, values), "aqi", (3,), hours=4), "aqi_ema_3h")
    want = pd.Series(values, dtype=float).ewm(span=3, adjust=False).mean()
    assert got[0] is None and got[4] == pytest.approx(2.8)
    assert got[1:] == pytest.approx(want[1:].tolist())


def test_bands(spark):
    df = spark.createDataFrame([(float(v),) for v in (-1, 0, 50, 50.5, 500, 501, 501.5)], "v double")
    assert [r[0] for r in df.select(fx.band(F.col("v"))).collect()] == [None, "Good", "Good", "Moderate", "Hazardous", "Hazardous", None]


def test_target_needs_the_exact_hour_and_lag_takes_the_row(spark):
    df = series(spark, [1, 2, 3, 4]).where("ingest_seq <> 1")
    out = windows.lags(joins.targets(df, (1,)), {"aqi": (1,)})
    assert column(out, "target_aqi_t_1") == [None, 4.0, None]
    assert column(out, "aqi_lag_1") == [None, 1.0, 3.0]


def test_percent_change_from_zero_is_null(spark):
    assert column(windows.percent_changes(series(spark, [0, 5, 10]), ["aqi"], (1,)), "aqi_pctchange_1") == [None, None, 1.0]


def test_kelvin_boundary(spark):
    df = spark.createDataFrame([(130.0,), (131.0,)], "t double").select(clean.kelvin_to_celsius(F.col("t")))
    assert [r[0] for r in df.collect()] == [130.0, -142.15]


def test_second_append_adds_nothing(spark, tmp_path):
    target = {"city": "string", "timestamp": "timestamp_ntz", "aqi": "double"}
    df = series(spark, [1, 2, 3])
    assert sinks.append_features(spark, df, str(tmp_path / "t"), target) == 3
    assert sinks.append_features(spark, df, str(tmp_path / "t"), target) == 0


def test_round_trips(spark, tmp_path):
    df = series(spark, [1, None, 3])
    for fmt, p in sinks.save_batch(df, str(tmp_path), 1, ("json", "csv", "parquet")).items():
        assert sinks.read_batch(spark, p, fmt, df.schema).orderBy("timestamp").collect() == df.orderBy("timestamp").collect()


def test_future_rows_do_not_change_past_features(spark):
    a, b = series(spark, range(30)), series(spark, [*range(20), *[99] * 10])
    one, two = (column(windows.rolling(x, ["aqi"], (6,), ("mean", "std")), "aqi_rollmean_6h")[:20] for x in (a, b))
    assert one == two


def test_other_entities_do_not_matter(spark):
    a = series(spark, range(10))
    both = a.union(series(spark, [7] * 10, "b"))
    f = lambda x: column(windows.differences(x, ["aqi"], (1,)).where("city = 'a'"), "aqi_diff_1")
    assert f(a) == f(both)


def test_split_errors_on_few_hours(spark):
    with pytest.raises(ValueError):
        windows.chronological_split(series(spark, [1, 2]))


def test_contract(spark):
    df = series(spark, [1])
    assert clean.contract(df.drop("ingest_seq"), ["aqi", "x"]) == (["x"], [], 0.5)
    with pytest.raises(ValueError):
        clean.enforce_contract(df, ["x"])


def test_rolling_shuffles_as_often_for_many_frames_as_for_one(spark):
    def exchanges(columns, ws, stats):
        return windows.rolling(series(spark, range(10)).withColumn("pm25", F.col("aqi")), columns, ws, stats)._jdf.queryExecution().executedPlan().toString().count("Exchange")

    assert exchanges(["aqi", "pm25"], (3, 6, 24), ("mean", "min", "std")) == exchanges(["aqi"], (3,), ("mean",))


def test_ridge_is_the_closed_form(spark):
    import numpy as np
    from pyspark.ml.feature import VectorAssembler

    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = x @ [1, -2, 3] + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, label double")
    m = training.ridge(df).fit(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df))
    xc, yc = x - x.mean(0), y - y.mean()
    assert m.coefficients.toArray() == pytest.approx(np.linalg.solve(xc.T @ xc + 10 * np.eye(3), xc.T @ yc), abs=1e-6)

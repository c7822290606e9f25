"""Tests of series against least squares over rows, and distribution functions against counting."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourloom.config import Columns
from hourloom.operators import distributions, stationarity

C = Columns()


def table(spark, series):
    rows = [(c, t, None if v is None else float(v)) for c, vs in series.items() for t, v in enumerate(vs)]
    return spark.createDataFrame(rows, "city string, h int, aqi double").withColumn("timestamp", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, h)")).drop("h")


@pytest.fixture(scope="module")
def series():
    rnd = np.random.default_rng(2)
    noise = rnd.normal(0, 1, 400)
    ar = [0.0, 0.0]
    for e in noise:
        ar.append(0.5 * ar[-1] + 0.3 * ar[-2] + e)
    return {"ar": np.array(ar) + 100, "walk": np.cumsum(noise), "noise": noise[:60], "short": noise[:9]}


def plain_adf(x, lags=None):
    n = len(x)
    d = np.diff(x)
    most = stationarity.adf_lag_limit(n) if lags is None else lags

    def fit(p, q):
        t = np.arange(q + 1, n)
        a = np.column_stack([x[t - 1], np.ones(len(t)), *[d[t - 1 - j] for j in range(1, p + 1)]])
        beta = np.linalg.lstsq(a, d[t - 1], rcond=None)[0]
        ssr = float(((d[t - 1] - a @ beta) ** 2).sum())
        return beta, ssr, np.linalg.inv(a.T @ a)[0, 0], len(t), a.shape[1]

    if lags is None:
        lags = min(range(most + 1), key=lambda p: (lambda f: (f[3] * math.log(f[1] / f[3]) + 2 * f[4], p))(fit(p, most)))
    beta, ssr, inv, m, k = fit(lags, lags)
    return lags, m, beta[0] / math.sqrt(ssr / (m - k) * inv)


def test_adf(spark, series):
    for lags in (None, 0, 3):
        got = {r.city: r for r in stationarity.adf(table(spark, series), "aqi", lags).collect()}
        for c, x in series.items():
            want = plain_adf(x, lags) if c != "short" or lags != 3 else None
            if want:
                assert (got[c].lags, got[c].n_used) == want[:2] and got[c].adf == pytest.approx(want[2], abs=1e-4), (c, lags)
    got = {r.city: r for r in stationarity.adf(table(spark, {**series, "flat": [5.0] * 50, "one": [1.0], "none": [None] * 3}), "aqi").collect()}
    assert got["noise"].stationary and not got["walk"].stationary and got["flat"].adf is None and got["one"].adf is None and "none" not in got
    assert stationarity.adf_p_value(-2.8615) == pytest.approx(0.05, abs=2e-3) and stationarity.adf_p_value(-3.4304) == pytest.approx(0.01, abs=1e-3)


def test_pacf(spark, series):
    got = {(r.city, r.lag): r.pacf for r in stationarity.pacf(table(spark, series), "aqi", 12).collect()}
    for c, x in series.items():
        n, x = len(x), x - x.mean()
        r = [(x[k:] @ x[: n - k] / (n - k)) / (x @ x / n) for k in range(min(12, n // 2 - 1) + 1)]
        for k in range(1, len(r)):
            toeplitz = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
            assert got[c, k] == pytest.approx(np.linalg.solve(toeplitz, r[1 : k + 1])[-1], abs=1e-4), (c, k)
        assert (c, len(r)) not in got


def plain_kpss(x):
    n, e = len(x), x - x.mean()
    s0, s1 = e @ e / n, 0.0
    for i in range(1, int(n ** (2 / 9)) + 1):
        g = e[i:] @ e[:-i] / (n / 2)
        s0, s1 = s0 + g, s1 + i * g
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    long_run = e @ e + 2 * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) for k in range(1, lags + 1))
    return lags, (np.cumsum(e) ** 2).sum() / (n * long_run)


def test_kpss(spark, series):
    got = {r.city: r for r in stationarity.kpss(table(spark, series), "aqi", None).collect()}
    for c, x in series.items():
        lags, k = plain_kpss(x)
        assert got[c].lags == lags and got[c].kpss == pytest.approx(k, abs=1e-4), c
    assert got["noise"].stationary and not got["walk"].stationary and got["walk"].p == 0.01


def test_both_series(spark, series):
    got = {(r.city, r.series, r.test): r for r in stationarity.stationarity(table(spark, {"walk": series["walk"]}), "aqi").collect()}
    assert len(got) == 4 and not got["walk", "raw", "ADF"].stationary and got["walk", "differenced", "ADF"].stationary
    assert got["walk", "differenced", "ADF"].statistic == pytest.approx(plain_adf(np.diff(series["walk"]))[2], abs=1e-4)


def test_distribution_functions(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), rnd.choice([None, 1.0, 2.0, rnd.random()]), float(rnd.randrange(2000)) ** 3, 7.0) for _ in range(3000)]
    df = spark.createDataFrame(rows, "side string, few double, many double, one double")
    labels = {"left": F.col("side") == "a", "right": F.col("side") == "b", "nobody": F.lit(False)}
    got = distributions.distribution_functions(df, ["few", "many", "one"], labels).collect()
    for i, c in enumerate(("few", "many", "one"), 1):
        for name, side in (("left", "a"), ("right", "b")):
            values = sorted(r[i] for r in rows if r[0] == side and r[i] is not None)
            for r in (r for r in got if r.feature == c):
                assert r[name] == pytest.approx(np.searchsorted(values, r.v, "right") / len(values)) and r[f"n_{name}"] == len(values)
    assert all(r.nobody is None for r in got)
    found = {r.feature: r for r in distributions.drift(df.withColumn("many", F.col("many") + F.when(F.col("side") == "a", 1e9).otherwise(0)), ["few", "many", "one"], labels["left"], labels["right"]).collect()}
    assert not found["few"].drift and found["one"].ks == 0 and found["one"].p == 1 and found["many"].drift and found["many"].p < 1e-6
    assert distributions.drift(df, ["few"], labels["left"], labels["nobody"]).collect() == []

"""Unbounded frames by carry: the rows of plain windows over whole entities, with spans so short that most cross many."""

import math
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourloom import queries as core
from hourloom.config import Columns
from hourloom.operators import blocks, clean, windows

D = "/root/testdata/sf0.001"
C = Columns()


@pytest.fixture(scope="module")
def odd(spark):
    """Gaps, nulls at the start and in runs, a missing entity, rows without a time."""
    t = core.nulled(spark, D).select("city", "timestamp", "aqi").withColumn("aqi", F.when(F.hour("timestamp") % 5 != 3, F.col("aqi")))
    return t.union(spark.createDataFrame([(None, None, 1.0), ("x", None, 2.0), ("x", None, None)], "city string, timestamp timestamp_ntz, aqi double")).persist()


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else str(v) for v in r) for r in df.collect()), key=str)


def test_forward_fill(odd):
    timed = odd.where("timestamp is not null")
    want = timed.withColumn("aqi", F.last("aqi", ignorenulls=True).over(C.window().rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(clean.forward_fill(timed, ["aqi"], hours=16)) == rows(want)
    assert clean.forward_fill(odd, ["aqi"], hours=16).count() == odd.count()


def test_previous_row(odd):
    s = blocks.with_previous(odd, "before", C, hours=16)
    got = s.done().select("city", "timestamp", "before").where("timestamp is not null")
    want = odd.where("timestamp is not null").withColumn("before", F.lag("timestamp").over(C.window())).select("city", "timestamp", "before")
    assert rows(got) == rows(want)


def test_numbers_and_chunks(odd):
    t = odd.where("timestamp is not null")
    got = windows.numbered(t, "n", "m", C, hours=16)
    want = t.withColumns({"n": F.row_number().over(C.window()), "m": F.count("*").over(Window.partitionBy("city"))})
    assert rows(got) == rows(want)


def plain_ema(values, span):
    alpha, y, gap, out = 2 / (span + 1), None, 0, []
    for v in values:
        if v is None:
            gap += 1
        elif y is None:
            y, gap = v, 0
        else:
            q = (1 - alpha) ** (gap + 1)
            y, gap = (q * y + alpha * v) / (q + alpha), 0
        out.append(y)
    return out


@pytest.mark.parametrize("hours", [1, 5, 40, 256])
def test_ema(spark, hours):
    rnd = random.Random(hours)
    values = {c: [None if rnd.random() < 0.3 else rnd.uniform(0, 300) for _ in range(150)] for c in ("a", "b")}
    values["a"][20:90] = [None] * 70
    values["none"] = [None] * 9
    data = [(c, 3 * i, v, float(i)) for c, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "city string, h int, aqi double, pm25 double").withColumn("timestamp", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, h)"))
    got = {(r.city, r.h): r for r in windows.ema(df, ["aqi", "pm25"], (1, 3, 24), C, hours).collect()}
    assert len(got) == len(data)
    for c, vs in values.items():
        for span in (1, 3, 24):
            for column, series in (("aqi", vs), ("pm25", [float(i) for i in range(len(vs))])):
                for i, want in enumerate(plain_ema(series, span)):
                    x = got[c, 3 * i][f"{column}_ema_{span}h"]
                    assert (x is None) == (want is None) and (want is None or math.isclose(x, want, rel_tol=1e-9)), (c, i, span)


def test_plans_order_no_whole_entity(spark):
    """No Python, and every window over rows is split by a block or a span."""
    t = core.nulled(spark, D).select("city", "timestamp", "aqi")
    made = {
        "ema": windows.ema(t, "aqi", (6, 24)), "fill": clean.forward_fill(t, ["aqi"]), "gaps": windows.gaps(t), "run": windows.longest_run(t), "hourly": windows.hourly_interpolated(t, "aqi"),
        "lags": windows.lags(t, {"aqi": (1, 24)}), "chunks": windows.row_splits(t, 4), "analysis": windows.gap_analysis(t), "time": windows.rolling(t, ["aqi"], (24,), ("mean",), mode="time"),
    }
    for name, df in made.items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan, name
        specs = re.findall(r"windowspecdefinition\((.*?)specifiedwindowframe", plan)
        assert specs, name
        assert all(re.search("_span|_block|_key", x) for x in specs), (name, specs)


def test_time_frames_in_blocks(spark):
    df = spark.createDataFrame([("a", h, float(k)) for k, h in enumerate([0, 0, 1, 5, 5, 5, 23, 24, 30, 31, 31, 90, 100])], "city string, h int, aqi double").withColumn("timestamp", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, h)"))
    s = df.withColumn("s", F.unix_timestamp(F.col("timestamp").cast("timestamp")))
    want = s.withColumn("m", F.avg("aqi").over(Window.partitionBy("city").orderBy("s").rangeBetween(-23 * 3600, 0)))
    got = blocks.in_hours(df, lambda x, c: windows.rolling(x, ["aqi"], (24,), ("mean",), c, mode="time"), 23, C, hours=10)
    assert rows(got.select("h", "aqi", "aqi_rollmean_24h")) == rows(want.select("h", "aqi", "m"))


def test_gap_analysis_over_all(spark):
    hours = {"a": [0, 1, 2, 6, 6], "b": [0, 1, 9]}
    df = spark.createDataFrame([(c, h) for c, hs in hours.items() for h in hs], "city string, h int").withColumn("timestamp", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, h)"))
    got = {r.city: tuple(r)[1:] for r in windows.gap_analysis(df, C, overall="all").collect()}
    # all times in one series: 0 0 1 1 2 6 6 9: steps 0 1 0 1 4 0 3; the usual is 0, so every other step is a gap
    assert got == {"a": (1, 4, 1, 1), "b": (1, 8, 1, 0), "all": (0, 4, 4, 1)}
    assert windows.longest_run(df, None).where("city = 'a'").first().longest_run == 3

"""What makes forecasts of small tables slow: tasks without rows, and features that are made again for each pass."""

import datetime as dt

from pyspark.sql import functions as F

from hourloom.plans import dataset, training
from hourloom.report_queries import SMALL

T0 = dt.datetime(2024, 1, 1)


def test_models_of_few_rows_are_fitted_in_one_task(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(training, "candidates", lambda train, trees=True: seen.append(train.rdd.getNumPartitions()) or {"ridge": training.ridge(train)})
    rows = [("a", T0 + dt.timedelta(hours=i), ("train", "validation", "test")[i // 40], float(i % 7), float(i)) for i in range(120)]
    df = spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, split string, aqi double, target_aqi_t_24 double").repartition(16)
    training.champion(df, 24, ["aqi"])
    assert seen == [1]


def test_the_chain_runs_once(spark, monkeypatch):
    calls = spark.sparkContext.accumulator(0)

    def counted(x):
        calls.add(1)
        return x

    def steps(df, cfg, stats):
        return df.withColumn("aqi_lag_72", F.udf(counted, "double").asNondeterministic()("aqi"))

    monkeypatch.setattr(dataset, "chain", steps)
    rows = [("a", T0 + dt.timedelta(hours=i), float(i % 13), float(i % 5), i) for i in range(240)]
    df = spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, aqi double, pm25 double, ingest_seq long")
    built, _ = dataset.build(df, SMALL, stats=())
    assert 0 < built.count() <= 240 and calls.value <= 240

"""Bounded frames in blocks: the same rows as whole entities, in more tasks than there are entities."""

from pyspark.sql import functions as F

from hourloom import queries as core
from hourloom.operators import joins, windows


def made(x, c):
    x = windows.leads(windows.lags(x, {"aqi": (1, 24)}, c), "aqi", (3,), c)
    return windows.rolling(x, ["aqi"], (24,), ("mean", "max"), c).withColumn("where", F.spark_partition_id())


def test_blocks(spark):
    t = core.obs(spark, "/root/testdata/sf0.001").select("city", "timestamp", "aqi")
    t = t.union(spark.createDataFrame([(None, None, 1.0), ("x", None, 2.0)], "city string, timestamp timestamp_ntz, aqi double"))
    names = ["city", "timestamp", "aqi_lag_1", "aqi_lag_24", "aqi_lead_3", "aqi_rollmean_24h", "aqi_rollmax_24h"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        got = windows.in_blocks(t, made, before=24, after=3, rows=16, hours=50).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = made(t, core.C).collect()
    key = lambda r: tuple(round(v, 9) if isinstance(v, float) else str(v) for v in (r[n] for n in names))
    assert sorted(map(key, got), key=str) == sorted(map(key, want), key=str)
    assert len({r["where"] for r in got}) > len({r.city for r in got})


def test_targets_match_the_single_join(spark):
    t = core.obs(spark, "/root/testdata/sf0.001").select("city", "timestamp", "aqi")
    a = {(r.city, r.timestamp): r.target_aqi_t_24 for r in joins.targets(t).collect()}
    assert a == {(r.city, r.timestamp): r.target_aqi_t_24 for r in joins.targets_by_join(t, 24).collect()}

"""Structured Streaming jobs over observations, and finite runs of them for checking against batch results."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.config import Columns, FeatureConfig
from hourloom.sources.sinks import align


#: State on disk; keyed state with timers needs it.
ROCKSDB = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir); a folder of this machine only where the
    session names none and runs on this machine alone, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: executors and driver need a folder that they share")
        base = tempfile.mkdtemp(prefix="spark-hourloom-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def hourly_keys(stream: DataFrame) -> DataFrame:
    """Events with their hour as a timestamp; rows without a key go (see quarantine)."""
    return stream.select(F.col("event_type").alias("city"), F.col("ts").cast("timestamp").alias("event_time"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("timestamp"), F.col("value").alias("aqi"), F.col("event_id").alias("ingest_seq")).where("city is not null and timestamp is not null")


def quarantine(stream: DataFrame) -> DataFrame:
    return stream.where(F.col("event_type").isNull() | F.col("ts").isNull())


def deduplicated(keys: DataFrame, late: str = "2 hours") -> DataFrame:
    """Rows that are not later than the watermark, without those delivered again within it. Which row of an hour is its
    first is left to the sink: the order of rows inside a batch is not defined here."""
    return keys.withWatermark("event_time", late).dropDuplicatesWithinWatermark(["city", "timestamp", "ingest_seq"])


def window_means(keys: DataFrame, size: str = "1 day", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    w = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    return keys.withWatermark("event_time", late).groupBy(w.alias("w"), "city").agg(F.count("*").alias("n"), F.avg("aqi").alias("mean"))


def sessions(keys: DataFrame, gap: str = "90 minutes", late: str = "2 hours") -> DataFrame:
    return keys.withWatermark("event_time", late).groupBy(F.session_window("event_time", gap).alias("w"), "city").agg(F.count("*").alias("n"))


def alerts(keys: DataFrame, limit: float = 300.0) -> DataFrame:
    return keys.where(F.col("aqi") > limit).select("city", "timestamp", "aqi", F.format_string("Hazardous air in %s", "city").alias("message"))


def first_rows(batch: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Of equal keys the row that came first, by the order column."""
    first = batch.groupBy(*cols.key).agg(F.min_by(F.struct(*[c for c in batch.columns if c not in cols.key]), F.col(cols.order)).alias("_first"))
    return first.select(*cols.key, "_first.*")


def append_once(path: str, target: dict[str, str], cols: Columns = Columns()):
    """A foreachBatch sink: existing keys win, also inside a batch; a batch that comes twice adds nothing."""
    from hourloom.sources.sinks import append_features

    def write(batch: DataFrame, _: int) -> None:
        append_features(batch.sparkSession, first_rows(batch, cols), path, target, cols)

    return write


def per_batch(path: str, make: Callable[[DataFrame], DataFrame], fmt: str = "parquet"):
    """A foreachBatch sink that takes effect once per batch: what make gives of a batch is the whole content of that batch's
    folder (batch=N, so readers see the number), and a batch that comes again replaces it by the same."""

    def write(batch: DataFrame, n: int) -> None:
        make(batch).write.mode("overwrite").format(fmt).save(f"{path}/batch={n}")

    return write


def degradation_monitor(path: str, last_n: int = 100):
    """A foreachBatch sink (X06) that writes the degradation ratio of each batch's last rows, once per batch."""
    from hourloom.operators.reports import degradation

    return per_batch(path, lambda batch: degradation(batch, "ingest_seq", "degraded", last_n), "json")


#: Column of a corrected table: the batch that a row came with.
BATCH = "_batch"


def write_latest(path: str, target: dict[str, str], cols: Columns = Columns()):
    """A foreachBatch sink where the last write wins: rows of a later batch replace those of equal keys, inside a batch the
    order column decides. The table at path is split by date; only dates that the batch touches are read and written again, by
    dynamic partition overwrite from a staged table. Each row keeps the number of its batch, so a batch that comes again, even
    after later ones, changes nothing. A null order column loses to any other."""
    keep = [*target, BATCH]

    def write(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        rows = align(batch.where(F.col(cols.entity).isNotNull() & F.col(cols.time).isNotNull()), target).withColumn(BATCH, F.lit(n).cast("long")).withColumn("event_date", F.to_date(cols.time))
        schema = ", ".join(f"`{c}` {t}" for c, t in target.items()) + f", {BATCH} bigint, event_date date"
        spark.createDataFrame([], schema).write.mode("append").partitionBy("event_date").parquet(path)
        old = spark.read.schema(schema).parquet(path).join(rows.select("event_date").distinct(), "event_date", "left_semi")
        best = F.max_by(F.struct(*[c for c in keep if c not in cols.key]), F.struct(BATCH, cols.order))
        last = old.unionByName(rows).groupBy(*cols.key, "event_date").agg(best.alias("_r")).select(*cols.key, "_r.*", "event_date").select(*keep, "event_date")
        staged = shared_folder(spark)
        last.write.parquet(staged)
        spark.read.schema(last.schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)

    return write


@contextmanager
def rocksdb(spark: SparkSession):
    """State on disk for the streams that start inside."""
    before = spark.conf.get(ROCKSDB[0], None)
    spark.conf.set(*ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ROCKSDB[0])
        else:
            spark.conf.set(ROCKSDB[0], before)


def run_sink(stream: DataFrame, spark: SparkSession, write, mode: str = "append") -> None:
    """All that the source holds now, through a foreachBatch sink; state and progress lie in the shared folder."""
    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", shared_folder(spark)).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()


def run_available(stream: DataFrame, spark: SparkSession, mode: str = "append") -> DataFrame:
    """All that the source holds now, as files in the shared folder: those of all batches, in complete mode of the last."""
    path = shared_folder(spark)
    spark.createDataFrame([], stream.schema).write.parquet(f"{path}/batch=-1")
    write = per_batch(path, lambda batch: batch)
    run_sink(stream, spark, (lambda batch, n: write(batch, 0)) if mode == "complete" else write, mode)
    return spark.read.schema(stream.schema).parquet(path).select(*stream.columns)


def events_stream(spark: SparkSession, d: str, files: int | None = None) -> DataFrame:
    path = f"{d}/events.parquet"
    reader = spark.readStream if files is None else spark.readStream.option("maxFilesPerTrigger", files)
    return reader.schema(spark.read.parquet(path).schema).parquet(f"{d}/events*.parquet")


def batch_check_windows(spark: SparkSession, d: str) -> DataFrame:
    out = run_available(window_means(hourly_keys(events_stream(spark, d))), spark, "complete")
    return out.select("city", F.col("w.start").cast("timestamp_ntz").alias("day"), "n", F.round(F.col("mean") + 3.14159e-9, 6).alias("mean"))


def batch_check_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Every session of one finite run: those that the watermark has closed, and those still open at its end (complete
    mode gives both; append mode would hold the open ones back)."""
    out = run_available(sessions(hourly_keys(events_stream(spark, d))), spark, "complete")
    return out.select("city", F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("w.end").cast("timestamp_ntz").alias("end"), "n")


KEYS = {"city": "string", "timestamp": "timestamp_ntz", "ingest_seq": "bigint"}


def batch_check_append(spark: SparkSession, d: str, files: int | None = None) -> DataFrame:
    """The table that the late/duplicate job writes: the first row of each key that was not late."""
    path = shared_folder(spark)
    spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in KEYS.items())).write.parquet(f"{path}/event_date=1970-01-01")
    rows = deduplicated(hourly_keys(events_stream(spark, d, files))).select("city", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "ingest_seq")
    run_sink(rows, spark, append_once(path, KEYS))
    return spark.read.parquet(path).select(*KEYS)


def batch_check_corrections(spark: SparkSession, d: str, files: int | None = None) -> DataFrame:
    """The table in which the last write of each hour wins (X02)."""
    path, target = shared_folder(spark), KEYS | {"aqi": "double"}
    rows = hourly_keys(events_stream(spark, d, files)).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    run_sink(rows, spark, write_latest(path, target))
    return spark.read.parquet(path).select(*target)


def batch_check_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """The rows that hourly_keys leaves out (X01)."""
    return run_available(quarantine(events_stream(spark, d)), spark)


def batch_check_ingest(spark: SparkSession, d: str) -> DataFrame:
    """What ingestion (X01) does with every row of a feed in which some rows lack their time or entity: its hourly key, or
    none and the quarantine's row."""
    feed = events_stream(spark, d).withColumns({"ts": F.when(F.col("event_id") % 50 != 7, F.col("ts")), "event_type": F.when(F.col("event_id") % 50 != 9, F.col("event_type"))})
    good = run_available(hourly_keys(feed).select("city", "timestamp", "ingest_seq"), spark)
    bad = run_available(quarantine(feed).select(F.col("event_id").alias("ingest_seq")), spark)
    out = good.withColumn("quarantined", F.lit(False)).unionByName(bad.withColumn("quarantined", F.lit(True)), allowMissingColumns=True)
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def batch_check_degradation(spark: SparkSession, d: str, limit: float = 100.0) -> DataFrame:
    """What the degradation monitor (X06) writes for each batch, a row being degraded when its value is over the limit."""
    path = shared_folder(spark)
    rows = hourly_keys(events_stream(spark, d)).withColumn("degraded", F.col("aqi") > limit)
    run_sink(rows, spark, degradation_monitor(path))
    return spark.read.schema("n bigint, ratio double, alert boolean, batch bigint").json(path)


def batch_check_alerts(spark: SparkSession, d: str) -> DataFrame:
    """The alerts (X07) of one finite run."""
    out = run_available(alerts(hourly_keys(events_stream(spark, d))), spark)
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def batch_check_features(spark: SparkSession, d: str, files: int | None = None, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Online features (X05) of the first row of each hour; files is the number of files in a batch (None: all)."""
    from hourloom.streaming.online import online_features

    with rocksdb(spark):
        return run_available(online_features(hourly_keys(events_stream(spark, d, files)), cfg), spark)


def batch_check_sliding(spark: SparkSession, d: str) -> DataFrame:
    """Sliding means (X03): windows of a day that begin every six hours."""
    out = run_available(window_means(hourly_keys(events_stream(spark, d)), "1 day", "6 hours"), spark, "complete")
    return out.select("city", F.col("w.start").cast("timestamp_ntz").alias("start"), "n", F.round(F.col("mean") + 3.14159e-9, 6).alias("mean"))

"""Reading observations: from events, versioned files, nested JSON payloads and epoch keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.config import POLLUTANTS, Columns


def hour_of(c: Column) -> Column:
    return F.date_trunc("hour", c).cast("timestamp_ntz")


def observations(events: DataFrame) -> DataFrame:
    """One row per (event_type, hour) of an event table, with the columns of an observation."""
    k = F.get_json_object("props", "$.k").cast("double")
    return events.groupBy(F.col("event_type").alias("city"), hour_of(F.col("ts")).alias("timestamp")).agg(
        F.round(F.avg("value"), 6).alias("aqi"),
        F.min("value").alias("pm25"),
        F.max("value").alias("pm10"),
        F.count("*").cast("double").alias("no2"),
        F.avg(F.col("user_id") % 7).alias("so2"),
        F.avg(F.col("user_id") % 11).alias("co"),
        F.avg(k).alias("o3"),
        (10 + F.avg(F.col("user_id") % 30)).alias("temperature"),
        (30 + F.avg(F.col("event_id") % 60)).alias("humidity"),
        (1000 + F.avg(F.col("event_id") % 20)).alias("pressure"),
        F.round(F.avg("value") / 20, 6).alias("wind_speed"),
        F.max("event_id").alias("ingest_seq"),
    )


def raw_observations(events: DataFrame) -> DataFrame:
    """One row per event, keyed by hour: repeated keys, ordered by event_id."""
    return events.select(F.col("event_type").alias("city"), hour_of(F.col("ts")).alias("timestamp"), F.col("value").alias("aqi"), F.col("user_id").cast("double").alias("pm25"), F.col("event_id").alias("ingest_seq"))


def with_nulls(obs: DataFrame, columns: list[str], every: int = 17) -> DataFrame:
    """Every 17th row (by ingest_seq) loses the columns."""
    return obs.withColumns({c: F.when(F.col("ingest_seq") % every != 0, F.col(c)) for c in columns})


def read_versions(spark: SparkSession, paths: list[str], cols: Columns = Columns()) -> DataFrame:
    """Feature files in the given order, by name; of equal keys the row of the last file stays."""
    from hourloom.operators.clean import dedupe

    parts = [spark.read.parquet(p).withColumn("_version", F.lit(i)) for i, p in enumerate(paths)]
    return dedupe(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), cols.key, "_version").drop("_version")


def scan_features(table: DataFrame, columns: list[str], start=None, end=None, entities: list[str] | None = None, cols: Columns = Columns()) -> DataFrame:
    """Projection, time range and entity list, pushed to the scan; unknown columns are an error."""
    missing = [c for c in columns if c not in table.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    out = table
    if start is not None:
        out = out.where(F.col(cols.time) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        out = out.where(F.col(cols.time) <= F.lit(end).cast("timestamp_ntz"))
    if entities is not None:
        out = out.where(F.lower(cols.entity).isin([e.lower() for e in entities]))
    return out.select(*dict.fromkeys([*cols.key, *columns]))


def latest_context(table: DataFrame, entity: str, rows: int, cols: Columns = Columns()) -> DataFrame:
    """The entity's latest rows, ascending."""
    return table.where(F.lower(cols.entity) == entity.lower()).orderBy(F.desc(cols.time)).limit(rows).orderBy(cols.time)


def existing_keys(table: DataFrame, incoming: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Distinct keys of the table within the hours and entities of incoming rows."""
    lo, hi = incoming.agg(F.min(cols.time), F.max(cols.time)).first()
    names = incoming.select(F.lower(F.trim(cols.entity)).alias("e")).distinct()
    near = table.where((F.col(cols.time) >= F.lit(lo)) & (F.col(cols.time) <= F.lit(hi)))
    return near.select(F.lower(F.trim(cols.entity)).alias("e"), cols.time).distinct().join(names, "e", "left_semi")


AIR_FEED = "status string, data struct<aqi:int, idx:int, dominentpol:string, city:struct<name:string, geo:array<double>>, time:map<string,string>, iaqi:map<string,struct<v:double>>>"
HISTORY = "hourly struct<time:array<string>, temperature_2m:array<double>, relative_humidity_2m:array<double>>"
FORECAST = "city struct<name:string, timezone:int>, list array<struct<dt:long, main:struct<temp:double, humidity:int>, rain:struct<`3h`:double>>>"


def parse_air_feed(df: DataFrame, json: str) -> DataFrame:
    """Flat columns of a nested live feed; an absent pollutant is null."""
    d = F.from_json(json, AIR_FEED)["data"]
    return df.select(*[c for c in df.columns if c != json], d["city"]["name"].alias("name"), d["aqi"].cast("long").alias("feed_aqi"), d["dominentpol"].alias("dominant_pollutant"), *[d["iaqi"][p]["v"].alias(f"feed_{p}") for p in POLLUTANTS])


def parse_history(df: DataFrame, json: str) -> DataFrame:
    """Rows of a payload whose variables are parallel arrays."""
    h = F.from_json(json, HISTORY)["hourly"]
    z = df.select(*[c for c in df.columns if c != json], F.explode(F.arrays_zip(h["time"].alias("time"), h["temperature_2m"].alias("temperature"), h["relative_humidity_2m"].alias("humidity"))).alias("z"))
    return z.select(*[c for c in df.columns if c != json], F.to_timestamp_ntz(F.col("z.time")).alias("timestamp"), F.col("z.temperature").alias("temperature"), F.col("z.humidity").alias("humidity"))


def parse_forecast(df: DataFrame, json: str) -> DataFrame:
    """Rows of a forecast list; no rain is 0."""
    p = F.from_json(json, FORECAST)
    z = df.select(*[c for c in df.columns if c != json], p["city"]["timezone"].cast("long").alias("offset"), F.explode(p["list"]).alias("z"))
    return z.select(*[c for c in df.columns if c != json], "offset", F.col("z.dt").alias("dt"), F.col("z.main.temp").alias("temp"), F.col("z.main.humidity").cast("long").alias("humidity"), F.coalesce(F.col("z.rain.3h"), F.lit(0.0)).alias("rain"))


def local_time(dt: Column, offset: Column) -> Column:
    return F.timestamp_seconds(dt + offset).cast("timestamp_ntz")


def filter_forecast(df: DataFrame, kind: str) -> DataFrame:
    """Local noon, tomorrow, or the next three days after the first forecast row's local day."""
    t = local_time(F.col("dt"), F.col("offset"))
    if kind == "noon":
        return df.where(F.hour(t) == 12)
    first = df.agg(F.min(F.to_date(t)).alias("first"))
    days = F.datediff(F.to_date(t), F.col("first"))
    return df.crossJoin(F.broadcast(first)).where(days == 1 if kind == "tomorrow" else days.between(1, 3)).drop("first")  # one row


def epoch_to_time(c: Column) -> Column:
    """Timestamp of an epoch number whose unit shows in its size: ns from 1e17, us from 1e14, ms from 1e11, else s."""
    a = F.abs(c)
    micros = F.when(a >= 10**17, F.floor(c / 1000)).when(a >= 10**14, c).when(a >= 10**11, c * 1000).otherwise(c * 1_000_000)
    return F.timestamp_micros(micros.cast("long")).cast("timestamp_ntz")


def time_to_epoch(c: Column, unit: str) -> Column:
    micros = F.unix_micros(c.cast("timestamp"))
    return {"ns": micros * 1000, "us": micros, "ms": F.floor(micros / 1000), "s": F.floor(micros / 1_000_000)}[unit]


def year_chunks(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """A row per calendar year that [start, end] touches, cut to it."""
    y = bounds.withColumn("y", F.explode(F.sequence(F.year(start), F.year(end))))
    return y.select(*[c for c in bounds.columns], F.greatest(F.col(start), F.make_date("y", F.lit(1), F.lit(1))).alias("chunk_start"), F.least(F.col(end), F.make_date("y", F.lit(12), F.lit(31))).alias("chunk_end"))

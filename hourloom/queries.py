"""Registered queries of the time-series operators, each with its SQL where SQL can tell the rows.

Queries read the driver's tables through the observation binding of sources.observations. Computed doubles are rounded to
six digits on both sides, after a fixed offset that keeps decimal ties from falling by their binary form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.config import POLLUTANTS, Columns, FeatureConfig
from hourloom.functions import features as fx
from hourloom.operators import clean, joins, reports, sets, windows
from hourloom.sources import observations as src
from hourloom.sources import sinks
from hourloom.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
C, CFG = Columns(), FeatureConfig()
NOISE = 3.14159e-9

OBS = """obs AS (SELECT event_type AS city, date_trunc('hour', ts) AS timestamp, round(avg(value), 6) AS aqi, min(value) AS pm25, max(value) AS pm10,
 count(*)::DOUBLE AS no2, avg(user_id % 7) AS so2, avg(user_id % 11) AS co, avg(CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE)) AS o3,
 10 + avg(user_id % 30) AS temperature, 30 + avg(event_id % 60) AS humidity, 1000 + avg(event_id % 20) AS pressure, round(avg(value) / 20, 6) AS wind_speed,
 max(event_id) AS ingest_seq FROM events GROUP BY 1, 2)"""
RAW = """raw AS (SELECT event_type AS city, date_trunc('hour', ts) AS timestamp, value AS aqi, user_id::DOUBLE AS pm25, event_id AS ingest_seq FROM events)"""
W = "PARTITION BY city ORDER BY timestamp"


def r(c: Column | str) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) + F.lit(NOISE), 6)


def rs(x: str) -> str:
    return f"round(({x}) + {NOISE}, 6)"


def events(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet")


def obs(spark: SparkSession, d: str) -> DataFrame:
    return src.observations(events(spark, d))


def raw(spark: SparkSession, d: str) -> DataFrame:
    return src.raw_observations(events(spark, d))


def add(name: str, sql: str | None, base=obs):
    """Registers f(table) on the binding `base`; sql may use obs or raw."""

    def wrap(f):
        QUERIES[name] = lambda spark, d: f(base(spark, d))
        if sql:
            heads = [h for h, w in ((OBS, " obs"), (RAW, " raw")) if w in sql]
            body = sql.strip()
            SQL[name] = body if not heads else f"WITH {'RECURSIVE ' if 'ema_step' in body else ''}" + ", ".join(heads) + (", " + body[5:] if body.startswith("WITH ") else " " + body)
        return f

    return wrap


def table(name: str, sql: str | None, *tables: str):
    """Registers f(table, ...) on driver tables."""

    def wrap(f):
        QUERIES[name] = lambda spark, d: f(*[spark.read.parquet(f"{d}/{t}.parquet") for t in tables])
        if sql:
            SQL[name] = sql
        return f

    return wrap


KEY = "city, timestamp"

# Scans and sinks -------------------------------------------------------------------------------------------------


@add("s01_canonical_scan", f"WITH k AS (SELECT *, row_number() OVER (PARTITION BY city, timestamp ORDER BY ingest_seq DESC) n FROM raw) SELECT upper(city[1]) || lower(city[2:]) AS city, timestamp, aqi, ingest_seq FROM k WHERE n = 1", raw)
def _(t):
    return clean.canonicalise(t).select("city", "timestamp", "aqi", "ingest_seq")


@add("s03_feature_scan", "SELECT city, timestamp, aqi, pm25 FROM obs WHERE timestamp >= TIMESTAMP '2024-01-05' AND timestamp <= TIMESTAMP '2024-01-20' AND city IN ('click', 'view')")
def _(t):
    return src.scan_features(t, ["aqi", "pm25"], "2024-01-05", "2024-01-20", ["CLICK", "View"])


@add("s04_latest_context", "SELECT city, timestamp, aqi FROM obs WHERE city = (SELECT min(city) FROM obs) ORDER BY timestamp DESC LIMIT 24")
def _(t):
    first = t.agg(F.min("city")).first()[0] or ""
    return src.latest_context(t, first, 24).select("city", "timestamp", "aqi")


@add("s05_existing_keys", "SELECT DISTINCT lower(trim(city)) AS e, timestamp FROM obs WHERE timestamp BETWEEN (SELECT min(timestamp) FROM raw WHERE ingest_seq % 50 = 0) AND (SELECT max(timestamp) FROM raw WHERE ingest_seq % 50 = 0) AND city IN (SELECT city FROM raw WHERE ingest_seq % 50 = 0)")
def _(t):
    return src.existing_keys(t, t.where("ingest_seq % 50 = 0"))


QUERIES["s05_existing_keys"] = lambda s, d: src.existing_keys(obs(s, d), raw(s, d).where("ingest_seq % 50 = 0"))


@add("s06_air_feed", "SELECT city, timestamp, city AS name, CAST(round(aqi) AS BIGINT) AS feed_aqi, 'pm25' AS dominant_pollutant, pm25 AS feed_pm25, pm10 AS feed_pm10, CAST(NULL AS DOUBLE) AS feed_no2, CAST(NULL AS DOUBLE) AS feed_so2, CAST(NULL AS DOUBLE) AS feed_co, o3 AS feed_o3 FROM obs")
def _(t):
    v = lambda c: F.struct(F.col(c).alias("v"))
    data = F.struct(F.round("aqi").cast("int").alias("aqi"), F.lit("pm25").alias("dominentpol"), F.struct(F.col("city").alias("name")).alias("city"), F.create_map(F.lit("pm25"), v("pm25"), F.lit("pm10"), v("pm10"), F.lit("o3"), v("o3")).alias("iaqi"))
    return src.parse_air_feed(t.select("city", "timestamp", F.to_json(F.struct(F.lit("ok").alias("status"), data.alias("data"))).alias("j")), "j")


@add("s07_history_arrays", "SELECT city, timestamp, temperature, humidity FROM obs")
def _(t):
    p = F.sort_array(F.collect_list(F.struct(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm").alias("time"), F.col("temperature").alias("t"), F.col("humidity").alias("h"))))
    day = t.groupBy("city", F.to_date("timestamp").alias("d")).agg(p.alias("p"))
    j = F.to_json(F.struct(F.struct(F.col("p.time").alias("time"), F.col("p.t").alias("temperature_2m"), F.col("p.h").alias("relative_humidity_2m")).alias("hourly")))
    return src.parse_history(day.select("city", j.alias("j")), "j")


@add("s08_forecast_list", "SELECT city, 18000::BIGINT AS \"offset\", epoch(timestamp)::BIGINT AS dt, temperature AS temp, CAST(floor(humidity) AS BIGINT) AS humidity, CASE WHEN ingest_seq % 2 = 0 THEN 1.5 ELSE 0.0 END::DOUBLE AS rain FROM obs")
def _(t):
    item = F.struct(F.unix_timestamp(F.col("timestamp").cast("timestamp")).alias("dt"), F.struct(F.col("temperature").alias("temp"), F.floor("humidity").cast("int").alias("humidity")).alias("main"), F.when(F.col("ingest_seq") % 2 == 0, F.struct(F.lit(1.5).alias("3h"))).alias("rain"))
    day = t.groupBy("city", F.to_date("timestamp").alias("d")).agg(F.collect_list(item).alias("list"))
    return src.parse_forecast(day.select("city", F.to_json(F.struct(F.struct(F.lit("x").alias("name"), F.lit(18000).alias("timezone")).alias("city"), "list")).alias("j")), "j")


def _chunk(t):
    return t.withColumn("batch", F.col("ingest_seq") % 3)


@add("s02_versions_keep_last", "WITH v AS (SELECT city, timestamp, aqi, ingest_seq, row_number() OVER (PARTITION BY city, timestamp ORDER BY ingest_seq % 3 DESC, ingest_seq DESC) n FROM raw) SELECT city, timestamp, aqi, ingest_seq FROM v WHERE n = 1", raw)
def _(t):
    b = _chunk(t)
    out = sets.stack(*[b.where(F.col("batch") == i) for i in range(3)])
    return clean.dedupe(out, C.key, "batch", "ingest_seq").select("city", "timestamp", "aqi", "ingest_seq")


@add("s12_upsert", "WITH v AS (SELECT *, row_number() OVER (PARTITION BY city, timestamp ORDER BY (ingest_seq % 3 = 2)::INT DESC, ingest_seq DESC) n FROM raw) SELECT city, timestamp, aqi, pm25, ingest_seq FROM v WHERE n = 1", raw)
def _(t):
    b = _chunk(t)
    return sinks.upsert(b.where("batch <> 2").drop("batch"), b.where("batch = 2").drop("batch"))


@add("s13_append_rows", "WITH last AS (SELECT *, row_number() OVER (PARTITION BY city, timestamp ORDER BY ingest_seq DESC) n FROM raw WHERE ingest_seq % 3 = 2) SELECT city, timestamp, aqi, CAST(NULL AS DOUBLE) AS co FROM last l WHERE n = 1 AND NOT EXISTS (SELECT 1 FROM raw e WHERE e.ingest_seq % 3 <> 2 AND e.city = l.city AND e.timestamp = l.timestamp)", raw)
def _(t):
    b = _chunk(t)
    return sinks.rows_to_append(b.where("batch = 2"), b.where("batch <> 2"), {"city": "string", "timestamp": "timestamp_ntz", "aqi": "double", "co": "double"})


@add("s14_align", "SELECT timestamp, city, CAST(NULL AS BIGINT) AS station_id, aqi FROM obs")
def _(t):
    return sinks.align(t, {"timestamp": "timestamp_ntz", "city": "string", "station_id": "bigint", "aqi": "double"})


@add("s11_manifest", "SELECT ingest_seq % 3 AS version, count(*) AS n_rows FROM obs GROUP BY 1")
def _(t):
    return sinks.manifest(t.withColumn("version", F.col("ingest_seq") % 3), "version").select("version", "n_rows")


@add("s15_epoch_keys", "SELECT city, timestamp, timestamp AS from_s, timestamp AS from_ms, timestamp AS from_us, timestamp AS from_ns, epoch(timestamp)::BIGINT AS s FROM obs")
def _(t):
    x = F.col("timestamp")
    return t.select("city", "timestamp", *[src.epoch_to_time(src.time_to_epoch(x, u)).alias(f"from_{u}") for u in ("s", "ms", "us", "ns")], src.time_to_epoch(x, "s").alias("s"))


@table("s19_year_chunks", "WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) lo, CAST(max(o_orderdate) AS DATE) hi FROM orders) SELECT greatest(lo, make_date(y, 1, 1)) AS chunk_start, least(hi, make_date(y, 12, 31)) AS chunk_end FROM b, range(1990, 2010) t(y) WHERE y BETWEEN year(lo) AND year(hi)", "orders")
def _(o):
    return src.year_chunks(o.agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi")), "lo", "hi").select("chunk_start", "chunk_end")


@add("s20_row_count", "SELECT count(*) AS n FROM obs")
def _(t):
    return t.agg(F.count("*").alias("n"))


# Cleaning --------------------------------------------------------------------------------------------------------


@add("p02_present_columns", "SELECT city, timestamp, aqi FROM obs")
def _(t):
    return clean.present(t, ["city", "timestamp", "aqi", "not_there"])


@add("p04_warm_up_drop", f"WITH l AS (SELECT city, timestamp, aqi, lag(aqi, 6) OVER ({W}) AS aqi_lag_6, lead(aqi, 3) OVER ({W}) AS target_aqi_t_3 FROM obs) SELECT * FROM l WHERE aqi_lag_6 IS NOT NULL")
def _(t):
    x = windows.leads(windows.lags(t.select("city", "timestamp", "aqi"), {"aqi": (6,)}), "aqi", (3,)).withColumnRenamed("aqi_lead_3", "target_aqi_t_3")
    return clean.drop_warm_up(x, ["target_aqi_t_3"])


@add("p05_usable_targets", "SELECT a.city, a.timestamp, a.aqi, b.aqi AS target_aqi_t_24 FROM obs a JOIN obs b ON a.city = b.city AND b.timestamp = a.timestamp + INTERVAL 24 HOUR")
def _(t):
    return clean.usable(joins.targets(t.select("city", "timestamp", "aqi"), (24,)), 24)


@add("p06_leakage_drop", "SELECT city, timestamp, aqi FROM obs")
def _(t):
    x = t.select("city", "timestamp", "aqi", F.lit(1).alias("future_aqi"), F.lit(1).alias("aqi_lead_1"), F.lit("x").alias("aqi_category"), F.lit("pm25").alias("dominant_pollutant"))
    return clean.drop_leakage(x)


@add("p07_invalid_counts", "SELECT 0::BIGINT AS bad_timestamp, count(*) FILTER (pm25 < 150) AS negative_pm25, count(*) FILTER (aqi < 0 OR aqi > 500) AS bad_target FROM raw", raw)
def _(t):
    return clean.invalid_counts(t.withColumn("pm25", F.col("pm25") - 150)).select("bad_timestamp", "negative_pm25", "bad_target")


@add("p08_null_invalid", "WITH k AS (SELECT *, row_number() OVER (PARTITION BY city, timestamp ORDER BY ingest_seq DESC) n FROM raw) SELECT city, timestamp, CASE WHEN aqi BETWEEN 0 AND 500 THEN aqi END AS aqi, CASE WHEN pm25 >= 0 THEN pm25 END AS pm25, ingest_seq FROM k WHERE n = 1", raw)
def _(t):
    return clean.null_invalid(t)


@add("p09_numeric_coercion", "SELECT ingest_seq, CASE WHEN ingest_seq % 5 = 0 THEN NULL ELSE ingest_seq::DOUBLE END AS number FROM raw", raw)
def _(t):
    return t.select("ingest_seq", clean.numeric(F.when(F.col("ingest_seq") % 5 == 0, F.lit("bad")).otherwise(F.col("ingest_seq").cast("string"))).alias("number"))


@add("p10_missing_tokens", "SELECT ingest_seq, CASE WHEN ingest_seq % 4 < 2 THEN NULL ELSE city END AS word FROM raw", raw)
def _(t):
    x = t.select("ingest_seq", F.when(F.col("ingest_seq") % 4 == 0, F.lit(" N/A ")).when(F.col("ingest_seq") % 4 == 1, F.lit("-")).otherwise(F.col("city")).alias("word"))
    return clean.normalise_missing(x, ["word"])


@add("p11_kelvin", f"SELECT {KEY}, {rs('CASE WHEN humidity * 4 > 130 THEN round(humidity * 4 - 273.15, 2) ELSE humidity * 4 END')} AS celsius FROM obs")
def _(t):
    return t.select(*C.key, r(clean.kelvin_to_celsius(F.col("humidity") * 4)).alias("celsius"))


@add("p12_validation", "SELECT city, timestamp, concat_ws('; ', CASE WHEN humidity NOT BETWEEN 0 AND 60 THEN 'humidity: out of range' END, CASE WHEN aqi NOT BETWEEN 0 AND 100 THEN 'aqi: out of range' END) AS problems FROM obs")
def _(t):
    return clean.errors(t, ["city", "timestamp"], {"humidity": (0, 60), "aqi": (0, 100)}).select(*C.key, F.array_join("errors", "; ").alias("problems"))


@add("p13_warnings", "SELECT city, timestamp, (aqi * 4 >= 400)::BIGINT AS n_warnings FROM obs")
def _(t):
    return clean.warnings(t.withColumn("aqi", F.col("aqi") * 4)).select(*C.key, F.size("warnings").cast("long").alias("n_warnings"))


@add("p14_supported", "SELECT city, timestamp, aqi FROM obs WHERE city IN ('click', 'purchase')")
def _(t):
    return clean.supported(t, [" Click", "PURCHASE "]).select("city", "timestamp", "aqi")


@add("p15_forecast_noon", "SELECT city, epoch(timestamp)::BIGINT AS dt FROM obs WHERE hour(timestamp + INTERVAL 5 HOUR) = 12")
def _(t):
    return src.filter_forecast(t.select("city", F.unix_timestamp(F.col("timestamp").cast("timestamp")).alias("dt"), F.lit(18000).alias("offset")), "noon").select("city", "dt")


@add("p15_forecast_next_days", "SELECT city, epoch(timestamp)::BIGINT AS dt FROM obs WHERE date_diff('day', (SELECT min(CAST(timestamp + INTERVAL 5 HOUR AS DATE)) FROM obs), CAST(timestamp + INTERVAL 5 HOUR AS DATE)) BETWEEN 1 AND 3")
def _(t):
    return src.filter_forecast(t.select("city", F.unix_timestamp(F.col("timestamp").cast("timestamp")).alias("dt"), F.lit(18000).alias("offset")), "next_days").select("city", "dt")


NULLED = "nulled AS (SELECT * EXCLUDE (aqi), CASE WHEN ingest_seq % 17 <> 0 THEN aqi END AS aqi FROM obs)"


def nulled(spark: SparkSession, d: str) -> DataFrame:
    return src.with_nulls(obs(spark, d), ["aqi"])


@add("p16_batch_missing_mean", f"WITH {NULLED} SELECT {KEY}, {rs('coalesce(aqi, (SELECT avg(aqi) FROM nulled))')} AS aqi FROM nulled", nulled)
def _(t):
    return clean.batch_missing(t, ["aqi"], "mean").select(*C.key, r("aqi").alias("aqi"))


@add("p16_batch_missing_drop", f"WITH {NULLED} SELECT {KEY}, aqi FROM nulled WHERE aqi IS NOT NULL", nulled)
def _(t):
    return clean.batch_missing(t, ["aqi"], "drop").select(*C.key, "aqi")


@add("p17_forward_then_median", f"WITH {NULLED}, f AS (SELECT *, last_value(aqi IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS filled FROM nulled) SELECT {KEY}, {rs('coalesce(filled, (SELECT quantile_cont(aqi, 0.5) FROM nulled))')} AS aqi FROM f", nulled)
def _(t):
    m = t.agg(F.percentile("aqi", F.lit(0.5))).first()[0]
    return clean.forward_fill(t, ["aqi"], hours=48).select(*C.key, r(F.coalesce("aqi", F.lit(m))).alias("aqi"))


@add("p18_zero_fill", f"WITH {NULLED} SELECT {KEY}, coalesce(aqi, 0.0) AS aqi FROM nulled", nulled)
def _(t):
    return t.select(*C.key, "aqi").na.fill(0.0)


@add("p21_alerts", "SELECT city, timestamp, aqi, 'Hazardous air in ' || city AS message FROM obs WHERE aqi > 130")
def _(t):
    return jobs.alerts(t, 130.0)


@add("p22_sample", None)
def _(t):
    return clean.sample_rows(t.select(*C.key, "aqi"), 200, C.key)


# Joins -----------------------------------------------------------------------------------------------------------

_T = ", ".join(f"t{h}.aqi AS target_aqi_t_{h}" for h in (24, 48, 72))
_J = " ".join(f"LEFT JOIN obs t{h} ON t{h}.city = o.city AND t{h}.timestamp = o.timestamp + INTERVAL {h} HOUR" for h in (24, 48, 72))


@add("j01_exact_time_targets", f"SELECT o.city, o.timestamp, o.aqi, {_T} FROM obs o {_J}")
def _(t):
    return joins.targets(t.select("city", "timestamp", "aqi"))


@add("j01_targets_by_join", "SELECT o.city, o.timestamp, o.aqi, t.aqi AS target_aqi_t_24 FROM obs o LEFT JOIN obs t ON t.city = o.city AND t.timestamp = o.timestamp + INTERVAL 24 HOUR")
def _(t):
    return joins.targets_by_join(t.select("city", "timestamp", "aqi"), 24)


@add("j02_pair_hours", "SELECT city, timestamp, temperature, aqi FROM obs WHERE ingest_seq % 3 <> 0 AND ingest_seq % 5 <> 0")
def _(t):
    return joins.pair_hours(t.where("ingest_seq % 3 <> 0").select(*C.key, "temperature"), t.where("ingest_seq % 5 <> 0").select(*C.key, "aqi"), ["temperature", "aqi"])


@add("j04_degraded_merge", "SELECT city, timestamp, aqi, CASE WHEN ingest_seq % 4 <> 0 THEN temperature END AS temperature, ingest_seq % 4 <> 0 AS weather_available, CASE WHEN ingest_seq % 4 = 0 THEN 'weather missing' END AS degraded_reason FROM obs")
def _(t):
    return joins.degraded_merge(t.select(*C.key, "aqi"), t.where("ingest_seq % 4 <> 0").select(*C.key, "temperature"))


@add("j05_new_keys", "SELECT city, timestamp, aqi FROM obs WHERE ingest_seq % 3 = 0")
def _(t):
    return joins.new_rows(t.select(*C.key, "aqi"), t.where("ingest_seq % 3 <> 0").withColumn("city", F.upper("city")))


@add("j06_requested_rows", "SELECT city, timestamp, ingest_seq AS request, aqi FROM obs WHERE ingest_seq % 10 = 0")
def _(t):
    return joins.requested_rows(t.select(*C.key, "aqi"), t.where("ingest_seq % 10 = 0").select(*C.key, F.col("ingest_seq").alias("request")))


@add("j07_overlay", "SELECT city, timestamp, CASE WHEN ingest_seq % 2 = 0 THEN aqi + 1 ELSE aqi END AS aqi, CASE WHEN ingest_seq % 2 = 0 THEN pm25 ELSE 7.0 END AS pm25 FROM obs")
def _(t):
    live = t.where("ingest_seq % 2 = 0").select(*C.key, (F.col("aqi") + 1).alias("aqi"), "pm25")
    return joins.overlay(t.select(*C.key, "aqi", F.lit(None).cast("double").alias("pm25")), live, ["aqi", "pm25"], {"pm25": 7.0})


@add("j08_latest_valid", f"WITH {NULLED} SELECT city, arg_max(aqi, timestamp) FILTER (aqi IS NOT NULL) AS aqi, arg_max(wind_speed, timestamp) AS wind, max(timestamp) AS latest FROM nulled GROUP BY city", nulled)
def _(t):
    return joins.latest_valid(t, {"aqi": ["aqi"], "wind": ["wind_degree", "wind_speed"]})


@add("j09_day_difference", f"WITH d AS (SELECT city, CAST(timestamp AS DATE) AS day, avg(aqi) m FROM obs GROUP BY 1, 2) SELECT a.city, a.day, {rs('a.m - b.m')} AS difference FROM d a JOIN d b ON a.day = b.day AND b.city = 'click' WHERE a.city <> 'click'")
def _(t):
    return joins.day_difference(t, "click").withColumn("difference", r("difference"))


@add("j10_latest_with_ttl", "SELECT city, arg_max(timestamp, timestamp) AS timestamp, arg_max(aqi, timestamp) AS aqi FROM obs WHERE timestamp <= TIMESTAMP '2024-01-20' AND timestamp > TIMESTAMP '2024-01-20' - INTERVAL 5 DAY GROUP BY city")
def _(t):
    return joins.latest_features(t, F.lit("2024-01-20").cast("timestamp_ntz"), 5, ["aqi"])


def _requests(spark: SparkSession, d: str) -> DataFrame:
    """Every event asks for its entity's features as of its own time, each for a life of 20, 50 or 80 minutes."""
    e = events(spark, d)
    return e.select(F.col("event_type").alias("city"), F.col("ts").alias("timestamp"), "event_id", (20 + 30 * (F.col("event_id") % 3)).cast("int").alias("minutes"))


QUERIES["j10_as_of"] = lambda s, d: joins.as_of(_requests(s, d), obs(s, d), ["aqi", "pm25"], F.make_dt_interval(mins=F.col("minutes")))
SQL["j10_as_of"] = f"""WITH {OBS}, q AS (SELECT event_type AS city, ts AS timestamp, event_id, CAST(20 + 30 * (event_id % 3) AS INTEGER) AS minutes FROM events),
f AS (SELECT q.*, CASE WHEN obs.timestamp > q.timestamp - to_minutes(minutes) THEN obs END AS o FROM q ASOF LEFT JOIN obs ON q.city = obs.city AND q.timestamp >= obs.timestamp)
SELECT city, timestamp, event_id, minutes, o.aqi AS aqi, o.pm25 AS pm25, o.timestamp AS feature_time FROM f"""

QUERIES["j08_valid_as_of"] = lambda s, d: joins.as_of(_requests(s, d).drop("minutes"), nulled(s, d), ["aqi"], valid=True)
SQL["j08_valid_as_of"] = f"""WITH {OBS}, {NULLED}, q AS (SELECT event_type AS city, ts AS timestamp, event_id FROM events), v AS (SELECT city, timestamp, aqi FROM nulled WHERE aqi IS NOT NULL)
SELECT q.city, q.timestamp, event_id, v.aqi, v.timestamp AS feature_time FROM q ASOF LEFT JOIN v ON q.city = v.city AND q.timestamp >= v.timestamp"""


@table("j11_static_lookup", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey", "nation", "region")
def _(n, g):
    return n.join(g, n.n_regionkey == g.r_regionkey).select("n_nationkey", "n_name", "r_name")


@add("j12_aligned_days", f"SELECT CAST(timestamp AS DATE) AS day, {rs('avg(aqi)')} AS aqi_mean, {rs('avg(temperature)')} AS temperature_mean FROM obs GROUP BY 1")
def _(t):
    return joins.aligned_days(t, "aqi", "temperature").select("day", r("aqi_mean").alias("aqi_mean"), r("temperature_mean").alias("temperature_mean"))


# Windows ---------------------------------------------------------------------------------------------------------

_LAGS = windows.default_lags(CFG)
_LAG_SQL = ", ".join(f"lag({c}, {n}) OVER ({W}) AS {c}_lag_{n}" for c, ns in _LAGS.items() for n in ns)


@add("w01_lags", f"SELECT {KEY}, {_LAG_SQL} FROM obs")
def _(t):
    return windows.lags(t, _LAGS).select(*C.key, *[f"{c}_lag_{n}" for c, ns in _LAGS.items() for n in ns])


@add("w02_leads", f"SELECT {KEY}, " + ", ".join(f"lead(aqi, {n}) OVER ({W}) AS aqi_lead_{n}" for n in (1, 3, 6, 12, 24)) + " FROM obs")
def _(t):
    return windows.leads(t.select(*C.key, "aqi"), "aqi", (1, 3, 6, 12, 24)).drop("aqi")


_AGG = {"mean": "avg({c}) OVER f{w}", "std": "stddev_samp({c}) OVER f{w}", "min": "min({c}) OVER f{w}", "max": "max({c}) OVER f{w}", "median": "quantile_cont({c}, 0.5) OVER f{w}", "q25": "quantile_cont({c}, 0.25) OVER f{w}", "q75": "quantile_cont({c}, 0.75) OVER f{w}", "range": "max({c}) OVER f{w} - min({c}) OVER f{w}"}


def _rolling(name: str, stats: tuple[str, ...], cols: tuple[str, ...], ws: tuple[int, ...]) -> None:
    made = [(f"{c}_{windows.ROLLING[s][0]}_{w}h", _AGG[s].format(c=c, w=w)) for w in ws for c in cols for s in stats]
    frames = ", ".join(f"f{w} AS ({W} ROWS {w - 1} PRECEDING)" for w in ws)

    @add(name, f"SELECT {KEY}, " + ", ".join(f"{rs(x)} AS {n}" for n, x in made) + f" FROM obs WINDOW {frames}")
    def _(t):
        return windows.rolling(t, list(cols), ws, stats).select(*C.key, *[r(n).alias(n) for n, _ in made])


_rolling("w03_rolling_mean", ("mean",), tuple(C.measures), CFG.windows)
_rolling("w04_rolling_std", ("std",), ("aqi", "pm25", "pm10"), CFG.windows)
_rolling("w05_rolling_min", ("min",), tuple(C.measures), CFG.windows)
_rolling("w06_rolling_max", ("max",), tuple(C.measures), CFG.windows)
_rolling("w07_rolling_median", ("median",), ("aqi", "pm25"), (6, 24, 168))
_rolling("w08_rolling_quantiles", ("q25", "q75"), ("aqi",), (24,))
_rolling("w09_rolling_range", ("range",), ("aqi", "pm25", "temperature"), CFG.windows)

_EMA = f"""WITH {NULLED}, n AS (SELECT *, row_number() OVER ({W}) rn FROM nulled),
g AS (SELECT city, timestamp, rn, aqi, rn - max(CASE WHEN aqi IS NOT NULL THEN rn END) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap FROM n),
ema_step AS (SELECT city, timestamp, rn, aqi AS e6, aqi AS e24 FROM g WHERE rn = 1 UNION ALL
 SELECT g.city, g.timestamp, g.rn,
  CASE WHEN g.aqi IS NULL THEN s.e6 WHEN g.gap IS NULL THEN g.aqi ELSE (pow(1 - 2.0/7, g.gap) * s.e6 + 2.0/7 * g.aqi) / (pow(1 - 2.0/7, g.gap) + 2.0/7) END,
  CASE WHEN g.aqi IS NULL THEN s.e24 WHEN g.gap IS NULL THEN g.aqi ELSE (pow(1 - 2.0/25, g.gap) * s.e24 + 2.0/25 * g.aqi) / (pow(1 - 2.0/25, g.gap) + 2.0/25) END
 FROM ema_step s JOIN g ON g.city = s.city AND g.rn = s.rn + 1)
SELECT {KEY}, {rs('e6')} AS aqi_ema_6h, {rs('e24')} AS aqi_ema_24h FROM ema_step"""


@add("w10_ema", _EMA, nulled)
def _(t):
    return windows.ema(t.select(*C.key, "aqi"), "aqi", (6, 24)).select(*C.key, r("aqi_ema_6h").alias("aqi_ema_6h"), r("aqi_ema_24h").alias("aqi_ema_24h"))


@add("w11_difference", f"SELECT {KEY}, " + ", ".join(f"{rs(f'aqi - lag(aqi, {n}) OVER w')} AS aqi_diff_{n}" for n in CFG.differences) + f" FROM obs WINDOW w AS ({W})")
def _(t):
    return windows.differences(t, ["aqi"], CFG.differences).select(*C.key, *[r(f"aqi_diff_{n}").alias(f"aqi_diff_{n}") for n in CFG.differences])


@add("w12_percent_change", f"SELECT {KEY}, " + ", ".join(f"{rs(f'aqi / nullif(lag(aqi, {n}) OVER w, 0) - 1')} AS aqi_pctchange_{n}" for n in CFG.differences) + f" FROM obs WINDOW w AS ({W})")
def _(t):
    return windows.percent_changes(t, ["aqi"], CFG.differences).select(*C.key, *[r(f"aqi_pctchange_{n}").alias(f"aqi_pctchange_{n}") for n in CFG.differences])


@add("w13_rate_of_change", f"SELECT {KEY}, {rs('(aqi - lag(aqi, 3) OVER w) / 3')} AS aqi_roc_3 FROM obs WINDOW w AS ({W})")
def _(t):
    return windows.rates(t, ["aqi"], (3,)).select(*C.key, r("aqi_roc_3").alias("aqi_roc_3"))


@add("w14_momentum", f"WITH d AS (SELECT {KEY}, aqi - lag(aqi, 3) OVER ({W}) AS d FROM obs) SELECT {KEY}, {rs(f'd - lag(d, 3) OVER ({W})')} AS aqi_momentum_3 FROM d")
def _(t):
    return windows.momentum(t, ["aqi"]).select(*C.key, r("aqi_momentum_3").alias("aqi_momentum_3"))


@add("w16_w17_light_trend", f"SELECT {KEY}, {rs('coalesce(aqi - lag(aqi) OVER w, 0)')} AS aqi_change_rate, {rs(f'avg(aqi) OVER ({W} ROWS 2 PRECEDING)')} AS aqi_rolling_mean_3h FROM obs WINDOW w AS ({W})")
def _(t):
    return windows.light_trend(t).select(*C.key, r("aqi_change_rate").alias("aqi_change_rate"), r("aqi_rolling_mean_3h").alias("aqi_rolling_mean_3h"))


@add("w18_dedupe_last", "WITH k AS (SELECT *, row_number() OVER (PARTITION BY city, timestamp ORDER BY ingest_seq DESC) n FROM raw) SELECT * EXCLUDE n FROM k WHERE n = 1", raw)
def _(t):
    return clean.dedupe(t, C.key, "ingest_seq")


@add("w18_dedupe_first", "WITH k AS (SELECT *, row_number() OVER (PARTITION BY city, timestamp ORDER BY ingest_seq) n FROM raw) SELECT * EXCLUDE n FROM k WHERE n = 1", raw)
def _(t):
    return clean.dedupe(t, C.key, "ingest_seq", keep="first")


@add("w19_latest_rows", f"WITH k AS (SELECT city, timestamp, aqi, row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) n FROM obs) SELECT * EXCLUDE n FROM k WHERE n <= 168")
def _(t):
    return windows.latest_rows(t.select(*C.key, "aqi"))


@add("w20_gaps", f"WITH k AS (SELECT city, timestamp, lead(timestamp) OVER ({W}) nx FROM obs) SELECT city, timestamp + INTERVAL 1 HOUR AS gap_start, nx - INTERVAL 1 HOUR AS gap_end, date_diff('hour', timestamp, nx) - 1 AS missing_hours FROM k WHERE date_diff('hour', timestamp, nx) > 1")
def _(t):
    return windows.gaps(t)


_D = f"d AS (SELECT city, timestamp, date_diff('hour', lag(timestamp) OVER ({W}), timestamp) AS d FROM obs)"


@add("w21_gap_analysis", f"WITH {_D}, c AS (SELECT city, d, count(*) n FROM d WHERE d IS NOT NULL GROUP BY 1, 2), m AS (SELECT city, arg_max(d, n * 100000 - d) AS modal_hours FROM c GROUP BY 1) SELECT d.city, modal_hours, max(d) AS max_gap_hours, count(*) FILTER (d > 1.5 * modal_hours) AS large_gaps, count(*) FILTER (d = 0) AS repeated FROM d JOIN m ON d.city = m.city GROUP BY 1, 2")
def _(t):
    return windows.gap_analysis(t)


@add("w22_forward_fill", f"WITH {NULLED} SELECT {KEY}, last_value(aqi IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS aqi FROM nulled", nulled)
def _(t):
    return clean.forward_fill(t, ["aqi"]).select(*C.key, "aqi")


@add("w23_trend", f"WITH k AS (SELECT city, aqi, row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) n FROM obs), v AS (SELECT city, round(max(aqi) FILTER (n = 1) - max(aqi) FILTER (n = 2), 2) AS value FROM k GROUP BY 1) SELECT city, value, CASE WHEN value IS NULL THEN 'unknown' WHEN value > 0 THEN 'up' WHEN value < 0 THEN 'down' ELSE 'flat' END AS direction, CASE WHEN value IS NULL THEN 'Insufficient AQI history' WHEN value > 0 THEN '▲ +' || CAST(value AS VARCHAR) || ' since last reading' WHEN value < 0 THEN '▼ ' || CAST(value AS VARCHAR) || ' since last reading' ELSE 'No change since last reading' END AS label FROM v")
def _(t):
    return windows.trend(t)


@add("w24_recent_history", "WITH m AS (SELECT city, max(timestamp) mx FROM obs GROUP BY 1) SELECT o.city, o.timestamp, o.aqi FROM obs o JOIN m USING (city) WHERE o.timestamp >= mx - INTERVAL 24 HOUR")
def _(t):
    return windows.recent(t.select(*C.key, "aqi"), 24)


@add("w25_longest_run", f"WITH {_D}, k AS (SELECT city, sum(CASE WHEN d > 1.5 THEN 1 ELSE 0 END) OVER ({W}) AS run FROM d), c AS (SELECT city, run, count(*) n FROM k GROUP BY 1, 2) SELECT city, max(n) AS longest_run FROM c GROUP BY 1")
def _(t):
    return windows.longest_run(t)


_DAILY = "daily AS (SELECT o_orderpriority AS city, CAST(o_orderdate AS TIMESTAMP) AS timestamp, avg(o_totalprice) AS aqi FROM orders GROUP BY 1, 2)"


def daily(spark: SparkSession, d: str) -> DataFrame:
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.groupBy(F.col("o_orderpriority").alias("city"), F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp")).agg(F.avg("o_totalprice").alias("aqi"))


_DAILY_EMA = f"""WITH RECURSIVE {_DAILY}, n AS (SELECT *, row_number() OVER ({W}) AS rn FROM daily),
ema_step AS (SELECT city, timestamp, rn, aqi AS e7, aqi AS e30 FROM n WHERE rn = 1 UNION ALL
 SELECT n.city, n.timestamp, n.rn, n.aqi * 2.0 / 8 + (1 - 2.0 / 8) * s.e7, n.aqi * 2.0 / 31 + (1 - 2.0 / 31) * s.e30 FROM ema_step s JOIN n ON n.city = s.city AND n.rn = s.rn + 1)
SELECT city, timestamp, {rs(f'avg(aqi) OVER ({W} ROWS 6 PRECEDING)')} AS ma_7, {rs(f'avg(aqi) OVER ({W} ROWS 29 PRECEDING)')} AS ma_30, {rs('e7')} AS ema_7, {rs('e30')} AS ema_30
FROM ema_step JOIN daily USING (city, timestamp)"""


@add("w26_daily_averages", _DAILY_EMA, daily)
def _(t):
    x = windows.ema(windows.rolling(t, ["aqi"], (7, 30), ("mean",)), "aqi", (7, 30), hours=24 * 128)
    return x.select(*C.key, *[r(f"aqi_{a}_{n}h").alias(f"{b}_{n}") for a, b in (("rollmean", "ma"), ("ema", "ema")) for n in (7, 30)])


@add("w27_full_windows", f"SELECT {KEY}, {rs('CASE WHEN count(aqi) OVER f = 168 THEN avg(aqi) OVER f END')} AS aqi_rollmean_168h, {rs('CASE WHEN count(aqi) OVER f = 168 THEN stddev_samp(aqi) OVER f END')} AS aqi_rollstd_168h FROM obs WINDOW f AS ({W} ROWS 167 PRECEDING)")
def _(t):
    return windows.rolling(t, ["aqi"], (168,), ("mean", "std"), full=True).select(*C.key, r("aqi_rollmean_168h").alias("aqi_rollmean_168h"), r("aqi_rollstd_168h").alias("aqi_rollstd_168h"))


@add("w29_row_chunks", f"WITH k AS (SELECT city, timestamp, row_number() OVER ({W}) rn, count(*) OVER (PARTITION BY city) n FROM obs) SELECT city, timestamp, least(CAST(floor((rn - 1) / greatest(n // 4, 1)) AS BIGINT), 3) AS chunk FROM k")
def _(t):
    return windows.row_splits(t.select(*C.key), 4).withColumn("chunk", F.col("chunk").cast("long"))


_SPLIT = "hours AS (SELECT timestamp, row_number() OVER (ORDER BY timestamp) k, count(*) OVER () n FROM (SELECT DISTINCT timestamp FROM obs)), s AS (SELECT o.*, CASE WHEN k <= CAST(floor(n * 0.70::DOUBLE) AS BIGINT) THEN 'train' WHEN k <= CAST(floor(n * (0.70::DOUBLE + 0.15::DOUBLE)) AS BIGINT) THEN 'validation' ELSE 'test' END AS split FROM obs o JOIN hours USING (timestamp))"


@add("w30_chronological_split", f"WITH {_SPLIT} SELECT {KEY}, split FROM s")
def _(t):
    return windows.chronological_split(t).select(*C.key, "split")


@add("rolling_by_time", f"SELECT {KEY}, {rs(f'avg(aqi) OVER ({W} RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW)')} AS aqi_rollmean_24h FROM obs")
def _(t):
    return windows.rolling(t, ["aqi"], (24,), ("mean",), mode="time").select(*C.key, r("aqi_rollmean_24h").alias("aqi_rollmean_24h"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    t = clean.canonicalise(obs(spark, d)).select(*C.key, "aqi")
    made = windows.in_blocks(t, lambda x, c: windows.rolling(windows.lags(x, {"aqi": (1, 24)}, c), ["aqi"], (6,), ("mean",), c), 24)
    return joins.targets(made, (24,))


QUERIES["flagship"] = lambda spark, d: flagship(spark, d).withColumn("aqi_rollmean_6h", r("aqi_rollmean_6h"))
SQL["flagship"] = f"WITH {OBS} SELECT upper(o.city[1]) || lower(o.city[2:]) AS city, o.timestamp, o.aqi, lag(o.aqi, 1) OVER w AS aqi_lag_1, lag(o.aqi, 24) OVER w AS aqi_lag_24, {rs('avg(o.aqi) OVER (PARTITION BY o.city ORDER BY o.timestamp ROWS 5 PRECEDING)')} AS aqi_rollmean_6h, t.aqi AS target_aqi_t_24 FROM obs o LEFT JOIN obs t ON t.city = o.city AND t.timestamp = o.timestamp + INTERVAL 24 HOUR WINDOW w AS (PARTITION BY o.city ORDER BY o.timestamp)"

"""Queries of runs, summaries, prediction contracts and stored versions."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourloom.config import FeatureConfig
from hourloom.functions import features as fx
from hourloom.operators import clean, joins, reports, sets, windows
from hourloom.plans import build, bundle, dataset, training
from hourloom.queries import C, KEY, NULLED, QUERIES, SQL, OBS, W, _DAILY, add, daily, nulled, obs, r, raw, rs
from hourloom.sources import sinks
from hourloom.streaming.jobs import shared_folder

_STATUS = "CASE WHEN aqi > 150 THEN 'failed' WHEN aqi > 100 THEN 'degraded' ELSE 'succeeded' END"


@add("a36_run_summary", f"WITH x AS (SELECT city, pm25, {_STATUS} AS status FROM raw) SELECT city, count(*) AS n, count(*) FILTER (status = 'succeeded') AS succeeded, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'degraded') AS degraded, round(100.0::DOUBLE * count(*) FILTER (status = 'succeeded') / count(*), 2) AS success_pct, {rs('avg(pm25)')} AS mean_seconds FROM x GROUP BY 1", raw)
def _(t):
    runs = t.select("city", F.expr(_STATUS).alias("status"), F.col("pm25").alias("seconds"))
    return reports.run_summary(runs, ["city"], digits=12).withColumn("mean_seconds", r("mean_seconds"))


_NUMBER = "SELECT '{c}' AS field, count({c}) AS n, round(avg({c}) + 3.14159e-9, 6) AS mean, round(stddev_samp({c}) + 3.14159e-9, 6) AS std, min({c})::DOUBLE AS min, round(quantile_cont({c}, 0.25) + 3.14159e-9, 6) AS q1, round(quantile_cont({c}, 0.5) + 3.14159e-9, 6) AS median, round(quantile_cont({c}, 0.75) + 3.14159e-9, 6) AS q3, max({c})::DOUBLE AS max, NULL::BIGINT AS n_unique, NULL::VARCHAR AS top, NULL::BIGINT AS freq FROM raw"


@add("a46_column_summary", "WITH k AS (SELECT city AS v, count(*) AS c FROM raw WHERE city IS NOT NULL GROUP BY 1) " + " UNION ALL ".join(_NUMBER.format(c=c) for c in ("aqi", "pm25")) + " UNION ALL SELECT 'city', CAST(sum(c) AS BIGINT), NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*), (SELECT v FROM k ORDER BY c DESC, v LIMIT 1), max(c) FROM k", raw)
def _(t):
    out = reports.column_summary(t, ["aqi", "pm25"], ["city"], digits=12)
    return out.withColumns({c: r(c) for c in ("mean", "std", "q1", "median", "q3")})


_PARTS = {"temperature": "temperature * 0.5", "humidity": "humidity * -0.25", "pressure": "(pressure - 1010) * 2"}


@add("a48_mean_contributions", "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS feature, {rs(f'avg(abs({x}))')} AS mean_abs_contribution FROM obs" for n, x in _PARTS.items()) + ") ORDER BY 2 DESC LIMIT 2")
def _(t):
    long = t.select(*C.key, F.inline(F.array(*[F.struct(F.lit(n).alias("feature"), F.expr(x).cast("double").alias("contribution")) for n, x in _PARTS.items()])))
    return reports.mean_contributions(long, 2, digits=12).withColumn("mean_abs_contribution", r("mean_abs_contribution"))


_FEATURES = ("pm25", "pm10", "no2", "so2", "co", "o3", "temperature", "humidity", "pressure", "wind_speed")


@add("t04_ranked_correlations", "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {rs(f'corr({c}, aqi)')} AS corr FROM obs" for c in _FEATURES) + ") ORDER BY abs(corr) DESC NULLS LAST, feature LIMIT 5")
def _(t):
    made = reports.target_correlations(t, list(_FEATURES), "aqi", digits=12)
    return reports.ranked(made.withColumn("corr", r("corr")), F.abs("corr"), "feature", 5)


@add("a20_leakage_risk", "SELECT count(*) FILTER (coalesce(abs(c) > CASE WHEN p THEN 0.98 ELSE 0.95 END, false)) AS risk_score FROM (" + " UNION ALL ".join(f"SELECT corr({c}, aqi) AS c, {str(c in ('pm25', 'pm10')).lower()} AS p FROM obs" for c in ("pm25", "pm10", "wind_speed", "humidity")) + ")")
def _(t):
    return reports.leakage_risk(t, ["pm25", "pm10", "wind_speed", "humidity"], ("pm25", "pm10"), "aqi")


@add("a40_split_overlaps", "WITH x AS (SELECT CASE WHEN aqi <= 40 THEN 'train' WHEN aqi <= 70 THEN 'validation' ELSE 'test' END AS split, timestamp FROM obs), s AS (SELECT split, min(timestamp) AS start, max(timestamp) AS \"end\" FROM x GROUP BY 1) SELECT split, start, \"end\", coalesce(start <= max(\"end\") OVER (ORDER BY start, split ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS overlaps FROM s")
def _(t):
    return reports.split_overlaps(t.withColumn("split", F.expr("CASE WHEN aqi <= 40 THEN 'train' WHEN aqi <= 70 THEN 'validation' ELSE 'test' END")))


@add("p14_canonical_entity", "SELECT city, timestamp, aqi FROM obs")
def _(t):
    names = ("click", "error", "purchase", "signup", "view")
    return clean.canonical_entity(t.withColumn("city", F.concat(F.lit("  "), F.upper("city"), F.lit(" "))), list(names)).select(*C.key, "aqi")


@add("p11_convert_kelvin", f"SELECT {KEY}, {rs('CASE WHEN humidity * 4 > 130 THEN round(humidity * 4 - 273.15, 2) ELSE humidity * 4 END')} AS temperature, {rs('CASE WHEN humidity * 4 > 130 THEN round(pressure - 273.15, 2) ELSE pressure END')} AS pressure FROM (SELECT city, timestamp, round(humidity) AS humidity, round(pressure) AS pressure FROM obs) AS obs")
def _(t):
    x = t.select(*C.key, (F.round("humidity") * 4).alias("temperature"), F.round("pressure").alias("pressure"))
    return clean.convert_kelvin(x, "temperature", ["pressure", "temperature"]).select(*C.key, r("temperature").alias("temperature"), r("pressure").alias("pressure"))


def _weather_and_air(t):
    return t.where("ingest_seq % 5 <> 0").select(*C.key, F.when(F.col("ingest_seq") % 7 != 0, F.col("temperature")).alias("temperature")), t.where("ingest_seq % 3 <> 0").select(*C.key, "aqi")


_MERGED = "WITH x AS (SELECT city, timestamp, ingest_seq % 5 <> 0 AS w, ingest_seq % 3 <> 0 AS a, ingest_seq % 7 <> 0 AS h FROM obs)"


@add("j03_failed_pairs", _MERGED + " SELECT city, timestamp, CASE WHEN NOT w THEN 'weather missing' WHEN NOT a THEN 'air missing' ELSE 'temperature: missing' END AS error FROM x WHERE (w OR a) AND NOT (w AND a AND h)")
def _(t):
    return joins.merge_batch(*_weather_and_air(t), ["temperature"])[1].select(*C.key, "error")


@add("j03_merged_pairs", _MERGED + f" SELECT o.city, o.timestamp, {rs('o.temperature')} AS temperature, o.aqi FROM obs o JOIN x USING (city, timestamp) WHERE w AND a AND h")
def _(t):
    return joins.merge_batch(*_weather_and_air(t), ["temperature"])[0].select(*C.key, r("temperature").alias("temperature"), "aqi")


def _line(t):
    """A ridge fit of one feature, whose closed form SQL can tell."""
    train = t.select(F.col("wind_speed"), F.col("aqi").alias("label"))
    return Pipeline(stages=[VectorAssembler(inputCols=["wind_speed"], outputCol="features"), training.ridge(train)]).fit(train)


_FIT = "WITH f AS (SELECT covar_pop(aqi, wind_speed) * count(*) / (var_pop(wind_speed) * count(*) + 10) AS b, avg(aqi) AS y, avg(wind_speed) AS x FROM obs), p AS (SELECT city, timestamp, aqi, ingest_seq, y + b * (CASE WHEN ingest_seq % 4 <> 0 THEN wind_speed ELSE 0 END - x) AS predicted FROM obs, f)"


@add("m10_batch_predictions", _FIT + " SELECT city, timestamp, round(predicted, 2) AS predicted_aqi, CASE WHEN ingest_seq % 4 <> 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS completeness, '1.0.0' AS version FROM p")
def _(t):
    return training.predictions(_line(t), t.withColumn("wind_speed", F.when(F.col("ingest_seq") % 4 != 0, F.col("wind_speed"))), ["wind_speed"], "1.0.0")


@add("m09_residuals", _FIT.replace("CASE WHEN ingest_seq % 4 <> 0 THEN wind_speed ELSE 0 END", "wind_speed") + f" SELECT city, timestamp, aqi::DOUBLE AS actual, {rs('predicted')} AS predicted, {rs('aqi - predicted')} AS residual FROM p")
def _(t):
    return training.residuals(_line(t), t, ["wind_speed"], "aqi").withColumns({c: r(c) for c in ("predicted", "residual")})


_ERRORS = " UNION ALL ".join(f"SELECT {h}::BIGINT AS h, round(sqrt(avg(pow(t.aqi - o.aqi, 2))), 4) AS rmse FROM obs o JOIN obs t ON t.city = o.city AND t.timestamp = o.timestamp + INTERVAL {h} HOUR" for h in (24, 48, 72))


@add("m18_forecasts_with_errors", f"WITH e AS ({_ERRORS}), l AS (SELECT city, aqi FROM obs QUALIFY row_number() OVER ({W} DESC) = 1) SELECT h AS horizon_hours, city, aqi AS predicted_aqi, rmse AS test_rmse FROM l, e")
def _(t):
    x = joins.targets(t)
    tested = [x.where(F.col(f"target_aqi_t_{h}").isNotNull()).select(F.lit(h).cast("long").alias("horizon"), F.col("aqi").alias("predicted"), F.col(f"target_aqi_t_{h}").alias("actual")) for h in training.HORIZONS]
    made = windows.latest_rows(t, 1).select("city", F.col("aqi").alias("predicted_aqi"), F.explode(F.array(*[F.lit(h).cast("long") for h in training.HORIZONS])).alias("horizon_hours"))
    return training.with_test_errors(made, reports.regression_metrics(sets.stack(*tested), by=["horizon"]))


def _built(spark, d):
    """Two stored versions of the observations, of which the later one corrects every fifth row, built into one table."""
    t, root = obs(spark, d).select(*C.key, "aqi", "pm25", "ingest_seq"), shared_folder(spark)
    sinks.save_batch(t, root, 1)
    sinks.save_batch(t.where("ingest_seq % 5 = 0").withColumn("aqi", F.col("aqi") + 1), root, 2)
    return build.training_table(spark, f"{root}/format=parquet", f"{root}/built", ["aqi", "pm25"]).select(*C.key, "aqi", "pm25")


QUERIES["m17_training_table"] = _built
SQL["m17_training_table"] = f"WITH {OBS} SELECT upper(city[1]) || city[2:] AS city, timestamp, CASE WHEN ingest_seq % 5 = 0 THEN aqi + 1 ELSE aqi END AS aqi, pm25 FROM obs"


# Steps of the feature chain, bundles and what is written ----------------------------------------------------------

CITIES = ("Click", "Purchase", "View")
CHAIN = FeatureConfig(cities=CITIES, quantiles=True, place=("port", 24.8, 66.9))
#: Columns of the chain that SQL tells: some of every step.
_FRAMES = {6: "f6", 24: "f24", 168: "f168"}
_SLICE = {
    "hour": "extract('hour' FROM timestamp)::BIGINT", "is_weekend": "(isodow(timestamp) >= 6)::BIGINT", "aqi_lag_72": f"lag(aqi, 72) OVER ({W})", "o3_lag_24": f"lag(o3, 24) OVER ({W})", "humidity_lag_6": f"lag(humidity, 6) OVER ({W})",
    **{f"pm25_rollmean_{w}h": f"avg(pm25) OVER {f}" for w, f in _FRAMES.items()}, **{f"pm10_rollstd_{w}h": f"stddev_samp(pm10) OVER {f}" for w, f in _FRAMES.items()}, **{f"aqi_rollmedian_{w}h": f"quantile_cont(aqi, 0.5) OVER {f}" for w, f in _FRAMES.items()},
    **{f"co_rollq25_{w}h": f"quantile_cont(co, 0.25) OVER {f}" for w, f in _FRAMES.items()}, "co_rollq75_168h": "quantile_cont(co, 0.75) OVER f168", "so2_rollrange_24h": "max(so2) OVER f24 - min(so2) OVER f24", "aqi_diff_24": f"aqi - lag(aqi, 24) OVER ({W})",
    "pm25_pctchange_3": f"pm25 / nullif(lag(pm25, 3) OVER ({W}), 0) - 1", "no2_roc_6": f"(no2 - lag(no2, 6) OVER ({W})) / 6", "aqi_momentum_3": f"aqi - 2 * lag(aqi, 3) OVER ({W}) + lag(aqi, 6) OVER ({W})", "temp_humidity_interaction": "temperature * humidity",
    "pm25_pm10_ratio": "pm25 / (pm10 + 0.1)", "lat_lon_product": "24.86::DOUBLE * 67.0",
}
_FLAGS = {f"city_{c}": f"(city = '{c.lower()}')::BIGINT" for c in CITIES}
_WHOLE = {"hour", "is_weekend"}
_ALPHA = 2.0 / 25
_CHAIN = f"""WITH n AS (SELECT *, row_number() OVER ({W}) AS rn FROM obs),
ema_step AS (SELECT city, timestamp, rn, temperature AS e FROM n WHERE rn = 1 UNION ALL SELECT n.city, n.timestamp, n.rn, n.temperature * {_ALPHA}::DOUBLE + (1 - {_ALPHA}::DOUBLE) * s.e FROM ema_step s JOIN n ON n.city = s.city AND n.rn = s.rn + 1),
x AS (SELECT city, timestamp, aqi, {", ".join(f"{v if k in _WHOLE else rs(v)} AS {k}" for k, v in _SLICE.items())}, {", ".join(f"{v} AS {k}" for k, v in _FLAGS.items())} FROM obs WINDOW {", ".join(f"{f} AS ({W} ROWS {w - 1} PRECEDING)" for w, f in _FRAMES.items())})
SELECT x.*, {rs('e')} AS temperature_ema_24h FROM x JOIN ema_step USING (city, timestamp)"""


@add("m01_chain_slice", _CHAIN)
def _(t):
    made = dataset.chain(t.withColumns({"latitude": F.lit(24.86), "longitude": F.lit(67.0)}), CHAIN)
    return made.select(*C.key, "aqi", *[F.col(k) if k in _WHOLE else r(k).alias(k) for k in _SLICE], *_FLAGS, r("temperature_ema_24h").alias("temperature_ema_24h"))


@add("f30_float32", f"SELECT {KEY}, {', '.join(f'CAST({v} AS FLOAT) AS {k}' for k, v in (('aqi_rollmax_6h', f'max(aqi) OVER ({W} ROWS 5 PRECEDING)'), ('aqi_rollmin_24h', f'min(aqi) OVER ({W} ROWS 23 PRECEDING)')))} FROM obs")
def _(t):
    made = windows.rolling(t, ["aqi"], (6, 24), ("min", "max"))
    return dataset.rolled_as_float(made).select(*C.key, "aqi_rollmax_6h", "aqi_rollmin_24h")


def _through_bundle(t):
    """Ridge of one scaled feature, fitted, saved and loaded again; the loaded bundle predicts."""
    spark, train = t.sparkSession, clean.usable(joins.targets(t.select(*C.key, "aqi", "wind_speed"), (24,)), 24).drop("aqi")
    state = dataset.Preprocessor().fit(train)
    x = state.transform(train).select(*state.features, F.col("target_aqi_t_24").alias("label"))
    model = Pipeline(stages=[VectorAssembler(inputCols=state.features, outputCol="features"), training.ridge(x)]).fit(x)
    path = shared_folder(spark)
    bundle.save_bundle(bundle.Bundle(model, state, tuple(state.features), 24, "ridge", "2.0.1"), spark, path)
    return bundle.load_bundle(spark, path).predict(t.select(*C.key, "wind_speed"))


@add("m13_bundle_predictions", "WITH p AS (SELECT o.wind_speed AS x, f.aqi AS y FROM obs o JOIN obs f ON f.city = o.city AND f.timestamp = o.timestamp + INTERVAL 24 HOUR), s AS (SELECT avg(x) AS m, stddev_pop(x) AS d, covar_pop(y, x) * count(*) / stddev_pop(x) / (count(*) + 10) AS b, avg(y) AS a FROM p) SELECT city, timestamp, round(a + b * (wind_speed - m) / d, 2) AS predicted_aqi, 1.0::DOUBLE AS completeness, '2.0.1' AS version FROM obs, s")
def _(t):
    return _through_bundle(t)


#: Ridge of two features by Cramer's rule on centred sums.
_TWO = "s AS (SELECT count(*) * var_pop(wind_speed) + 10 AS aa, count(*) * var_pop(humidity) + 10 AS bb, count(*) * covar_pop(wind_speed, humidity) AS ab, count(*) * covar_pop(wind_speed, aqi) AS ay, count(*) * covar_pop(humidity, aqi) AS hy FROM obs), b AS (SELECT (ay * bb - hy * ab) / (aa * bb - ab * ab) AS w, (hy * aa - ay * ab) / (aa * bb - ab * ab) AS h FROM s)"
_PAIR = ["wind_speed", "humidity"]


def _two(t):
    train = t.select(*_PAIR, F.col("aqi").alias("label"))
    return Pipeline(stages=[VectorAssembler(inputCols=_PAIR, outputCol="features"), training.ridge(train)]).fit(train)


@add("m12_contributions", f"WITH {_TWO}, l AS (SELECT city, timestamp, 'wind_speed' AS feature, w * wind_speed AS c FROM obs, b UNION ALL SELECT city, timestamp, 'humidity', h * humidity FROM obs, b), m AS (SELECT *, max(abs(c)) OVER (PARTITION BY city, timestamp) AS top FROM l) SELECT city, timestamp, feature, round(c + 3.14159e-6, 3) AS contribution, CASE WHEN top <= 0 THEN 'Low' WHEN abs(c) / top >= 0.66 THEN 'High' WHEN abs(c) / top >= 0.33 THEN 'Medium' ELSE 'Low' END AS impact, CASE WHEN c > 0 THEN 'increases' WHEN c < 0 THEN 'decreases' ELSE 'neutral' END AS direction FROM m")
def _(t):
    made = training.contributions(_two(t), t, _PAIR, C.key, digits=12)
    return made.withColumn("contribution", F.round(F.col("contribution") + 3.14159e-6, 3))


@add("a45_importance", f"WITH {_TWO} SELECT 'wind_speed' AS feature, {rs('abs(w)')} AS importance FROM b UNION ALL SELECT 'humidity', {rs('abs(h)')} FROM b")
def _(t):
    made = training.importance(_two(t), _PAIR)
    return t.sparkSession.createDataFrame(made, "feature string, importance double").withColumn("importance", r("importance"))


_WEIGHTS = {"completeness": 3.0, "continuity": 3.0, "uniqueness": 2.0, "validity": 2.0}


@add("a43_readiness", f"WITH {NULLED}, g AS (SELECT date_diff('hour', lag(timestamp) OVER ({W}), timestamp) - 1 AS h FROM nulled), k AS (SELECT (SELECT count(aqi) + count(pm25) FROM nulled) / (2 * count(*))::DOUBLE AS c, count(*) / (count(*) + (SELECT coalesce(sum(h) FILTER (h > 0), 0) FROM g))::DOUBLE AS t, 1 - (count(*) - count(DISTINCT (city, timestamp))) / count(*)::DOUBLE AS u, 1 - count(*) FILTER (aqi < 0 OR aqi > 500) / count(*)::DOUBLE AS v FROM nulled), s AS (SELECT *, round(100 * (3 * c + 3 * t + 2 * u + 2 * v) / 10, 1) AS score FROM k) SELECT round(c, 4) AS completeness, round(t, 4) AS continuity, round(u, 4) AS uniqueness, round(v, 4) AS validity, score, CASE WHEN score >= 90 THEN 'A' WHEN score >= 75 THEN 'B' WHEN score >= 60 THEN 'C' WHEN score >= 40 THEN 'D' ELSE 'F' END AS grade FROM s", nulled)
def _(t):
    return reports.readiness_report(t, ["aqi", "pm25"], _WEIGHTS)


@add("p03_without_stale", "SELECT * EXCLUDE (co, o3) FROM obs")
def _(t):
    return clean.drop_stale(t, ["co", "o3", "not_there"])


@add("p19_contract", "SELECT wind_speed, aqi, humidity FROM obs")
def _(t):
    return clean.enforce_contract(t.select("humidity", "wind_speed", "city", "timestamp", "aqi"), ["wind_speed", "aqi", "humidity"])


@add("p20_features_alone", "SELECT aqi, pm25 FROM obs")
def _(t):
    x = joins.targets(t.select(*C.key, "aqi", "pm25", "ingest_seq"), (24, 48)).withColumn("split", F.lit("train"))
    return x.select(*clean.feature_columns(x.columns))


@add("f15_advice", f"SELECT {KEY}, CASE WHEN aqi IS NULL THEN 'Current AQI reading is unavailable.' WHEN aqi <= 50 THEN 'Air quality is good. Normal outdoor activity is acceptable.' WHEN aqi <= 100 THEN 'Air quality is moderate. Sensitive people should monitor symptoms.' WHEN aqi <= 150 THEN 'Air may affect sensitive groups. Reduce long outdoor exposure.' WHEN aqi <= 200 THEN 'Air quality is unhealthy. Limit outdoor activity where possible.' WHEN aqi <= 300 THEN 'Air quality is very unhealthy. Avoid prolonged outdoor exposure.' ELSE 'Air quality is hazardous. Avoid outdoor exposure as much as possible.' END AS message FROM nulled".replace(f"SELECT {KEY}", f"WITH {NULLED} SELECT {KEY}", 1), nulled)
def _(t):
    return t.select(*C.key, fx.advice(fx.display_category(F.col("aqi"))).alias("message"))


@add("f25_row_checksum", f"SELECT {KEY}, sha256(CAST(to_json({{'city': city, 'ingest_seq': ingest_seq}}) AS VARCHAR)) AS checksum FROM obs")
def _(t):
    return t.select(*C.key, fx.row_checksum(["ingest_seq", "city"]).alias("checksum"))


@add("f27_display_name", f"SELECT {KEY}, upper(city[1]) || city[2:] || ' PM2.5 Lag ' || CAST(ingest_seq AS VARCHAR) AS name FROM obs")
def _(t):
    return t.select(*C.key, fx.display_name(F.concat("city", F.lit("_pm25_lag_"), F.col("ingest_seq").cast("string"))).alias("name"))


@add("j11_coordinates", f"SELECT {KEY}, CASE city WHEN 'click' THEN 24.8607 WHEN 'view' THEN 31.5204 ELSE 0.5 END::DOUBLE AS latitude, CASE city WHEN 'click' THEN 67.0011 WHEN 'view' THEN 74.3587 ELSE -1.5 END::DOUBLE AS longitude FROM obs")
def _(t):
    places = {"click": (24.8607, 67.0011), "view": (31.5204, 74.3587)} | {c: (0.5, -1.5) for c in ("purchase", "signup", "error")}
    return t.select(*C.key, fx.coordinates(F.concat(F.lit(" "), F.upper("city")), places).alias("p")).select(*C.key, "p.*")


@add("f18_f20_spatial_step", f"SELECT {KEY}, {', '.join(f'{v} AS {k}' for k, v in _FLAGS.items())}, {rs('temperature * humidity')} AS lat_lon_product FROM obs")
def _(t):
    x = t.select(*C.key, F.col("temperature").cast("string").alias("latitude"), F.col("humidity").cast("string").alias("longitude"))
    return dataset.spatial_step(x, CHAIN, C).select(*C.key, *_FLAGS, r("lat_lon_product").alias("lat_lon_product"))


def _written(t, write, read):
    path = shared_folder(t.sparkSession)
    write(t, path)
    return read(t.sparkSession, path)


@add("s16_forecast_sink", f"SELECT {KEY}, aqi AS predicted_aqi, kind FROM obs, (VALUES ('parquet'), ('csv')) k(kind)")
def _(t):
    x = t.select(*C.key, F.col("aqi").alias("predicted_aqi"))
    files = lambda s, p: s.read.parquet(f"{p}/parquet").withColumn("kind", F.lit("parquet")).unionByName(s.read.schema(x.schema).option("header", True).csv(f"{p}/csv").withColumn("kind", F.lit("csv")))
    return _written(x, sinks.save_forecast, files)


@add("s17_report_sink", "SELECT city, count(*) AS n FROM obs GROUP BY 1")
def _(t):
    return _written(reports.value_counts(t, "city"), sinks.save_report, lambda s, p: s.read.schema("city string, n bigint").json(p))


@add("s18_split_sink", "SELECT city, timestamp, aqi, CASE WHEN aqi <= 40 THEN 'train' WHEN aqi <= 70 THEN 'validation' ELSE 'test' END AS split FROM obs")
def _(t):
    x = t.select(*C.key, "aqi", F.expr("CASE WHEN aqi <= 40 THEN 'train' WHEN aqi <= 70 THEN 'validation' ELSE 'test' END").alias("split"))
    return _written(x, sinks.save_splits, lambda s, p: s.read.parquet(p).select(*x.columns))


@add("s09_s10_batches", f"SELECT {KEY}, aqi, kind FROM obs, (VALUES ('parquet'), ('csv'), ('json')) k(kind)")
def _(t):
    x = t.select(*C.key, "aqi")
    made = sinks.save_batch(x, shared_folder(t.sparkSession), 3, ("parquet", "csv", "json"))
    return sets.stack(*[sinks.read_batch(t.sparkSession, p, f, x.schema).withColumn("kind", F.lit(f)) for f, p in made.items()])


_LAST = f"WITH {NULLED}, k AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) AS n, max(timestamp) OVER (PARTITION BY city) AS mx FROM nulled), v AS (SELECT city, aqi, row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) AS n FROM nulled WHERE aqi IS NOT NULL), c AS (SELECT city, round(max(aqi) FILTER (n = 1) - max(aqi) FILTER (n = 2), 2) AS change FROM v GROUP BY 1)"


@add("m15_full_summary", _LAST + ", s AS (SELECT city, max(mx) AS latest, max(aqi) FILTER (n = 1) AS current, arg_max(CASE WHEN pm10 > pm25 THEN 'PM10' ELSE 'PM2.5' END, timestamp) AS dominant, count(*) FILTER (timestamp >= mx - INTERVAL 24 HOUR) AS n_day, count(*) FILTER (timestamp >= mx - INTERVAL 168 HOUR) AS n_week, count(*) FILTER (timestamp >= mx - INTERVAL 720 HOUR) AS n_month, min(timestamp) FILTER (timestamp >= mx - INTERVAL 168 HOUR) AS week_start FROM k GROUP BY 1), e AS (SELECT * FROM s JOIN c USING (city)) SELECT city, latest, current, CASE WHEN current IS NULL THEN 'Unavailable' WHEN current <= 50 THEN 'Good' WHEN current <= 100 THEN 'Moderate' WHEN current <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN current <= 200 THEN 'Unhealthy' WHEN current <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END AS category, change, CASE WHEN change IS NULL THEN 'unknown' WHEN change > 0 THEN 'up' WHEN change < 0 THEN 'down' ELSE 'flat' END AS direction, dominant, '24h 48h 72h' AS horizons, n_day, n_week, n_month, week_start, CASE WHEN current IS NULL THEN 'no valid reading' END AS error FROM e UNION ALL SELECT 'nowhere', NULL, NULL, 'Unavailable', NULL, NULL, NULL, '', 0, 0, 0, NULL, 'no rows'", nulled)
def _(t):
    ahead = windows.latest_rows(t, 1).select("city", F.explode(F.array(*[F.lit(h).cast("long") for h in (72, 24, 48)])).alias("horizon_hours"), "timestamp", F.col("aqi").alias("predicted_aqi"))
    cities = [x.city for x in t.select("city").distinct().collect()]
    made = training.full_summary(t.select(*C.key, "aqi", "pm25", "pm10"), ahead, [*cities, "nowhere"], C)
    n = lambda c: F.coalesce(F.array_size(c), F.lit(0)).cast("long").alias(f"n_{c}")
    horizons = F.coalesce(F.concat_ws(" ", F.transform("forecasts", lambda x: F.concat(x["horizon"].cast("string"), F.lit("h")))), F.lit(""))
    return made.select("city", "latest", "current", "category", "change", "direction", "dominant", horizons.alias("horizons"), n("day"), n("week"), n("month"), F.col("week")[0]["time"].alias("week_start"), "error")


_HOT = "SELECT city, timestamp, ingest_seq, temperature * 3 AS temperature, least(humidity * 1.8, 100) AS humidity, wind_speed * 20 AS wind_speed, aqi * 4 AS aqi, ingest_seq % 7 = 0 AS bare FROM obs"


def _hot(t):
    """Observations blown up until every rule has rows that break it."""
    x = t.select(*C.key, "ingest_seq", (F.col("temperature") * 3).alias("temperature"), F.least(F.col("humidity") * 1.8, F.lit(100.0)).alias("humidity"), (F.col("wind_speed") * 20).alias("wind_speed"), (F.col("aqi") * 4).alias("aqi"))
    return x.withColumn("iaqi", F.when(F.col("ingest_seq") % 7 == 0, F.create_map().cast("map<string,double>")).otherwise(F.create_map(F.lit("pm25"), F.lit(1.0))))


@add("p13_all_warnings", f"WITH x AS ({_HOT}) SELECT {KEY}, concat_ws('; ', CASE WHEN temperature NOT BETWEEN -90 AND 60 THEN 'temperature implausible' END, CASE WHEN humidity = 100 AND temperature > 45 THEN 'saturated heat' END, CASE WHEN wind_speed > 120 THEN 'wind implausible' END, CASE WHEN aqi >= 400 THEN 'aqi extreme' END, CASE WHEN bare THEN 'no pollutant breakdown' END) AS warnings FROM x")
def _(t):
    return clean.warnings(_hot(t), "iaqi").select(*C.key, F.array_join("warnings", "; ").alias("warnings"))


_WRONG = {"temperature": "NOT BETWEEN -90 AND 60", "wind_speed": "NOT BETWEEN 0 AND 120", "aqi": "NOT BETWEEN 0 AND 500"}


@add("p12_soft_batch", f"WITH x AS ({_HOT}), e AS (SELECT city, timestamp, concat_ws('; ', {', '.join(f"CASE WHEN {c} {w} THEN 'row[' || ingest_seq || '].{c}: out of range' END" for c, w in _WRONG.items())}) AS errors FROM x) SELECT * FROM e WHERE errors <> ''")
def _(t):
    return clean.validated_batch(_hot(t), "ingest_seq", ["city", "timestamp"], strict=False)[1].select(*C.key, F.array_join("errors", "; ").alias("errors"))


_SEASON = "CASE WHEN m IN (12, 1, 2) THEN 'Winter' WHEN m IN (3, 4) THEN 'Spring' WHEN m IN (5, 6) THEN 'Summer' WHEN m IN (7, 8, 9) THEN 'Monsoon' ELSE 'Autumn' END"
_DAYS = f"{_DAILY}, x AS (SELECT aqi, year(timestamp) AS year, month(timestamp) AS m FROM daily)"
_PROFILE = "count(aqi) AS n, round(avg(aqi) + 3.14159e-5, 4) AS mean, round(quantile_cont(aqi, 0.5) + 3.14159e-5, 4) AS median"


def _profile(t, by):
    made = reports.entity_profile(fx.temporal(t), "aqi", [by], digits=12)
    return made.select(by, "n", *[F.round(F.col(c) + 3.14159e-5, 4).alias(c) for c in ("mean", "median")])


@add("a08_profile_season", f"WITH {_DAYS} SELECT {_SEASON} AS season, {_PROFILE} FROM x GROUP BY 1", daily)
def _(t):
    return _profile(t, "season")


@add("a08_profile_year", f"WITH {_DAYS} SELECT year, {_PROFILE} FROM x GROUP BY 1", daily)
def _(t):
    return _profile(t, "year")


@add("s02_stored_versions", "WITH v AS (SELECT city, timestamp, aqi, ingest_seq, row_number() OVER (PARTITION BY city, timestamp ORDER BY ingest_seq % 3 DESC, ingest_seq DESC) AS n FROM raw) SELECT city, timestamp, aqi, ingest_seq FROM v WHERE n = 1", raw)
def _(t):
    """Three versions in folders of their own, found and read by Spark, the last one first."""
    path = shared_folder(t.sparkSession)
    for i in range(3):
        clean.dedupe(t.where(F.col("ingest_seq") % 3 == i), C.key, "ingest_seq").write.parquet(f"{path}/version={i}")
    return build.stored_versions(t.sparkSession, path).select(*C.key, "aqi", "ingest_seq")


@add("s13_append_twice", "WITH k AS (SELECT city, timestamp, aqi, row_number() OVER (PARTITION BY city, timestamp ORDER BY ingest_seq % 2, ingest_seq DESC) AS n FROM raw) SELECT city, timestamp, aqi FROM k WHERE n = 1", raw)
def _(t):
    """Even rows are appended first, odd rows then, and the even rows once more: existing keys win."""
    path, target = shared_folder(t.sparkSession), {"city": "string", "timestamp": "timestamp_ntz", "aqi": "double"}
    for part in (0, 1, 0):
        sinks.append_features(t.sparkSession, t.where(F.col("ingest_seq") % 2 == part), path, target)
    return t.sparkSession.read.parquet(path).select(*target)


@add("m14_promotion", "WITH c AS (SELECT city AS model, row_number() OVER (ORDER BY max(aqi), city) AS n, count(*) OVER () AS m FROM obs GROUP BY city) SELECT model, '1.0.' || CAST(n AS VARCHAR) AS version, CASE WHEN n = m THEN 'Production' WHEN n = m - 1 THEN 'Archived' ELSE 'Staging' END AS stage FROM c")
def _(t):
    """Entities as models in the order of their largest value: the one before the last is in production until the last, whose
    version is the next of the others', is promoted."""
    c = t.groupBy(F.col("city").alias("model")).agg(F.max("aqi").alias("top"))
    c = c.withColumns({"n": F.row_number().over(Window.orderBy("top", "model")), "m": F.count("*").over(Window.partitionBy())})  # a row per entity
    old = c.where("n < m").select("model", F.concat(F.lit("1.0."), F.col("n").cast("string")).alias("version"), F.when(F.col("n") == F.col("m") - 1, "Production").otherwise("Staging").alias("stage"))
    new = c.where("n = m").select("model", F.lit(training.next_version(old)).alias("version"), F.lit("Staging").alias("stage"))
    both = old.unionByName(new)
    return training.promote(both, F.col("version") == new.first().version)

"""Queries of features, reports, set operations and dataset preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.functions import features as fx
from hourloom.operators import clean, distributions, joins, reports, sets, stationarity, windows
from hourloom.config import FeatureConfig
from hourloom.plans import dataset, training
from hourloom.queries import C, CFG, KEY, NULLED, OBS, POLLUTANTS, QUERIES, SQL, W, _DAILY, _SPLIT, add, daily, nulled, obs, r, raw, rs
from hourloom.streaming import jobs

#: A short chain for the queries of dataset preparation.
SMALL = FeatureConfig(windows=(6, 24), target_lags=(1, 24, 72), pollutant_lags=(1, 24), weather_lags=(1,), differences=(1, 24))
_STAT = "SELECT '{c}' AS field, count({c}) AS n, round(avg({c}), 3) AS mean, round(min({c}), 3) AS min, round(max({c}), 3) AS max, round(stddev_samp({c}), 3) AS std FROM {t}"
_SIX = ("aqi", "pm25", "pm10", "o3", "temperature", "humidity")


@add("a01_a02_statistics", " UNION ALL ".join(_STAT.format(c=c, t=" obs") for c in _SIX))
def _(t):
    return reports.statistics(t, list(_SIX))


@add("a03_missing", f"WITH {NULLED} SELECT 'aqi' AS field, count(*) FILTER (aqi IS NULL) AS missing, round(100.0::DOUBLE * count(*) FILTER (aqi IS NULL) / count(*), 2) AS pct FROM nulled HAVING count(*) FILTER (aqi IS NULL) > 0", nulled)
def _(t):
    return reports.missing(t, ["aqi", "pm25", "pm10"])


@add("a04_duplicates", "SELECT count(*) - count(DISTINCT (city, timestamp)) AS duplicates FROM raw", raw)
def _(t):
    return reports.duplicates(t, C.key)


@add("a04_duplicate_rows", "WITH k AS (SELECT *, row_number() OVER (PARTITION BY city, timestamp ORDER BY ingest_seq) n FROM raw) SELECT city, timestamp, ingest_seq FROM k WHERE n > 1", raw)
def _(t):
    return reports.duplicate_rows(t, C.key, "ingest_seq").select("city", "timestamp", "ingest_seq")


@add("a05_quality_report", f"WITH {NULLED}, g AS (SELECT city, timestamp, lead(timestamp) OVER ({W}) nx FROM nulled), h AS (SELECT date_diff('hour', timestamp, nx) - 1 AS m FROM g WHERE date_diff('hour', timestamp, nx) > 1), v AS (SELECT (SELECT count(*) FROM nulled) - (SELECT count(*) FROM (SELECT DISTINCT city, timestamp FROM nulled)) AS duplicates, (SELECT count(*) FROM nulled) AS n_rows, (SELECT round(100.0::DOUBLE * count(*) FILTER (aqi IS NULL) / (count(*) * 2), 2) FROM nulled) AS missing_pct, (SELECT count(*) FROM h) AS n_gaps, (SELECT coalesce(sum(m), 0)::BIGINT FROM h) AS missing_hours, (SELECT count(*) FILTER (aqi < 0 OR aqi > 500) FROM nulled) AS invalid) SELECT *, concat_ws('; ', CASE WHEN duplicates > 0 THEN 'duplicate keys' END, CASE WHEN missing_pct > 5 THEN 'missing values' END, CASE WHEN n_gaps > 0 THEN 'gaps' END, CASE WHEN invalid > 0 THEN 'invalid values' END) AS issues, (duplicates = 0 AND missing_pct <= 5 AND n_gaps = 0 AND invalid = 0) AS is_clean FROM v", nulled)
def _(t):
    return reports.quality_report(t, ["aqi", "pm25"])


@add("a06_value_counts", "SELECT city, count(*) AS n FROM obs GROUP BY 1")
def _(t):
    return reports.value_counts(t, "city")


@add("a07_entity_profile", "SELECT city, count(aqi) AS n, round(avg(aqi), 4) AS mean, round(quantile_cont(aqi, 0.5), 4) AS median, round(stddev_samp(aqi), 4) AS std, min(aqi) AS min, max(aqi) AS max FROM obs GROUP BY 1")
def _(t):
    return reports.entity_profile(t, "aqi", ["city"])


for _name, _spark, _duck in (("hour", F.hour, "hour(timestamp)"), ("weekday", F.weekday, "isodow(timestamp) - 1"), ("month", F.month, "month(timestamp)"), ("weekend", F.weekday, "isodow(timestamp) >= 6")):

    @add(f"a08_profile_{_name}" if _name != "weekend" else "a09_profile_weekend", f"SELECT {_duck if _name == 'weekend' else f'CAST({_duck} AS BIGINT)'} AS slot, count(aqi) AS n, round(avg(aqi), 4) AS mean, round(stddev_samp(aqi), 4) AS std FROM obs GROUP BY 1")
    def _(t, x=_spark, name=_name):
        return reports.entity_profile(t, "aqi", [(x("timestamp") >= 5 if name == "weekend" else x("timestamp").cast("long")).alias("slot")]).select("slot", "n", "mean", "std")


@add("a10_pollutant_means", "SELECT city, " + ", ".join(f"{rs(f'avg({p})')} AS mean_{p}" for p in POLLUTANTS) + " FROM obs GROUP BY 1")
def _(t):
    return reports.means(t, list(POLLUTANTS), ["city"], 12).select("city", *[r(f"mean_{p}").alias(f"mean_{p}") for p in POLLUTANTS])


@add("a11_daily_means", "SELECT city, CAST(timestamp AS DATE) AS day, " + rs("avg(aqi)") + " AS mean_aqi FROM obs GROUP BY 1, 2")
def _(t):
    return reports.means(t, ["aqi"], ["city", F.to_date("timestamp").alias("day")], 12).withColumn("mean_aqi", r("mean_aqi"))


@add("a12_hourly_interpolated", f"WITH b AS (SELECT city, min(timestamp) lo, max(timestamp) hi FROM obs GROUP BY 1), g AS (SELECT city, unnest(range(lo, hi + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS timestamp FROM b), f AS (SELECT g.city, g.timestamp, o.aqi v, epoch(g.timestamp) s, CASE WHEN o.aqi IS NOT NULL THEN epoch(g.timestamp) END vs FROM g LEFT JOIN obs o ON o.city = g.city AND o.timestamp = g.timestamp), n AS (SELECT *, last_value(v IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) p, last_value(vs IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) ps, first_value(v IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) x, first_value(vs IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) xs FROM f) SELECT {KEY}, {rs('coalesce(v, p + (x - p) * (s - ps) / nullif(xs - ps, 0))')} AS aqi FROM n")
def _(t):
    return windows.hourly_interpolated(t, "aqi").withColumn("aqi", r("aqi"))


@add("a13_cardinality", " UNION ALL ".join(f"SELECT '{c}' AS field, count(DISTINCT {c}) AS n_distinct, round(100.0::DOUBLE * count(DISTINCT {c}) / count(*), 2) AS pct FROM  obs" for c in ("city", "aqi", "no2")))
def _(t):
    return reports.cardinality(t, ["city", "aqi", "no2"])


@add("a14_table_profile", "SELECT count(*) AS n_rows, 5::BIGINT AS n_columns, round(100.0::DOUBLE * (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw))) / count(*), 2) AS duplicate_pct, sum((city IS NULL)::INT + (timestamp IS NULL)::INT + (aqi IS NULL)::INT + (pm25 IS NULL)::INT + (ingest_seq IS NULL)::INT)::BIGINT AS missing_cells, 3::BIGINT AS numeric, 1::BIGINT AS categorical, 1::BIGINT AS datetime FROM raw", raw)
def _(t):
    return reports.table_profile(t)


_PAIRS = [(a, b) for i, a in enumerate(_SIX) for b in _SIX[i + 1 :]]


@add("a15_correlations", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 4) AS corr FROM  obs" for a, b in _PAIRS))
def _(t):
    return reports.correlations(t, list(_SIX))


def _per_city(name, make, features, sql_features):
    @add(name, f"WITH x AS (SELECT *, {', '.join(f'{s} AS {n}' for n, s in sql_features)} FROM obs) " + " UNION ALL ".join(f"SELECT city, '{n}' AS feature, round(corr({n}, aqi), 4) AS corr FROM x GROUP BY city" for n, _ in sql_features))
    def _(t):
        return reports.target_correlations(make(t), features, "aqi", ["city"])


_LG = [(f"{c}_lag_{n}", f"lag({c}, {n}) OVER ({W})") for c in ("aqi", "pm25") for n in (1, 3, 6, 24)]
_per_city("a16_lag_correlation", lambda t: windows.lags(t, {"aqi": (1, 3, 6, 24), "pm25": (1, 3, 6, 24)}), [n for n, _ in _LG], _LG)
_RO = [(f"{c}_rollmean_{w}h", f"avg({c}) OVER ({W} ROWS {w - 1} PRECEDING)") for c in ("aqi", "pm25") for w in (6, 24)]
_per_city("a17_rolling_correlation_with_target", lambda t: windows.rolling(t, ["aqi", "pm25"], (6, 24), ("mean",)), [n for n, _ in _RO], _RO)
_LE = [(f"aqi_lead_{n}", f"lead(aqi, {n}) OVER ({W})") for n in (1, 3, 6, 12, 24)]
_per_city("a18_future_correlation", lambda t: windows.leads(t, "aqi", (1, 3, 6, 12, 24)), [n for n, _ in _LE], _LE)


@add("a19_horizon_autocorrelation", f"WITH x AS (SELECT *, {', '.join(f'{s} AS {n}' for n, s in _LE)} FROM obs), c AS (" + " UNION ALL ".join(f"SELECT city, {h}::BIGINT AS horizon, round(corr(aqi, aqi_lead_{h}), 4) AS corr FROM x GROUP BY city" for h in (1, 3, 6, 12, 24)) + ") SELECT *, CASE WHEN abs(corr) > 0.7 THEN 'High' WHEN abs(corr) > 0.4 THEN 'Medium' ELSE 'Low' END AS level FROM c")
def _(t):
    return reports.horizon_autocorrelation(t)


@add("a20_leakage", "WITH c AS (" + " UNION ALL ".join(f"SELECT '{n}' AS feature, round(corr({n}, aqi), 4) AS corr FROM  obs" for n in ("wind_speed", "pm25", "pm10")) + ") SELECT *, coalesce(abs(corr) > CASE WHEN feature = 'wind_speed' THEN 0.95 ELSE 0.98 END, false) AS leaks FROM c")
def _(t):
    return reports.leakage(t, ["wind_speed", "pm25", "pm10"], POLLUTANTS, "aqi")


_ACF = ", ".join(f"lag(x, {k}) OVER ({W}) AS l{k}" for k in range(1, 9))


@add("a21_acf", f"WITH c AS (SELECT city, timestamp, aqi - avg(aqi) OVER (PARTITION BY city) AS x FROM obs), l AS (SELECT *, x AS l0, {_ACF} FROM c), g AS (" + " UNION ALL ".join(f"SELECT city, {k}::BIGINT AS lag, round(sum(x * l{k}) / sum(x * x), 4) AS acf, round(1.96 / sqrt(count(*)), 4) AS band FROM l GROUP BY city" for k in range(9)) + ") SELECT city, lag, acf, abs(acf) > band AS significant FROM g")
def _(t):
    return stationarity.acf(t, "aqi", 8)


_KL = ", ".join(f"lag(x, {k}) OVER ({W}) AS l{k}" for k in range(1, 5))


@add("a22_kpss", f"WITH c AS (SELECT city, timestamp, aqi - avg(aqi) OVER (PARTITION BY city) AS x FROM obs), l AS (SELECT *, sum(x) OVER ({W} ROWS UNBOUNDED PRECEDING) AS s, {_KL} FROM c), v AS (SELECT city, sum(s * s) / (count(*) * (sum(x * x) + {' + '.join(f'2 * (1 - {k} / 5.0::DOUBLE) * sum(x * l{k})' for k in range(1, 5))})) AS k FROM l GROUP BY 1) SELECT city, round(k, 4) AS kpss, k < 0.463 AS stationary FROM v")
def _(t):
    return stationarity.kpss(t, "aqi", 4).select("city", "kpss", "stationary")


@add("a22_adf", None)
def _(t):
    return stationarity.adf(t, "aqi")


#: The regression of one lag by Cramer's rule on centred sums.
_ADF1 = f"""WITH l AS (SELECT city, timestamp, aqi - lag(aqi) OVER w AS y, lag(aqi) OVER w AS a, lag(aqi) OVER w - lag(aqi, 2) OVER w AS b FROM obs WINDOW w AS ({W})),
s AS (SELECT city, count(*) AS n, count(*) * var_pop(a) AS aa, count(*) * var_pop(b) AS bb, count(*) * var_pop(y) AS yy, count(*) * covar_pop(a, b) AS ab, count(*) * covar_pop(a, y) AS ay, count(*) * covar_pop(b, y) AS "by" FROM l WHERE b IS NOT NULL GROUP BY 1),
c AS (SELECT *, (ay * bb - "by" * ab) / (aa * bb - ab * ab) AS p, ("by" * aa - ay * ab) / (aa * bb - ab * ab) AS q FROM s)
SELECT city, 1::BIGINT AS lags, n AS n_used, round(p / sqrt((yy - p * ay - q * "by") / (n - 3) * bb / (aa * bb - ab * ab)) + 0.0000314, 3) AS adf FROM c"""


@add("a22_adf_one_lag", _ADF1)
def _(t):
    return stationarity.adf(t, "aqi", 1).select("city", "lags", "n_used", F.round(F.col("adf") + 0.0000314, 3).alias("adf"))


@add("a22_stationarity", None)
def _(t):
    path = jobs.shared_folder(t.sparkSession)
    windows.hourly_interpolated(t, "aqi").write.parquet(path)  # several passes go over the series
    return stationarity.stationarity(t.sparkSession.read.parquet(path), "aqi")


_PL = 24
_PACF = f"""WITH c AS (SELECT city, timestamp, aqi - avg(aqi) OVER (PARTITION BY city) AS x FROM obs), l AS (SELECT city, x AS l0, {", ".join(f"lag(x, {k}) OVER ({W}) AS l{k}" for k in range(1, _PL + 1))} FROM c),
g AS (SELECT city, count(*) AS n, [{", ".join(f"(sum(l0 * l{k}) / (count(*) - {k})) / (sum(l0 * l0) / count(*))" for k in range(_PL + 1))}] AS r FROM l GROUP BY 1),
ema_step AS (SELECT city, n, r, 0 AS k, CAST([] AS DOUBLE[]) AS phi, 1.0::DOUBLE AS v FROM g UNION ALL
 SELECT city, n, r, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - a * phi[k + 1 - j]), a), a FROM (
  SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j])), 0)) / (1 - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j + 1])), 0)) AS a FROM ema_step WHERE k < {_PL}))
SELECT city, k::BIGINT AS lag, round(v, 4) AS pacf, abs(v) > 1.96 / sqrt(n) AS significant FROM ema_step"""


@add("a21_pacf", _PACF)
def _(t):
    return stationarity.pacf(t, "aqi", _PL)


_DEC = f"WITH {_DAILY}, a AS (SELECT *, CASE WHEN count(aqi) OVER f = 7 THEN avg(aqi) OVER f END AS trend, (row_number() OVER ({W}) - 1) % 7 AS phase FROM daily WINDOW f AS ({W} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)), p AS (SELECT city, phase, avg(aqi - trend) AS raw_mean FROM a GROUP BY 1, 2), q AS (SELECT city, phase, raw_mean - avg(raw_mean) OVER (PARTITION BY city) AS seasonal FROM p)"


@add("a23_decomposition", f"{_DEC} SELECT a.city, a.timestamp, round(trend + 0.000314, 3) AS trend, round(seasonal + 0.000314, 3) AS seasonal, round(aqi - trend - seasonal + 0.000314, 3) AS residual FROM a JOIN q ON a.city = q.city AND a.phase = q.phase", daily)
def _(t):
    return reports.decompose(t, "aqi").select("city", "timestamp", *[F.round(F.col(c) + 0.000314, 3).alias(c) for c in ("trend", "seasonal", "residual")])


@add("a23_signal_to_noise", f"{_DEC}, d AS (SELECT a.city, trend, seasonal, aqi - trend - seasonal AS residual FROM a JOIN q ON a.city = q.city AND a.phase = q.phase), v AS (SELECT city, stddev_samp(trend) t, stddev_samp(seasonal) s, stddev_samp(residual) r FROM d GROUP BY 1) SELECT city, round(t, 4) AS trend_std, round(s, 4) AS seasonal_std, round(r, 4) AS residual_std, round((t * t + s * s) / (r * r), 4) AS snr, round(10 * log10((t * t + s * s) / (r * r)), 4) AS snr_db FROM v", daily)
def _(t):
    return reports.signal_to_noise(reports.decompose(t, "aqi"))


@add("a24_rolling_correlation", f"WITH c AS (SELECT city, CASE WHEN count(*) OVER f = 168 THEN corr(aqi, pm10) OVER f END AS c FROM obs WINDOW f AS ({W} ROWS 167 PRECEDING)) SELECT city, count(c) AS n, round(avg(c), 4) AS mean, round(stddev_samp(c), 4) AS std, round(min(c), 4) AS min, round(max(c), 4) AS max FROM c GROUP BY 1")
def _(t):
    return reports.rolling_correlation(t, "aqi", "pm10")


_DRIFT = C.measures
_MELT = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c}::DOUBLE AS v, split FROM s" for c in _DRIFT)
_CDF = f"WITH {_SPLIT}, m AS ({_MELT}), g AS (SELECT feature, v, count(*) FILTER (split = 'train') x, count(*) FILTER (split = 'test') y FROM m WHERE v IS NOT NULL AND split IN ('train', 'test') GROUP BY 1, 2), f AS (SELECT feature, v, sum(x) OVER w / sum(x) OVER p AS train, sum(y) OVER w / sum(y) OVER p AS test, sum(x) OVER p AS n, sum(y) OVER p AS m FROM g WINDOW w AS (PARTITION BY feature ORDER BY v), p AS (PARTITION BY feature))"


@add("a25_drift", f"{_CDF}, d AS (SELECT feature, max(abs(train - test)) AS ks, sqrt(max(n) * max(m) / (max(n) + max(m))::DOUBLE) AS root FROM f GROUP BY 1), p AS (SELECT feature, ks, CASE WHEN ks <= 0 THEN 1 ELSE least(1, greatest(0, 2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0::DOUBLE * k * k * root * ks * root * ks))))) END AS p FROM d) SELECT feature, round(ks, 6) AS ks, round(p, 6) AS p, p < 0.05 AS drift FROM p")
def _(t):
    s = windows.chronological_split(t)
    return distributions.drift(s, _DRIFT, F.col("split") == "train", F.col("split") == "test")


@add("a25_ks_statistic", f"{_CDF} SELECT round(max(abs(train - test)), 6) AS ks FROM f WHERE feature = 'aqi'")
def _(t):
    s = windows.chronological_split(t)
    return distributions.drift(s, ["aqi"], F.col("split") == "train", F.col("split") == "test").select("ks")


@add("a47_cumulative", f"{_CDF} SELECT feature, v, round(train, 6) AS train, round(test, 6) AS test FROM f")
def _(t):
    s = windows.chronological_split(t)
    made = distributions.distribution_functions(s, _DRIFT, {n: F.col("split") == n for n in ("train", "test")})
    return made.select("feature", "v", F.round("train", 6).alias("train"), F.round("test", 6).alias("test"))


@add("a26_stability", "WITH k AS (SELECT city, aqi, least((row_number() OVER (PARTITION BY city ORDER BY timestamp) - 1) // greatest(count(*) OVER (PARTITION BY city) // 4, 1), 3) AS chunk FROM obs), m AS (SELECT city, chunk, avg(aqi) m FROM k GROUP BY 1, 2) SELECT city, round(stddev_pop(m) / abs(avg(m)), 4) AS cv, stddev_pop(m) / abs(avg(m)) > 0.2 AS unstable FROM m GROUP BY 1")
def _(t):
    return reports.stability(t, "aqi")


@add("a27_a28_vif", None)
def _(t):
    names = ["pm25", "pm10", "temperature", "humidity", "wind_speed", "o3"]
    m = reports.vif(reports.correlation_matrix(t, names))
    dropped = reports.high_vif(t, names)
    return t.sparkSession.createDataFrame([(n, round(float(v), 4), n in dropped) for n, v in zip(names, m, strict=True)], "feature string, vif double, dropped boolean")


@add("a29_top_variance", "WITH v AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(var_samp({c}), 4) AS variance FROM  obs" for c in _SIX) + ") SELECT * FROM v ORDER BY variance DESC, feature LIMIT 3")
def _(t):
    return reports.top_variance(t, list(_SIX), 3)


@add("a30_scaled_standard", f"SELECT {KEY}, {rs('(aqi - (SELECT avg(aqi) FROM obs)) / (SELECT stddev_pop(aqi) FROM obs)')} AS aqi FROM obs")
def _(t):
    return dataset.scale(t, dataset.fit_scaler(t, ["aqi"], "standard")).select(*C.key, r("aqi").alias("aqi"))


@add("a30_scaled_minmax", f"SELECT {KEY}, {rs('(aqi - (SELECT min(aqi) FROM obs)) / (SELECT max(aqi) - min(aqi) FROM obs)')} AS aqi FROM obs")
def _(t):
    return dataset.scale(t, dataset.fit_scaler(t, ["aqi"], "minmax")).select(*C.key, r("aqi").alias("aqi"))


@add("a30_scaled_robust", f"SELECT {KEY}, {rs('(aqi - (SELECT quantile_cont(aqi, 0.5) FROM obs)) / (SELECT quantile_cont(aqi, 0.75) - quantile_cont(aqi, 0.25) FROM obs)')} AS aqi FROM obs")
def _(t):
    return dataset.scale(t, dataset.fit_scaler(t, ["aqi"], "robust")).select(*C.key, r("aqi").alias("aqi"))


@add("a31_f22_one_hot", "SELECT city, timestamp, " + ", ".join(f"(city = '{c}')::BIGINT AS city_{c}" for c in ("click", "view")) + " FROM obs")
def _(t):
    return fx.one_hot(t.select(*C.key), "city", [c for c in dataset.fit_categories(t, "city") if c in ("click", "view")])


_BOUNDS = "b AS (SELECT " + ", ".join(f"min({p}) {p}_lo, max({p}) {p}_hi" for p in POLLUTANTS) + " FROM obs)"
_INDEX = " + ".join(f"{w}::DOUBLE * CASE WHEN {p}_hi > {p}_lo THEN ({p} - {p}_lo) / ({p}_hi - {p}_lo) ELSE 0 END" for p, w in fx.INDEX_WEIGHTS.items())


@add("a32_f17_pollution_index", f"WITH {_BOUNDS} SELECT {KEY}, {rs(_INDEX)} AS pollution_index FROM obs, b")
def _(t):
    return t.select(*C.key, r(fx.pollution_index(dataset.fit_bounds(t, POLLUTANTS))).alias("pollution_index"))


@add("a33_a34_regression_metrics", f"WITH p AS (SELECT aqi AS y, lag(aqi) OVER ({W}) AS q FROM obs), e AS (SELECT y, y - q AS e FROM p WHERE q IS NOT NULL) SELECT count(*) AS n, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae, round(avg(e * e), 4) AS mse, round(1 - sum(e * e) / (var_pop(y) * count(*)), 4) AS r2, round(1 - var_pop(e) / var_pop(y), 4) AS explained_variance, round(quantile_cont(abs(e), 0.5), 4) AS median_abs_error, round(max(abs(e)), 4) AS max_error, round(avg(e), 4) AS residual_mean, round(stddev_pop(e), 4) AS residual_std, round(min(e), 4) AS residual_min, round(max(e), 4) AS residual_max FROM e")
def _(t):
    x = windows.lags(t, {"aqi": (1,)}).where("aqi_lag_1 is not null")
    return reports.regression_metrics(x.select(F.col("aqi").alias("actual"), F.col("aqi_lag_1").alias("predicted")))


@add("a35_degradation", "WITH l AS (SELECT ingest_seq % 4 = 0 AS d FROM raw ORDER BY ingest_seq DESC LIMIT 100) SELECT count(*) AS n, round(avg(d::INT), 4) AS ratio, round(avg(d::INT), 4) > 0.2 AS alert FROM l", raw)
def _(t):
    return reports.degradation(t.withColumn("degraded", F.col("ingest_seq") % 4 == 0), "ingest_seq", "degraded")


@add("a37_availability", f"WITH {NULLED} SELECT 'aqi' AS field, round(100.0::DOUBLE * count(aqi) / count(*), 2) AS available_pct FROM nulled UNION ALL SELECT 'pm25', round(100.0::DOUBLE * count(pm25) / count(*), 2) FROM nulled", nulled)
def _(t):
    return reports.availability(t, ["aqi", "pm25"])


@add("a38_usable_targets", "SELECT " + ", ".join(f"count(t{h}.aqi) AS usable_{h}" for h in (24, 48, 72)) + " FROM obs o " + " ".join(f"LEFT JOIN obs t{h} ON t{h}.city = o.city AND t{h}.timestamp = o.timestamp + INTERVAL {h} HOUR" for h in (24, 48, 72)))
def _(t):
    return joins.targets(t).agg(*[F.count(f"target_aqi_t_{h}").alias(f"usable_{h}") for h in (24, 48, 72)])


@add("a39_sequence_readiness", "WITH c AS (SELECT city, greatest(count(*) - 48 - 24 + 1, 0) AS sequences FROM obs GROUP BY 1) SELECT city, sequences, sequences > 100 AS enough, sequences > 5000 AS plenty FROM c")
def _(t):
    return reports.sequence_readiness(t, 48, 24)


@add("a40_split_report", f"WITH {_SPLIT} SELECT split, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM s), 2) AS pct, min(timestamp) AS start, max(timestamp) AS \"end\" FROM s GROUP BY 1")
def _(t):
    return reports.split_report(windows.chronological_split(t))


@add("a41_chronology", "WITH d AS (SELECT city, date_diff('hour', lag(timestamp) OVER (PARTITION BY city ORDER BY ingest_seq), timestamp) d FROM obs), c AS (SELECT city, d, count(*) n FROM d WHERE d IS NOT NULL GROUP BY 1, 2), m AS (SELECT city, arg_max(d, n * 100000 - d) AS modal_hours FROM c GROUP BY 1), g AS (SELECT city, count(*) FILTER (d < 0) AS backward, count(*) FILTER (d = 0) AS repeated FROM d GROUP BY 1) SELECT g.city, backward, repeated, modal_hours, backward = 0 AS monotone FROM g LEFT JOIN m ON g.city = m.city")
def _(t):
    return reports.chronology(t, "ingest_seq")


@add("a42_derived_check", "SELECT bool_and(extract('hour' FROM timestamp) = date_diff('hour', date_trunc('day', timestamp), timestamp)) AS hour_ok, bool_and((isodow(timestamp) >= 6) = (dayname(timestamp) IN ('Saturday', 'Sunday'))) AS weekend_ok, count(*) AS n FROM obs")
def _(t):
    x = fx.light_time(t)
    return x.agg(F.bool_and(F.col("hour") == F.hour("timestamp")).alias("hour_ok"), F.bool_and((F.col("is_weekend") == 1) == (F.dayofweek("timestamp").isin(1, 7))).alias("weekend_ok"), F.count("*").alias("n"))


@add("a44_spikes", "SELECT city, count(*) FILTER (aqi > 150) AS spikes FROM obs GROUP BY 1")
def _(t):
    return t.groupBy("city").agg(F.count_if(F.col("aqi") > 150).alias("spikes"))


@add("a47_histogram", "WITH b AS (SELECT min(aqi) lo, max(aqi) hi FROM raw) SELECT least(CAST(floor((aqi - lo) / ((hi - lo) / 50)) AS BIGINT), 49) AS bin, count(*) AS n FROM raw, b GROUP BY 1", raw)
def _(t):
    return reports.histogram(t, "aqi", 50)


@add("a47_box", "SELECT city, min(aqi) AS low, round(quantile_cont(aqi, 0.25), 4) AS q1, round(quantile_cont(aqi, 0.5), 4) AS median, round(quantile_cont(aqi, 0.75), 4) AS q3, max(aqi) AS high FROM obs GROUP BY 1")
def _(t):
    return reports.box(t, "aqi", "city")


@add("t05_entities_by_median", "SELECT city, quantile_cont(aqi, 0.5) AS median FROM obs GROUP BY 1 ORDER BY 2 DESC, 1")
def _(t):
    return t.groupBy("city").agg(F.percentile("aqi", F.lit(0.5)).alias("median")).orderBy(F.desc("median"), "city")


@add("t02_top_hours", "SELECT city, timestamp, aqi FROM obs ORDER BY aqi DESC, city, timestamp LIMIT 15")
def _(t):
    return t.select(*C.key, "aqi").orderBy(F.desc("aqi"), *C.key).limit(15)


@add("u01_union_by_name", "SELECT city, timestamp, CASE WHEN ingest_seq % 2 = 0 THEN aqi END AS aqi, CASE WHEN ingest_seq % 2 = 1 THEN pm25 END AS pm25 FROM obs")
def _(t):
    return sets.stack(t.where("ingest_seq % 2 = 0").select(*C.key, "aqi"), t.where("ingest_seq % 2 = 1").select(*C.key, "pm25"))


@add("u02_missing_hours", "WITH b AS (SELECT city, min(timestamp) lo, max(timestamp) hi FROM obs GROUP BY 1), g AS (SELECT city, unnest(range(lo, hi + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS timestamp FROM b) SELECT g.city, g.timestamp FROM g ANTI JOIN obs o ON o.city = g.city AND o.timestamp = g.timestamp")
def _(t):
    return sets.missing_hours(t)


@add("u03_common_days", "SELECT DISTINCT CAST(timestamp AS DATE) AS day FROM obs WHERE city = 'click' INTERSECT SELECT DISTINCT CAST(timestamp AS DATE) FROM obs WHERE city = 'view'")
def _(t):
    return sets.common_days(t.where("city = 'click'"), t.where("city = 'view'"))


@add("u05_repeated_keys", "SELECT city, timestamp, count(*) AS count FROM raw GROUP BY 1, 2 HAVING count(*) > 1", raw)
def _(t):
    return sets.repeated_keys(t, C.key)


# Features --------------------------------------------------------------------------------------------------------

_CAL = {
    "year": "year(timestamp)", "month": "month(timestamp)", "day": "day(timestamp)", "hour": "hour(timestamp)", "minute": "minute(timestamp)", "day_of_year": "dayofyear(timestamp)", "week_of_year": "weekofyear(timestamp)",
    "day_of_week": "isodow(timestamp) - 1", "quarter": "quarter(timestamp)", "days_in_month": "day(last_day(timestamp))", "is_month_start": "(day(timestamp) = 1)::INT", "is_month_end": "(CAST(timestamp AS DATE) = last_day(timestamp))::INT",
    "is_weekend": "(isodow(timestamp) >= 6)::INT", "days_since_weekend": "CASE WHEN isodow(timestamp) <= 5 THEN least(isodow(timestamp) - 1, 7 - isodow(timestamp)) ELSE 0 END",
    "is_holiday": "((month(timestamp), day(timestamp)) IN ((3, 23), (8, 14), (12, 25)))::INT", "is_working_day": "(isodow(timestamp) < 6 AND (month(timestamp), day(timestamp)) NOT IN ((3, 23), (8, 14), (12, 25)))::INT",
    "is_morning": "(hour(timestamp) BETWEEN 5 AND 11)::INT", "is_night": "(hour(timestamp) >= 21 OR hour(timestamp) <= 4)::INT", "is_rush_hour": "(hour(timestamp) BETWEEN 8 AND 10 OR hour(timestamp) BETWEEN 17 AND 19)::INT", "is_q1": "(quarter(timestamp) = 1)::INT", "is_first_half": "(month(timestamp) <= 6)::INT",
}


@add("f01_f10_calendar", f"SELECT {KEY}, " + ", ".join(f"CAST({x} AS BIGINT) AS {n}" for n, x in _CAL.items()) + ", dayname(timestamp) AS day_of_week_name, CASE WHEN month(timestamp) IN (12, 1, 2) THEN 'Winter' WHEN month(timestamp) IN (3, 4) THEN 'Spring' WHEN month(timestamp) IN (5, 6) THEN 'Summer' WHEN month(timestamp) IN (7, 8, 9) THEN 'Monsoon' ELSE 'Autumn' END AS season FROM obs")
def _(t):
    return fx.temporal(t).select(*C.key, *_CAL, "day_of_week_name", "season")


@add("f04_cyclical", f"SELECT {KEY}, " + ", ".join(f"{rs(f'{fn}(2 * pi() * ({x}) / {p})')} AS {n}_{fn}" for n, x, p in (("hour", "hour(timestamp)", 24), ("dow", "isodow(timestamp) - 1", 7), ("month", "month(timestamp)", 12), ("doy", "dayofyear(timestamp)", 365)) for fn in ("sin", "cos")) + " FROM obs")
def _(t):
    names = [f"{n}_{fn}" for n in ("hour", "dow", "month", "doy") for fn in ("sin", "cos")]
    return fx.temporal(t).select(*C.key, *[r(n).alias(n) for n in names])


_G = "(17.27 * temperature / (237.7 + temperature) + ln(least(greatest(humidity, 1), 100) / 100))"
_FH = "(temperature * 9 / 5 + 32)"
_HI = f"(-42.379 + 2.04901523 * {_FH} + 10.14333127 * humidity - 0.22475541 * {_FH} * humidity - 0.00683783 * {_FH} * {_FH} - 0.05481717 * humidity * humidity + 0.00122874 * {_FH} * {_FH} * humidity + 0.00085282 * {_FH} * humidity * humidity - 0.00000199 * {_FH} * {_FH} * humidity * humidity)"


@add("f11_f13_interactions", f"SELECT {KEY}, {rs('temperature * humidity')} AS temp_humidity_interaction, {rs('wind_speed * pm25')} AS wind_pm25_interaction, {rs('pm25 / (wind_speed + 0.1)')} AS pm25_per_wind, {rs(f'pressure - lag(pressure) OVER ({W})')} AS pressure_change_1h, {rs(f'237.7 * {_G} / (17.27 - {_G})')} AS dew_point, {rs(f'CASE WHEN temperature >= 26.7 THEN ({_HI} - 32) * 5 / 9 ELSE temperature END')} AS heat_index FROM obs")
def _(t):
    return fx.interactions(t).select(*C.key, *[r(n).alias(n) for n in ("temp_humidity_interaction", "wind_pm25_interaction", "pm25_per_wind", "pressure_change_1h", "dew_point", "heat_index")])


_BAND = "CASE WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Moderate' WHEN aqi <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN aqi <= 200 THEN 'Unhealthy' WHEN aqi <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END"


_FEATURE_BAND = "CASE WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Moderate' WHEN aqi <= 150 THEN 'Unhealthy_Sensitive' WHEN aqi <= 200 THEN 'Unhealthy' WHEN aqi <= 300 THEN 'Very_Unhealthy' ELSE 'Hazardous' END"


@add("f14_f15_bands", f"SELECT ingest_seq, CASE WHEN aqi > -1 AND aqi <= 501 THEN {_FEATURE_BAND} END AS band, CASE WHEN aqi IS NULL THEN 'Unavailable' ELSE {_BAND} END AS category FROM raw", raw)
def _(t):
    return t.select("ingest_seq", fx.band(F.col("aqi")).alias("band"), fx.display_category(F.col("aqi")).alias("category"))


@add("f16_ratios", f"SELECT {KEY}, {rs('pm25 / (pm10 + 0.1)')} AS pm25_pm10_ratio, {rs('no2 / (so2 + 0.1)')} AS no2_so2_ratio, {rs('co / (no2 + 0.1)')} AS co_no2_ratio, {rs('pm25 / (o3 + 0.1)')} AS pm25_o3_ratio FROM obs")
def _(t):
    return fx.ratios(t).select(*C.key, *[r(n).alias(n) for n in ("pm25_pm10_ratio", "no2_so2_ratio", "co_no2_ratio", "pm25_o3_ratio")])


@add("f20_f21_space", f"SELECT {KEY}, {rs('temperature * humidity')} AS lat_lon_product, {rs('2 * 6371.0 * asin(sqrt(pow(sin((radians(24.86) - radians(temperature)) / 2), 2) + cos(radians(temperature)) * cos(radians(24.86)) * pow(sin((radians(67.0) - radians(humidity)) / 2), 2)))')} AS distance_km FROM obs")
def _(t):
    return t.select(*C.key, r(F.col("temperature") * F.col("humidity")).alias("lat_lon_product"), r(fx.haversine(F.col("temperature"), F.col("humidity"), 24.86, 67.0)).alias("distance_km"))


_ARG = "greatest(pm25, no2, so2, co)"


@add("f23_f24_dominant", f"SELECT {KEY}, CASE WHEN pm25 = {_ARG} THEN 'pm25' WHEN no2 = {_ARG} THEN 'no2' WHEN so2 = {_ARG} THEN 'so2' ELSE 'co' END AS dominant, CASE WHEN pm25 = {_ARG} THEN 'PM2.5' WHEN no2 = {_ARG} THEN 'NO2' WHEN so2 = {_ARG} THEN 'SO2' ELSE 'CO' END AS label FROM obs")
def _(t):
    d = fx.dominant(("pm25", "no2", "so2", "co"))
    return t.select(*C.key, d.alias("dominant"), fx.dominant_label(F.concat(F.lit(" "), F.upper(d))).alias("label"))


@add("f26_f32_time_text", "SELECT city, strftime(timestamp, '%Y-%m-%dT%H:%M:%SZ') AS iso, timestamp + INTERVAL 24 HOUR AS forecast_at FROM obs")
def _(t):
    return t.select("city", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"), (F.col("timestamp") + F.expr("interval 24 hours")).alias("forecast_at"))


@add("f28_impact", "WITH m AS (SELECT city, timestamp, temperature - 25 AS c, max(abs(temperature - 25)) OVER (PARTITION BY city) AS mx FROM obs) SELECT city, timestamp, CASE WHEN mx <= 0 THEN 'Low' WHEN abs(c) / mx >= 0.66 THEN 'High' WHEN abs(c) / mx >= 0.33 THEN 'Medium' ELSE 'Low' END AS impact, CASE WHEN c > 0 THEN 'increases' WHEN c < 0 THEN 'decreases' ELSE 'neutral' END AS direction FROM m")
def _(t):
    from pyspark.sql import Window

    c = F.col("temperature") - 25
    return t.select(*C.key, fx.impact(F.abs(c), F.max(F.abs(c)).over(Window.partitionBy("city"))).alias("impact"), fx.direction(c).alias("direction"))


@add("m01_feature_chain", None)
def _(t):
    return dataset.chain(t.withColumns({"latitude": F.lit(24.86), "longitude": F.lit(67.0)}), SMALL, stats=("mean", "std", "min", "max", "range"))


@add("m03_training_dataset", None)
def _(t):
    return dataset.build(t, SMALL, stats=("mean", "std"))[0]


def _forecasts(t):
    built, state = dataset.build(t, SMALL, stats=("mean", "std"))
    return training.forecasts(built.persist(), state.features, SMALL.horizons, C)


@add("m05_m11_forecasts", None)
def _(t):
    return _forecasts(t)


@add("m14_model_catalogue", "WITH c AS (SELECT city, count(*) AS n FROM obs GROUP BY 1) SELECT city AS model, '1.0.' || CAST(row_number() OVER (ORDER BY city) AS VARCHAR) AS version, CASE WHEN city = 'view' THEN 'Production' ELSE 'Archived' END AS stage FROM c")
def _(t):
    from pyspark.sql import Window

    c = t.groupBy(F.col("city").alias("model")).count().select("model", F.concat(F.lit("1.0."), F.row_number().over(Window.orderBy("model")).cast("string")).alias("version"), F.lit("Production").alias("stage"))
    return training.promote(c, F.col("model") == "view")


@add("m18_forecast_errors", "SELECT h AS horizon, count(*) AS n, round(avg(abs(aqi - p)), 4) AS mae FROM (" + " UNION ALL ".join(f"SELECT {h}::BIGINT AS h, o.aqi AS p, t.aqi AS aqi FROM obs o JOIN obs t ON t.city = o.city AND t.timestamp = o.timestamp + INTERVAL {h} HOUR" for h in (24, 48, 72)) + ") GROUP BY 1")
def _(t):
    x = joins.targets(t)
    parts = [x.where(F.col(f"target_aqi_t_{h}").isNotNull()).select(F.lit(h).cast("long").alias("horizon"), F.col("aqi").alias("predicted"), F.col(f"target_aqi_t_{h}").alias("actual")) for h in (24, 48, 72)]
    return reports.regression_metrics(sets.stack(*parts), by=["horizon"]).select("horizon", "n", "mae")


@add("m15_entity_summary", f"WITH k AS (SELECT city, aqi, timestamp, row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) n FROM obs), v AS (SELECT city, max(aqi) FILTER (n = 1) AS current, max(timestamp) AS latest, round(max(aqi) FILTER (n = 1) - max(aqi) FILTER (n = 2), 2) AS change, count(*) FILTER (timestamp >= (SELECT max(m.timestamp) FROM obs m WHERE m.city = k.city) - INTERVAL 24 HOUR) AS n_history FROM k GROUP BY 1) SELECT city, current, latest, change, n_history, {_BAND.replace('aqi', 'current')} AS category FROM v")
def _(t):
    return training.entity_summary(t, C)


@add("m16_hourly_features", f"SELECT city, timestamp, lag(aqi, 1) OVER ({W}) AS aqi_lag_1, {rs(f'avg(aqi) OVER ({W} ROWS 5 PRECEDING)')} AS aqi_rollmean_6h FROM obs QUALIFY row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) = 1")
def _(t):
    live = windows.latest_rows(t, 1)
    old = joins.new_rows(t, live)
    made = dataset.hourly_features(old, live, None, SMALL, ("mean",))
    return made.select(*C.key, "aqi_lag_1", r("aqi_rollmean_6h").alias("aqi_rollmean_6h"))


def _online(spark, d):
    made = jobs.batch_check_features(spark, d)
    return made.select(*C.key, "ingest_seq", "aqi", *[f"aqi_lag_{n}" for n in CFG.target_lags], *[r(f"aqi_{k}_{w}h").alias(f"aqi_{k}_{w}h") for k in ("rollmean", "ema") for w in CFG.windows])


QUERIES["x05_stream_features"] = _online
for _name, _job in (("x01_stream_ingest", jobs.batch_check_ingest), ("x01_stream_quarantine", jobs.batch_check_quarantine), ("x06_stream_degradation", jobs.batch_check_degradation), ("x07_stream_alerts", jobs.batch_check_alerts)):
    QUERIES[_name] = _job
for _name, _job in (("x02_stream_append", jobs.batch_check_append), ("x02_stream_corrections", jobs.batch_check_corrections), ("x03_stream_daily_mean", jobs.batch_check_windows), ("x03_stream_sliding", jobs.batch_check_sliding), ("x04_stream_sessions", jobs.batch_check_sessions)):
    QUERIES[_name] = _job
SQL["x03_stream_daily_mean"] = "SELECT event_type AS city, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, count(*) AS n, round(avg(value) + 3.14159e-9, 6) AS mean FROM events GROUP BY 1, 2"
SQL["x02_stream_append"] = "SELECT event_type AS city, date_trunc('hour', ts) AS timestamp, min(event_id) AS ingest_seq FROM events GROUP BY 1, 2"
SQL["x04_stream_sessions"] = "WITH g AS (SELECT event_type AS city, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts) <= INTERVAL 90 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL), s AS (SELECT city, ts, sum(fresh) OVER (PARTITION BY city ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT city, CAST(min(ts) AS TIMESTAMP) AS start, CAST(max(ts) AS TIMESTAMP) + INTERVAL 90 MINUTE AS \"end\", count(*) AS n FROM s GROUP BY city, k"
SQL["x01_stream_quarantine"] = "SELECT * FROM events WHERE event_type IS NULL OR ts IS NULL"
SQL["x01_stream_ingest"] = "SELECT CASE WHEN NOT bad THEN event_type END AS city, CASE WHEN NOT bad THEN date_trunc('hour', ts) END AS timestamp, event_id AS ingest_seq, bad AS quarantined FROM (SELECT *, event_id % 50 IN (7, 9) OR ts IS NULL OR event_type IS NULL AS bad FROM events)"
SQL["x02_stream_corrections"] = "SELECT event_type AS city, date_trunc('hour', ts) AS timestamp, max(event_id) AS ingest_seq, arg_max(value, event_id) AS aqi FROM events GROUP BY 1, 2"
SQL["x03_stream_sliding"] = "SELECT event_type AS city, start, count(*) AS n, round(avg(value) + 3.14159e-9, 6) AS mean FROM (SELECT *, unnest([time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR * i FOR i IN range(4)]) AS start FROM events) GROUP BY 1, 2"
_FIRST = "k AS (SELECT event_type AS city, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp, value AS aqi, event_id AS ingest_seq FROM events QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id) = 1)"
_STEP = lambda w: f"n.aqi * 2.0::DOUBLE / {w + 1} + (1 - 2.0::DOUBLE / {w + 1}) * s.e{w}"
SQL["x05_stream_features"] = f"""WITH RECURSIVE {_FIRST}, n AS (SELECT *, row_number() OVER ({W}) AS rn FROM k),
ema_step AS (SELECT city, timestamp, rn, {", ".join(f"aqi AS e{w}" for w in CFG.windows)} FROM n WHERE rn = 1 UNION ALL
 SELECT n.city, n.timestamp, n.rn, {", ".join(_STEP(w) for w in CFG.windows)} FROM ema_step s JOIN n ON n.city = s.city AND n.rn = s.rn + 1)
SELECT city, timestamp, ingest_seq, aqi, {", ".join(f"lag(aqi, {n}) OVER ({W}) AS aqi_lag_{n}" for n in CFG.target_lags)},
 {", ".join(f"{rs(f'avg(aqi) OVER ({W} ROWS {w - 1} PRECEDING)')} AS aqi_rollmean_{w}h" for w in CFG.windows)}, {", ".join(f"{rs(f'e{w}')} AS aqi_ema_{w}h" for w in CFG.windows)}
FROM k JOIN ema_step USING (city, timestamp)"""
SQL["x06_stream_degradation"] = "WITH k AS (SELECT value > 100 AS bad FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL ORDER BY event_id DESC LIMIT 100), g AS (SELECT count(*) AS n, round(avg(CAST(bad AS INTEGER)), 4) AS ratio FROM k) SELECT n, ratio, ratio > 0.2 AS alert, 0::BIGINT AS batch FROM g"
SQL["x07_stream_alerts"] = "SELECT event_type AS city, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp, value AS aqi, 'Hazardous air in ' || event_type AS message FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL AND value > 300"

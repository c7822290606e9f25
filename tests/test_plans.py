"""The default chain, its steps, the fitted state and bundles; rolling order statistics; as-of lookups; summaries."""

import datetime as dt
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourloom import queries as core
from hourloom.config import Columns, FeatureConfig
from hourloom.operators import joins, windows
from hourloom.plans import bundle, dataset, training

D, C, T0 = "/root/testdata/sf0.001", Columns(), dt.datetime(2024, 1, 1)
TINY = FeatureConfig(target_lags=(1,), pollutant_lags=(1,), weather_lags=(1,), windows=(3,), differences=(1,), cities=("Click",))


def test_default_columns_of_the_chain(spark):
    made = dataset.chain(core.obs(spark, D), FeatureConfig())
    cfg, names = FeatureConfig(), {*made.columns}
    assert {f"{m}_{k}_{w}h" for m in C.measures for w in cfg.windows for k in ("rollmean", "rollstd", "rollmin", "rollmax", "rollmedian", "rollrange", "ema")} <= names
    assert {"city_Islamabad", "city_Karachi", "city_Lahore", "aqi_category", "dew_point", "aqi_momentum_3"} <= names and len(names) > 500
    assert not any("rollq25" in n for n in names) and any("rollq25" in n for n in dataset.chain(core.obs(spark, D), FeatureConfig(quantiles=True, windows=(24,), emas=False)).columns)


def test_steps_can_be_replaced_or_left_out(spark):
    t = core.obs(spark, D)
    mine = dataset.chain(t, TINY, ("mean",), steps={"trend": None, "air_quality": lambda df, cfg, c: df.withColumn("mine", F.lit(1)), "lag": lambda df, cfg, c: windows.lags(df, {"aqi": (30,)}, c)}, reach=30)
    assert "mine" in mine.columns and "aqi_diff_1" not in mine.columns and "aqi_category" not in mine.columns
    want = t.select(*C.key, F.lag("aqi", 30).over(C.window()).alias("v"))
    assert sorted(map(str, mine.select(*C.key, "aqi_lag_30").collect())) == sorted(str(r).replace("v=", "aqi_lag_30=") for r in want.collect())
    with pytest.raises(ValueError, match="unknown steps"):
        dataset.chain(t, TINY, steps={"nothing": None})


def test_float32(spark):
    kinds = dict(dataset.chain(core.obs(spark, D), FeatureConfig(windows=(3,), float32=True), ("mean",)).dtypes)
    assert kinds["aqi_rollmean_3h"] == kinds["aqi_ema_3h"] == "float" and kinds["aqi"] == kinds["aqi_lag_1"] == "double"


def test_order_statistics_equal_sorting_each_frame(spark):
    rnd = random.Random(1)
    rows = [(c, i, rnd.choice([None, 1.0, 2.0, rnd.random() * 9])) for c in ("a", "b", None) for i in range(120)]
    df = spark.createDataFrame(rows, "city string, h int, aqi double").withColumn("timestamp", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, h)"))
    for full in (False, True):
        got = windows.rolling(df, ["aqi"], (5, 24, 50), ("q25", "mean", "median", "q75"), full=full)
        want = df
        for w in (5, 24, 50):
            f = C.window().rowsBetween(1 - w, 0)
            for name, q in (("rollq25", 0.25), ("rollmedian", 0.5), ("rollq75", 0.75)):
                v = F.percentile("aqi", F.lit(q)).over(f)
                want = want.withColumn(f"aqi_{name}_{w}h", F.when(F.count("aqi").over(f) == w, v) if full else v)
        names = [n for n in want.columns if "roll" in n]
        key = lambda r: (str(r.city), r.h)
        for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
            assert [a[n] for n in names] == pytest.approx([b[n] for n in names]), a


@pytest.fixture(scope="module")
def fitted(spark):
    t = core.obs(spark, D)
    x = dataset.spatial_step(t.select(*C.key, "aqi", "pm25", "wind_speed"), TINY, C).withColumn("aqi_category", F.lit("Good"))
    train = joins.targets(x, (24,)).where("target_aqi_t_24 is not null").persist()
    state = dataset.Preprocessor(TINY, impute="forward").fit(train)
    x = state.transform(train).withColumn("label", F.col("target_aqi_t_24"))
    x = x.na.fill(0.0)
    model = Pipeline(stages=[VectorAssembler(inputCols=state.features, outputCol="features"), training.ridge(x)]).fit(x)
    return train, state, model


def test_bundle_round_trip(spark, fitted, tmp_path):
    train, state, model = fitted
    assert "city_Click" in state.features and "aqi_category" not in state.features
    made = bundle.Bundle(model, state, tuple(state.features), 24, "ridge", "1.2.3", {"rows": 5})
    bundle.save_bundle(made, spark, str(tmp_path / "b"))
    got = bundle.load_bundle(spark, str(tmp_path / "b"))
    assert got.state == state and (got.features, got.horizon, got.version, got.details) == (made.features, 24, "1.2.3", {"rows": 5})
    rows = lambda b: sorted(map(str, b.predict(train).collect()))
    assert rows(got) == rows(made) and len(rows(got)) == train.count()
    with pytest.raises(ValueError, match="missing features"):
        got.predict(train.drop("pm25"))


def test_a_changed_bundle_is_an_error(spark, fitted, tmp_path):
    _, state, model = fitted
    features = tuple(state.features)
    for wrong in (features[1:], (features[1], features[0], *features[2:]), (*features, features[0]), ()):
        with pytest.raises(ValueError):
            bundle.Bundle(model, state, wrong, 24, "ridge").checked()
    with pytest.raises(ValueError, match="horizon"):
        bundle.Bundle(model, state, features, 25, "ridge").checked()
    path = bundle.save_bundle(bundle.Bundle(model, state, features, 24, "ridge"), spark, str(tmp_path / "b"))
    text = spark.read.text(f"{path}/manifest").first()[0]
    spark.createDataFrame([(text.replace(f'"{features[0]}"', '"other"'),)], "value string").write.mode("overwrite").text(f"{path}/manifest")
    with pytest.raises(ValueError, match="other here"):
        bundle.load_bundle(spark, path)


def test_forward_imputation_is_causal(spark):
    df = spark.createDataFrame([("a", T0 + dt.timedelta(hours=i), v, 1.0) for i, v in enumerate([None, 4.0, None, 8.0, None])], "city string, timestamp timestamp_ntz, pm25 double, pm10 double")
    state = dataset.Preprocessor(impute="forward", scaling="minmax").fit(df)
    state.scaler = {}
    assert [r.pm25 for r in state.transform(df).orderBy("timestamp").collect()] == [6.0, 4.0, 4.0, 8.0, 8.0]


def test_as_of(spark):
    rnd = random.Random(8)
    at = lambda h: T0 + dt.timedelta(hours=h)
    features = [(rnd.choice("ab"), at(rnd.randrange(400)), rnd.choice([None, rnd.random()]), i) for i in range(80)]
    features = list({f[:2]: f for f in features}.values()) + [("b", None, 1.0, 99)]
    requests = [(rnd.choice(["a", "b", "c", None]), at(rnd.randrange(420)), i, rnd.choice([1, 20, 300])) for i in range(150)]
    f = spark.createDataFrame(features, "city string, timestamp timestamp_ntz, x double, y long")
    q = spark.createDataFrame(requests, "city string, timestamp timestamp_ntz, n long, life int")
    for valid in (False, True):
        got = {r.n: r for r in joins.as_of(q, f, ["x", "y"], F.make_dt_interval(hours=F.col("life")), valid, hours=24).collect()}
        assert {*got} == {*range(150)}
        for c, t, n, life in requests:
            rows = sorted((r for r in features if r[0] == c and r[1] is not None and r[1] <= t), key=lambda r: r[1])
            best = lambda k: next((r for r in reversed(rows) if not valid or r[k] is not None), None)
            for name, k in (("x", 2), ("y", 3)):
                r = best(k)
                assert got[n][name] == (r[k] if r and r[1] > t - dt.timedelta(hours=life) else None), (n, name)
    assert joins.as_of(q, f, ["x"], None, hours=24).count() == 150 and joins.as_of(q, f, ["x"], "3 hours").count() == 150


def test_required_fields(spark):
    df = spark.createDataFrame([("a", T0, 1.0, None), ("b", T0, None, None)], "city string, timestamp timestamp_ntz, wind_deg double, aqi double")
    fields = {"wind": ["wind_direction", "wind_deg"]}
    assert joins.latest_valid(df.where("city = 'a'"), fields, required=("wind",)).first().wind == 1.0
    with pytest.raises(Exception, match="wind: no valid value for b"):
        joins.latest_valid(df, fields, required=("wind",)).collect()
    with pytest.raises(ValueError, match="missing fields"):
        joins.latest_valid(df, {"pm25": ["pm25"]}, required=("pm25",))


def test_full_summary_isolates_entities(spark):
    df = spark.createDataFrame([("a", T0 + dt.timedelta(hours=h), float(h), 1.0, 9.0) for h in range(0, 800, 2)] + [("b", T0, None, None, None)], "city string, timestamp timestamp_ntz, aqi double, pm25 double, no2 double")
    got = {r.city: r for r in training.full_summary(df, None, ["a", "b", "c"]).collect()}
    a = got["a"]
    assert (a.current, a.category, a.change, a.direction, a.dominant, len(a.day), len(a.week), len(a.month), a.error) == (798.0, "Hazardous", 2.0, "up", "NO2", 13, 85, 361, None)
    assert [p.value for p in a.day] == [float(v) for v in range(774, 800, 2)] and a.message.startswith("Air quality is hazardous")
    assert got["b"].error == "no valid reading" and got["b"].category == "Unavailable" and got["c"].error == "no rows"
